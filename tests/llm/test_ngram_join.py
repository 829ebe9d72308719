import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from cases import clashing, edge_texts, frame, prose

from stageline.llm import ngram_join
from stageline.llm.components import components
from stageline.llm.ngram_join import _fold, allocate, jaccard_classes, keep_one_of_each_class, sketch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (len(x), find(d)) for d, x in sets}


def near_texts(seed, n=60):
    """Clusters around the threshold, in chains and stars, with a common passage."""
    rng = random.Random(seed)
    passage = prose(rng, 25, 10_000)
    out = []
    for _ in range(n):
        size = rng.choice([6, 8, 12, 20, 35, 60, 130, 140, 300, 700])
        base = prose(rng, size, 10_000).split(" ")
        if rng.random() < 0.4:
            base = base + passage.split(" ")
        out.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1, max(2, len(copy) // 20))):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.72, 1))]
            out.append(" ".join(copy))
            if rng.random() < 0.4:
                base = copy
    rng.shuffle(out)
    return out


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("seed", [1])
def test_against_brute_force(spark, seed):
    texts = edge_texts(seed) + near_texts(seed)
    want = brute(enumerate(texts))
    got = result(jaccard_classes(clashing(frame(spark, texts).repartition(4))))
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {}
    assert 20 < len({c for _, c in want.values()}) < len(texts) - 30


def test_nearest_rounds_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "MANY", 0)
    texts = near_texts(11, 25)
    assert result(jaccard_classes(frame(spark, texts))) == brute(enumerate(texts))


def test_links_are_all_counted(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LINK_SETS", 5)  # classes in one block and in several
    rng = random.Random(2)
    base = prose(rng, 200, 10_000).split(" ")
    texts = [" ".join([*base[:i], f"edit{i}", *base[i + 1 :]]) for i in range(20, 180, 8)] + near_texts(17, 20) + edge_texts(2)
    texts += texts[:3]  # copies are one set
    sets = [frozenset(shingles(t)) for t in texts]
    want = [sum(100 * len(x & y) >= 75 * len(x | y) for y in set(sets) - {x} if y) if x else 0 for x in sets]
    got = {r.doc_id: r.n_links for r in jaccard_classes(frame(spark, texts)).collect()}
    assert got == dict(enumerate(want))
    assert max(want) >= 19 and want.count(1) > 2


@pytest.mark.parametrize("rounds", [0, 2])
def test_large_signatures_are_dealt_into_blocks(spark, monkeypatch, rounds):
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", 4)
    monkeypatch.setattr(ngram_join, "NEAREST_ROUNDS", rounds)
    sizes = []
    compared = ngram_join._compared

    def watched(batches, nearest):
        counts = {}

        def seen():
            for batch in batches:
                for key in zip(*(batch.column(c).to_pylist() for c in ("sig", "x", "y")), strict=True):
                    counts[key] = counts.get(key, 0) + 1
                yield batch

        yield from compared(seen(), nearest)
        assert max(counts.values(), default=0) <= 20  # of 60 sets with a signature in common

    monkeypatch.setattr(ngram_join, "_compared", watched)
    dealt = ngram_join._dealt
    monkeypatch.setattr(ngram_join, "_dealt", lambda *a: sizes.append(out := dealt(*a)) or out)
    rng = random.Random(21)
    base = prose(rng, 60, 10_000).split(" ")
    texts = []
    for i in range(60):  # a common half; a chain of threes at the end
        tail = [f"t{i // 3}x{k}" for k in range(30 + i % 7 * 5)]
        tail[(i % 3) * 9] = f"edit{i}"
        texts.append(" ".join(base + tail))
    texts += near_texts(13, 20)
    assert result(jaccard_classes(frame(spark, texts))) == brute(enumerate(texts))
    assert any(not d.where("x > 0").isEmpty() for d in sizes)


def test_common_passage_and_neighbours(spark, monkeypatch):
    """Expensive segments are put last and deletions make up for them: nothing is lost."""
    real = allocate

    def costly(counts, band):
        counts = counts.copy()
        counts[: len(counts) // 3] *= 100
        return real(counts + 1, band)

    monkeypatch.setattr(ngram_join, "allocate", costly)
    assert costly(np.ones(4 * 256), 8).deletions.sum() > 20
    texts = near_texts(7, 40)
    assert result(jaccard_classes(frame(spark, texts))) == brute(enumerate(texts))


def test_pairs_at_the_threshold(spark):
    rng = random.Random(3)
    texts = []
    for n in (4, 7, 8, 11, 16, 28, 32, 63, 64, 96, 128, 200, 256, 500):
        words = [f"v{rng.randrange(10**9)}" for _ in range(2 * n + 10)]
        for m in range(max(1, n * 3 // 4 - 2), n + 1):  # a prefix: J = m / n
            texts.append(" ".join(words[: m + 4]) if m in (n, -(-n * 3 // 4), n * 3 // 4 - 1, n * 3 // 4) else f"x{m} " * 6)
    assert result(jaccard_classes(frame(spark, texts))) == brute(enumerate(texts))


def test_ids_empty_table_and_stage(spark):
    a, b = prose(random.Random(1), 40), prose(random.Random(2), 40)
    rows = [(5, a), (5, a), (None, a), (3, a + " x"), (9, None), (None, b), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_classes(df).collect())
    n, m = len(shingles(a)), len(shingles(b))
    assert got == sorted([("5", n, "3"), ("5", n, "3"), ("None", n, "3"), ("3", n + 1, "3"), ("9", 0, "9"), ("9", 0, "9"), ("None", m, "None")])
    docs = frame(spark, [a, a + " x", b, None])
    kept = keep_one_of_each_class(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3] and kept.columns == docs.columns
    assert jaccard_classes(docs.where("false")).count() == 0


def test_one_row_of_each_class_stays(spark):
    """Rows are judged by id and text: other texts of an id stay, repeated rows do not."""
    a = " ".join(f"w{i}" for i in range(40))
    b, near = " ".join(f"v{i}" for i in range(40)), a + " tail"
    rows = [(1, a), (5, near), (5, b), (1, a), (1, a), (None, near + " x"), (None, "lone words of no other row"), (9, None), (9, None), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, keep_one_of_each_class(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (5, b), (None, "lone words of no other row"), (9, None), (9, None)], key=repr)
    # of equal ids one text stays
    two = spark.createDataFrame([(3, a), (3, near)], "doc_id long, text string")
    assert keep_one_of_each_class(two).count() == 1
    assert keep_one_of_each_class(docs.limit(0)).count() == 0


def test_components_grow_by_more_edges(spark):
    def frame(edges):
        return spark.createDataFrame(edges, "a long, b long")

    first = [(1, 2), (2, 3), (10, 11), (20, 21)]
    more = [(3, 11), (50, 51), (20, 60), (51, 5), (70, 2)]
    got = ngram_join._extended(components(frame(first)), frame(more))
    want = {r.node: r.root for r in components(frame(first + more)).collect()}
    assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)


def test_sketch_never_rules_out_a_link():
    rng = np.random.default_rng(1)
    for n in (1, 5, 200, 255, 256, 257, 3000):
        x = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        y = np.concatenate((x[: max(1, n * 3 // 4)], rng.integers(0, 2**63, 3, dtype=np.int64).astype(np.uint64)))
        a, b = (np.frombuffer(sketch(v), np.uint8)[None, :] for v in (x, y))
        w = min(a.shape[1], b.shape[1])
        differ = np.bitwise_count(_fold(a, w) ^ _fold(b, w)).sum()
        assert differ <= len(np.setxor1d(x, y))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(1000, x) for x in range(2000, 2400)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 401)} | {x: 1000 for x in (1000, *range(2000, 2400))}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_batch_is_worked_on_in_small_pieces():
    """Memory follows the piece, not the batch that Spark sends; no row is lost."""
    n = 2000
    texts = [" ".join(str((i * 7919 + j * j) % 100_003) for j in range(300)) for i in range(n)]
    ids = pa.array(range(n), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, pa.array(texts)], names=["id", "doc", "th", "text"])
    packed = next(iter(ngram_join._bodies(iter([batch.slice(0, 1)])))).column("z")[0].as_py()
    pairs = [pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([packed] * n), pa.array([packed] * n)]
    pairs = pa.RecordBatch.from_arrays(pairs, names=["a", "b", "za", "zb"])
    sizes = {}
    for name, given, work in (
        ("sets", batch, lambda b: ngram_join._sets(b, 5)),
        ("bodies", batch, ngram_join._bodies),
        ("linked", pairs, lambda b: ngram_join._linked(b, 5)),
    ):
        assert sum(out.num_rows for out in work(iter([given.slice(0, 1)]))) == 1  # tables that are kept
        tracemalloc.start()
        rows = sum(out.num_rows for out in work(iter([given])))
        sizes[name] = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert rows == n
    assert sizes["sets"] < 20 and sizes["bodies"] < 2, sizes
