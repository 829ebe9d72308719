import hashlib
import random
import re

import pytest
from cases import clashing, edge_texts, frame, prose

from stageline.llm.decontaminate import contamination, drop_contaminated
from stageline.llm.exact_dedup import drop_repeats, exact_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(rows, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if own := known.get(tuple(w[i : i + n])):
                    found |= own
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


@pytest.mark.parametrize("max_sent", [10**6, 0])
def test_contamination_against_brute_force(spark, max_sent):
    texts = edge_texts()
    items = [(100, texts[40]), (7, texts[12]), (8, texts[12]), (9, None), (10, "A"), (11, "!!"), (12, "word word word")]
    items += [(13, " ".join(texts[20].split(" ")[:14])), (14, texts[8])]
    docs, bench = frame(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    got = contamination(clashing(docs), clashing(bench), max_sent=max_sent)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()}
    want = brute_contamination(enumerate(texts), items)
    assert got == want
    assert 3 < sum(x[4] for x in want.values()) < len(texts)


def test_contamination_empty_sides(spark):
    docs, bench = frame(spark, ["a b", None]), spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in contamination(docs, bench).collect()] == [0, 0]
    assert contamination(docs.where("false"), bench).count() == 0
    assert drop_contaminated(docs, bench).count() == 2


def test_clean_documents_stay(spark):

    rng = random.Random(3)
    texts = [prose(rng, 40) for _ in range(6)]
    bench = spark.createDataFrame([(1, texts[2]), (2, prose(rng, 40))], "item_id long, text string")
    stay = drop_contaminated(frame(spark, texts), bench)
    assert sorted(r.doc_id for r in stay.collect()) == [0, 1, 3, 4, 5]
    assert stay.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("max_sent", [0, 10, 1_000_000])
def test_rows_are_judged_by_their_own_text(spark, max_sent):
    """Null, repeated and equal ids: a clean row never goes with a hit one, at any size."""
    rng = random.Random(4)
    bad, clean = prose(rng, 30), [prose(rng, 30) for _ in range(3)]
    rows = [(5, bad, "x"), (5, clean[0], "x"), (None, bad, "y"), (None, clean[1], "y"), (7, clean[2], "z"), (7, clean[2], "z"), (8, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    bench = spark.createDataFrame([(1, bad), (2, "short one")], "item_id long, text string")
    stay = drop_contaminated(docs, bench, max_sent=max_sent)
    assert stay.columns == docs.columns
    assert sorted(map(tuple, stay.collect()), key=repr) == sorted((r for r in rows if r[1] != bad), key=repr)
    assert drop_contaminated(docs, bench.limit(0), max_sent=max_sent).count() == len(rows)
    assert drop_contaminated(docs.limit(0), bench, max_sent=max_sent).count() == 0


def brute_dedup(rows):
    groups, out = {}, {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc, text or ""))
    for key, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1]), r[0]))[0]
        for doc, _ in own:
            out[doc] = (keep, len(own), doc == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


def test_exact_dedup_against_brute_force(spark):
    texts = edge_texts() + ["a b", "ab", "a  b", "a\x0bb", "a b"]
    docs = frame(spark, texts)
    want = brute_dedup(enumerate(texts))
    got = exact_dedup(clashing(docs))
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got.collect()} == want
    stay = drop_repeats(docs)
    assert sorted(r.doc_id for r in stay.collect()) == sorted(k for k, v in want.items() if v[2])
    assert stay.columns == docs.columns
    assert exact_dedup(docs.where("false")).count() == drop_repeats(docs.where("false")).count() == 0


def test_dedup_with_null_and_repeated_ids(spark):
    rows = [(None, "a"), (3, "a"), (3, "a"), (None, "b"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup(docs).collect())
    assert got == [("3", "3", 3, True), ("3", "3", 3, True), ("5", "5", 1, True), ("None", "3", 3, False), ("None", "None", 1, True)]
    assert sorted(str(r.text) for r in drop_repeats(docs).collect()) == ["None", "a", "b"]


def test_dedup_runs_no_python(spark):
    plan = exact_dedup(frame(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
