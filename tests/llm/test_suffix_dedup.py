import hashlib
import random

import numpy as np
import pytest
from cases import clashing, edge_texts, frame, prose

from stageline.llm.suffix_dedup import refine, suffix_dedup


def brute(rows, length=100):
    """rows of (id, text) in order; per id sizes, digest and spans."""
    seen, out = set(), {}
    for doc, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            part = body[i : i + length]
            if part in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(part)
        left = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(body), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


def result(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def texts():
    rng = random.Random(4)
    out = edge_texts()
    passage = prose(rng, 40)
    out += [prose(rng, rng.randrange(3)) + passage + prose(rng, rng.randrange(4)) for _ in range(40)]
    out += ["ab" * 400, "ba" * 90, "x" * 99, "x" * 100, "x" * 101, "abc" * 33, passage[:99], passage[:100], passage[1:101]]
    out += ["".join(rng.choice("ab") for _ in range(2000)) for _ in range(3)]
    out += [out[-1][500:900] + "c" + out[-2][100:350], "\n".join([passage[:50], passage[50:120]] * 5)]
    return out


@pytest.mark.parametrize("large", [2_000_000, 30])
def test_against_brute_force(spark, large):
    rows = texts()
    want = brute(enumerate(rows))
    got = result(suffix_dedup(clashing(frame(spark, rows).repartition(5)), bucket_suffixes=large))
    assert {k: (v, want[k]) for k, v in got.items() if v != want[k]} == {}
    assert len(got) == len(rows) and sum(v[1] for v in want.values()) > 5000


def test_other_lengths(spark):
    rows = texts()[:40]
    assert result(suffix_dedup(frame(spark, rows), length=37, gram=8)) == brute(enumerate(rows), 37)


def test_null_ids_repeated_rows_and_empty_table(spark):
    a, b = "one two three four " * 8, "x" * 40 + "one two three four " * 6
    rows = [(5, a), (5, a), (None, a), (9, None), (2, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix_dedup(df).collect())
    want = brute([(2, b), (5, a), ("None", a), (9, None)])
    assert out == sorted([*((str(k), *v[:2]) for k, v in want.items()), ("5", *want[5][:2])])
    assert suffix_dedup(df.where("false")).count() == 0


def test_text_left(spark):
    rows = ["lorem ipsum " * 20, "head " + "lorem ipsum " * 20 + "tail"]
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup(frame(spark, rows), with_text=True).collect()}
    for doc, left in kept.items():
        assert hashlib.sha256(left).hexdigest() == brute(enumerate(rows))[doc][3]


def test_refine_against_sets():
    rng = np.random.default_rng(3)
    for letters, n in ((1, 400), (2, 3000), (4, 5000)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2 : n // 2 + 150] = data[:150]
        bounds = np.array([0, 130, 150, 151, n // 2, n])
        for length in (5, 8, 13, 100):
            again, seen = refine(data, bounds, length), set()
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                for i in range(a, b):
                    part = data[i : i + length].tobytes() if i + length <= b else None
                    assert again[i] == (part in seen)
                    if part:
                        seen.add(part)
