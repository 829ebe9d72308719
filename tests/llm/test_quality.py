import random
import zlib

import numpy as np
import pytest
from cases import clashing, edge_texts, frame, prose

from stageline.llm.quality import STATISTICS, document_statistics, keep_good, pool_adjacent, quality_scores


def labelled(spark, n=400):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(20, 120))
        texts.append(text if good else text.upper().replace(" ", "!! "))
        labels.append((i, int(good), 0))
    texts += [None, "", " \n", "x" * 50_000]
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), texts, labels


def test_held_out_accuracy(spark):
    docs, labels, texts, known = labelled(spark)
    rows = {r.doc_id: r for r in quality_scores(clashing(docs), labels).collect()}
    assert sorted(rows) == list(range(len(texts)))
    for doc, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [(rows[i].predicted, good) for i, good, _ in known if rows[i].held_out]
    assert len(held) > 60 and np.mean([p == g for p, g in held]) > 0.95
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in rows.items() if r.predicted}


def test_score_sees_only_the_text(spark):
    docs, labels, _, _ = labelled(spark, 120)
    other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'other' as source", "0L as n_chars")
    a = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_scores(other, labels).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_held_out_labels_are_not_learned(spark):
    docs, labels, _, _ = labelled(spark, 120)
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 4) = 2 then 1 - quality else quality end as quality")
    a = {r.doc_id: r.score for r in quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_scores(docs, turned).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_empty_tables_and_odd_labels(spark):
    docs, labels, _, _ = labelled(spark, 40)
    assert quality_scores(docs.where("false"), labels).count() == 0
    assert {r.score for r in quality_scores(docs, labels.where("false")).collect()} == {0.5}
    odd = labels.unionByName(spark.createDataFrame([(0, 0, 0), (0, 1, 0), (None, 1, 0), (3, None, 0), (10**9, 1, 1)], labels.schema))
    assert quality_scores(docs, odd).count() == docs.count()


def test_statistics_do_not_depend_on_neighbours():
    texts = [t or "" for t in edge_texts()]
    joined = b"".join(t.encode() for t in texts)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    all_rows = document_statistics(np.frombuffer(joined, np.uint8), ends)
    for t, row in zip(texts, all_rows, strict=True):
        alone = document_statistics(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert alone.shape == (1, len(STATISTICS)) and np.allclose(alone[0], row)


def test_pool_adjacent():
    rng = np.random.default_rng(0)
    value, weight = rng.random(50), rng.integers(1, 5, 50)
    out = pool_adjacent(value, weight)
    assert (np.diff(out) >= 0).all() and np.isclose((out * weight).sum(), (value * weight).sum())
    assert np.allclose(pool_adjacent(np.sort(value), weight), np.sort(value))
