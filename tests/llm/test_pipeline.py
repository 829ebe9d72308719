import random

import corpus_pipeline
from cases import edge_texts, frame, prose
from test_dedup_and_leaks import brute_contamination, brute_dedup
from test_ngram_join import brute, near_texts
from test_tokens_and_packing import check_packing

from stageline.llm.quality import quality_scores


def test_pipeline_stage_by_stage(spark, tmp_path):
    rng = random.Random(5)
    texts = edge_texts() + near_texts(5, 20)
    texts += [t.upper().replace(" ", "!! ") for t in texts[9:30]] + [prose(rng, 60) for _ in range(10)]
    docs = frame(spark, texts)
    labels = [(i, int("!!" not in (t or "")), 0) for i, t in enumerate(texts) if t]
    items = [(1, texts[-1]), (2, prose(rng, 30)), (3, texts[20])]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = {r.doc_id for r in quality_scores(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect() if r.predicted}
    wants = {
        "quality": lambda rows: good,
        "exact": lambda rows: {d for d, v in brute_dedup(rows).items() if v[2]},
        "near": lambda rows: {d for d, (n, c) in brute(rows).items() if c == d},
        "decontaminate": lambda rows: {d for d, v in brute_contamination(rows, items).items() if not v[4]},
    }
    rows = list(enumerate(texts))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{tmp_path}/{name}"
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        want = wants[name](rows)
        left = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
        assert [d for d, _ in left] == sorted(want) and 0 < len(left) < len(rows), name
        rows = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    place = {d: i for i, (d, _) in enumerate(rows)}
    moved = [type(r)(**{**r.asDict(), "doc_id": place[r.doc_id]}) for r in packed]
    check_packing(moved, [t for _, t in rows], 2048)
