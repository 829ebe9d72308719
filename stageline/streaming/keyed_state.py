"""State that streams keep by key, in folders whose content a commit log names.

``update_buckets``: one row per key in hash buckets. A micro-batch rewrites the buckets of
its own keys and no others; buckets that have grown are split by doubling their number.

``append_run``: a log of keyed rows, a run per micro-batch. As many runs of a level as
``fold`` become one run of the next, so that a reader opens few of them, however many
micro-batches there were, and each row is written once per level.

Both know a repeated micro-batch by its number, and leave what it has committed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stageline.session import drop_path
from stageline.sinks import commits

#: rows of a bucket beyond which the buckets are split
BUCKET_ROWS = 100_000
#: runs of one level that become one of the next
FOLD = 8
#: manifests that stay: the state, and the one before it for a repeated micro-batch
KEEP = 2


def _bucket(on: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(n)).cast("int")


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _read(spark: SparkSession, folder: str, held: dict[str, int], schema: str) -> DataFrame:
    """The rows of the given buckets, each in the micro-batch that wrote it last."""
    paths = [f"{folder}/batch_id={batch}/bucket={b}" for b, batch in held.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else _empty(spark, schema)


def _touched(rows: DataFrame, on: Sequence[str], n: int) -> list[str]:
    """The buckets of the rows: at most as many numbers as there are buckets."""
    return [str(r[0]) for r in rows.select(_bucket(on, n)).distinct().collect()]


def _write(rows: DataFrame, folder: str, batch_id: int, on: Sequence[str], n: int) -> dict[str, int]:
    """Write rows by bucket; returns the rows of each."""
    path = f"{folder}/batch_id={batch_id}"
    rows.withColumn("bucket", _bucket(on, n)).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    written = rows.sparkSession.read.schema("bucket int").parquet(path)
    return {str(r["bucket"]): r["count"] for r in written.groupBy("bucket").count().collect()}


def update_buckets(
    new: DataFrame,
    folder: str,
    batch_id: int,
    on: Sequence[str],
    schema: str,
    merge: Callable[[DataFrame], DataFrame],
    bucket_rows: int = BUCKET_ROWS,
) -> None:
    """Bring the rows of a micro-batch into the state: ``merge`` reduces old and new rows
    to one per key. Nothing is written for a micro-batch without rows."""
    spark = new.sparkSession
    version, content = commits.latest(spark, folder)
    if version > batch_id:
        return  # a repeat of what is committed
    n, held, rows = content.get("n", 1), dict(content.get("held", {})), dict(content.get("rows", {}))
    touched = _touched(new, on, n)
    if touched:
        old = _read(spark, folder, {b: held[b] for b in touched if b in held}, schema)
        counts = _write(merge(new.unionByName(old)), folder, batch_id, on, n)
        rows |= counts
        held |= dict.fromkeys(counts, batch_id)
        total = sum(rows.values())
        if total > n * bucket_rows:
            while total > n * bucket_rows:
                n *= 2
            # once per doubling: the whole state, in a folder beside that of the batch
            state = _read(spark, folder, held, schema)
            split = -1 - batch_id
            rows = _write(state, folder, split, on, n)
            held = dict.fromkeys(rows, split)
    commits.commit(spark, folder, batch_id + 1, {"n": n, "held": held, "rows": rows})
    if touched and batch_id not in held.values():
        drop_path(spark, f"{folder}/batch_id={batch_id}")  # it was split
    gone = [item for c in commits.forget(spark, folder, KEEP) for item in c["held"].items()]
    kept = [commits.manifest(spark, folder, v)["held"] for v in commits.versions(spark, folder)]
    for bucket, batch in set(gone):
        if not any(batch in k.values() for k in kept):
            drop_path(spark, f"{folder}/batch_id={batch}")
        elif not any(k.get(bucket) == batch for k in kept):
            drop_path(spark, f"{folder}/batch_id={batch}/bucket={bucket}")


def read_buckets(spark: SparkSession, folder: str, schema: str, on: Sequence[str], keys: DataFrame | None = None) -> DataFrame:
    """The state, or those of its buckets in which the keys of ``keys`` are."""
    content = commits.latest(spark, folder)[1]
    held = content.get("held", {})
    if keys is not None and len(held) > 1:
        held = {b: held[b] for b in _touched(keys, on, content["n"]) if b in held}
    return _read(spark, folder, held, schema)


def append_run(
    rows: DataFrame, folder: str, batch_id: int, combine: Callable[[DataFrame], DataFrame], schema: str, fold: int = FOLD
) -> None:
    """Add the rows of a micro-batch to the log; ``combine`` reduces rows to what counts."""
    spark = rows.sparkSession
    version, content = commits.latest(spark, folder)
    if content and batch_id <= content["last"]:
        return  # a repeat of what is committed
    runs, made = list(content.get("runs", [])), set()

    def store(df: DataFrame, level: int) -> None:
        name = f"run-{batch_id}-{level}-{uuid.uuid4().hex}"
        df.write.parquet(f"{folder}/{name}")
        made.add(name)
        runs.append({"name": name, "level": level})

    store(rows, 0)
    level = 0
    while len(full := [r for r in runs if r["level"] == level]) >= fold:
        runs = [r for r in runs if r["level"] != level]
        level += 1
        store(combine(spark.read.schema(schema).parquet(*[f"{folder}/{r['name']}" for r in full])), level)
    commits.commit(spark, folder, version + 1, {"last": batch_id, "runs": runs})
    gone = {r["name"] for c in commits.forget(spark, folder, KEEP) for r in c["runs"]}
    kept = {r["name"] for v in commits.versions(spark, folder) for r in commits.manifest(spark, folder, v)["runs"]}
    for name in (gone | made) - kept:  # what was folded at once no manifest names
        drop_path(spark, f"{folder}/{name}")


def read_runs(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All rows of the runs of the log, keys repeated; nothing is listed but their folders."""
    runs = commits.latest(spark, folder)[1].get("runs", [])
    paths = [f"{folder}/{r['name']}" for r in runs]
    return spark.read.schema(schema).parquet(*paths) if paths else _empty(spark, schema)
