"""Message-driven loads: each message names a table that is ready to be loaded.

Every step keeps what it decided per micro-batch in a folder under ``root``, so
that a later micro-batch or a report can read it, and a repeated one replaces it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stageline import schemas
from stageline.functions.text import strip
from stageline.operators.end_mark import before_end_mark, end_marks, not_expired
from stageline.operators.updates import stamp_details
from stageline.sinks.stage import change_stage, open_stage, refresh_stage
from stageline.sinks.tables import in_flight, overwrite_partitions
from stageline.sources.files import read_partitions
from stageline.streaming.keyed_state import read_buckets, update_buckets
from stageline.streaming.messages import drain, keep_state, read_batches, with_state, write_batch
from stageline.streaming.order import in_order

BATCH = schemas.INSTANCE_KEY
LOADS = "job_name string, job_instance int, table_name string, n_messages bigint, last_seq bigint"
MARKS = "job_name string, job_instance int, stop_seq bigint"


def named_tables(messages: DataFrame) -> DataFrame:
    """The tables that messages name: one row per batch and table, with the count
    of messages and the last sequence number.

    A load is a full refresh, so many messages for one table need one load.
    """
    return messages.groupBy(*BATCH, strip(F.col("body")).alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.max("seq").alias("last_seq")
    )


def before_known_marks(
    messages: DataFrame, batch_id: int, root: str, mark: str = schemas.END_MARK
) -> DataFrame:
    """Messages of a micro-batch ahead of the end mark of their batch, if it is known.

    Messages come in order, as from a FIFO queue or from ``order.in_order``: none that
    precedes a mark comes in a later micro-batch than the mark. Known marks are kept in hash buckets: a
    micro-batch reads the buckets of its own batches, and writes those of its new marks.
    """
    spark = messages.sparkSession
    folder = f"{root}/known_marks"
    write_batch(end_marks(messages, strip(F.col("body")) == mark), f"{root}/marks", batch_id)
    new = spark.read.schema(MARKS).parquet(f"{root}/marks/batch_id={batch_id}")
    update_buckets(new, folder, batch_id, BATCH, MARKS, _first_marks)
    marks = read_buckets(spark, folder, MARKS, BATCH, messages)
    return before_end_mark(messages, marks, keep_open=True)


def _first_marks(marks: DataFrame) -> DataFrame:
    return marks.groupBy(*BATCH).agg(F.min("stop_seq").alias("stop_seq"))


def not_expired_so_far(
    messages: DataFrame, batch_id: int, root: str, seconds: int = schemas.RETENTION_SECONDS
) -> DataFrame:
    """Messages of a micro-batch that are not older than ``seconds`` against the
    newest message seen in this or an earlier one."""
    dtype = messages.schema["sent"].dataType.simpleString()
    sent = with_state(messages.select("sent"), f"{root}/newest", batch_id, f"sent {dtype}")
    newest = sent.agg(F.max("sent").alias("sent"))
    return not_expired(messages, keep_state(newest, f"{root}/newest", batch_id, f"sent {dtype}"), seconds)


def _known(tables: Iterable[str]) -> Column:
    return F.col("table_name").isin(list(tables)).eqNullSafe(True)


def _known_names(named: DataFrame, tables: Iterable[str], root: str, batch_id: int) -> list[str]:
    """The tables to load: at most as many as there are in ``tables``. Other names are
    set aside in the folder ``rejected``."""
    write_batch(named.where(~_known(tables)), f"{root}/rejected", batch_id)
    return [r["table_name"] for r in named.where(_known(tables)).select("table_name").distinct().collect()]


def _take(messages, batch_id, root, mark, seconds) -> DataFrame:
    """Note in the load log what the micro-batch names, and read it back."""
    spark = messages.sparkSession
    taken = messages
    if seconds is not None:
        taken = not_expired_so_far(taken, batch_id, root, seconds)
    if mark is not None:
        taken = before_known_marks(taken, batch_id, root, mark)
    write_batch(named_tables(taken), f"{root}/loads", batch_id)
    return spark.read.schema(LOADS).parquet(f"{root}/loads/batch_id={batch_id}")


def _taken_by(handle: Callable[[DataFrame, int], None], root: str, first: int | None):
    return handle if first is None else in_order(handle, root, first)


def run_table_loads(
    stream: DataFrame,
    sources: Mapping[str, str],
    stage_view: str,
    root: str,
    details_view: str | None = None,
    as_of: Column | None = None,
    mark: str | None = schemas.END_MARK,
    seconds: int | None = None,
    every: str | None = None,
    first: int | None = None,
) -> StreamingQuery:
    """Refresh the stage table of every table that is named, then stamp its details.

    ``sources`` maps the tables that may be loaded to their Parquet folders;
    ``stage_view`` is the view name with ``{}`` for the table. Messages after the
    end mark of their batch, or older than ``seconds``, load nothing. Names that have
    no source load nothing either; ``rejected_report`` gives them. What reaches the
    driver is at most one row per entry of ``sources``. Stamps are written as keyed changes
    of the details table at ``root/details``, so that what a micro-batch writes follows
    its messages. A new session goes on where the last one ended: the stage tables that
    were loaded before are opened from their commit logs. Files in any order are taken in
    that of ``seq`` where ``first``, the number of the first message, is given.
    """
    details = f"{root}/details"
    for table in sources:
        open_stage(stream.sparkSession, stage_view.format(table), f"{root}/{table}")
    if details_view and open_stage(stream.sparkSession, details_view, details) is None:
        refresh_stage(stream.sparkSession.table(details_view), details_view, details)

    def handle(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        named = _take(messages, batch_id, root, mark, seconds)

        def load(table):
            return lambda: refresh_stage(
                spark.read.parquet(sources[table]), stage_view.format(table), f"{root}/{table}"
            )

        names = _known_names(named, sources, root, batch_id)
        in_flight([load(t) for t in names], spark)
        if details_view and names:
            loaded = named.where(_known(sources))
            kind = spark.table(details_view).schema["last_run_timestamp"].dataType
            keys = loaded.select(*schemas.DETAIL_KEY).distinct()
            keys = keys.withColumn("last_run_timestamp", F.lit(None).cast(kind))
            change_stage(stamp_details(keys, loaded, as_of), details_view, details, schemas.DETAIL_KEY)

    return drain(stream, _taken_by(handle, root, first), f"{root}/checkpoint", every=every)


def run_partition_loads(
    stream: DataFrame,
    tables: Iterable[str],
    source: str,
    stage: str,
    root: str,
    mark: str | None = schemas.END_MARK,
    seconds: int | None = None,
    every: str | None = None,
    first: int | None = None,
) -> StreamingQuery:
    """Like ``run_table_loads`` for ``tables`` of one schema kept in one dataset.

    Source and stage are partitioned by ``table_name``; a micro-batch is one job
    that reads only the named partitions and replaces them in the stage.
    """
    tables = list(tables)

    def handle(messages: DataFrame, batch_id: int) -> None:
        named = _take(messages, batch_id, root, mark, seconds)
        names = _known_names(named, tables, root, batch_id)
        if names:
            rows = read_partitions(messages.sparkSession, source, F.col("table_name").isin(names))
            overwrite_partitions(rows, stage, ["table_name"])

    return drain(stream, _taken_by(handle, root, first), f"{root}/checkpoint", every=every)


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """Per table: messages taken and the last of them, over all micro-batches."""
    return (
        read_batches(spark, f"{root}/loads", LOADS)
        .groupBy("table_name")
        .agg(F.sum("n_messages").alias("n_messages"), F.max("last_seq").alias("last_seq"))
    )


def rejected_report(spark: SparkSession, root: str) -> DataFrame:
    """The names without a source that messages gave, per batch of messages."""
    return read_batches(spark, f"{root}/rejected", LOADS).drop("batch_id")


def batch_report(spark: SparkSession, root: str, expected: DataFrame | None = None) -> DataFrame:
    """Messages taken per batch that has its end mark; open batches are left out.

    With ``expected`` (the batch and its stated size) also whether all arrived.
    """
    taken = (
        read_batches(spark, f"{root}/loads", LOADS)
        .groupBy(*BATCH)
        .agg(F.sum("n_messages").alias("n_messages"))
    )
    marks = read_batches(spark, f"{root}/marks", MARKS).select(*BATCH).distinct()
    n = F.coalesce(F.col("n_messages"), F.lit(0).cast("bigint"))
    report = marks.join(taken, BATCH, "left").select(*BATCH, n.alias("n_messages"))
    if expected is None:
        return report
    complete = F.col("n_messages") == F.col("expected")
    return report.join(expected, BATCH, "left").withColumn("complete", complete)


def run_until_end_mark(
    stream: DataFrame,
    root: str,
    mark: str = schemas.END_MARK,
    every: str | None = None,
    first: int | None = None,
) -> StreamingQuery:
    """Take the messages of each batch up to its end mark, for ``batch_report``."""

    def handle(messages: DataFrame, batch_id: int) -> None:
        _take(messages, batch_id, root, mark, None)

    return drain(stream, _taken_by(handle, root, first), f"{root}/checkpoint", every=every)


def run_retention(
    stream: DataFrame,
    root: str,
    seconds: int = schemas.RETENTION_SECONDS,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the messages that had not expired when their micro-batch was taken."""

    def handle(messages: DataFrame, batch_id: int) -> None:
        live = not_expired_so_far(messages, batch_id, root, seconds)
        write_batch(live, f"{root}/kept", batch_id)

    return drain(stream, handle, f"{root}/checkpoint", every=every)
