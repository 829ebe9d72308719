"""Ready-messages: a folder of Parquet files that grows, read as a stream.

A message is one row: ``seq`` (its place in the order), ``job_name`` and
``job_instance`` (whose batch of loads it belongs to), ``body`` (a table name or
the end mark) and ``sent``. Files carry no order among themselves, so order is
always taken from ``seq``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stageline.session import drop_path, path_exists

MESSAGE_SCHEMA = (
    "seq bigint, job_name string, job_instance int, body string, sent timestamp_ntz"
)


def read_messages(
    spark: SparkSession,
    folder: str,
    schema: str = MESSAGE_SCHEMA,
    files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """The message folder as a stream; at most so many files per micro-batch.

    ``cleanSource="delete"`` removes the files of handled messages.
    """
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def drain(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Handle all messages that are there, micro-batch by micro-batch, and stop.

    With ``every`` (such as ``"15 seconds"``) go on with those that come later.
    A micro-batch is committed to the checkpoint after ``handle`` returns, which
    acknowledges its messages: a restart repeats at most the last batch, with the
    same number, and reads nothing that was done.
    """
    when = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(handle)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**when)
        .start()
    )


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Keep the rows of one micro-batch; a repeat of the batch replaces them."""
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def with_state(new: DataFrame, folder: str, batch_id: int, schema: str) -> DataFrame:
    """``new`` and the state that ``keep_state`` kept in the micro-batch before."""
    spark = new.sparkSession
    if not path_exists(spark, folder):
        return new
    before = read_batches(spark, folder, schema).where(F.col("batch_id") < batch_id)
    return new.unionByName(before.drop("batch_id"))


def keep_state(rows: DataFrame, folder: str, batch_id: int, schema: str) -> DataFrame:
    """Keep ``rows`` as the state after a micro-batch, and read it back.

    Only this state and the one before it stay, for a repeat of the batch; so what a
    micro-batch reads does not grow with their number.
    """
    spark = rows.sparkSession
    write_batch(rows, folder, batch_id)
    drop_path(spark, f"{folder}/batch_id={batch_id - 2}")
    return spark.read.schema(schema).parquet(f"{folder}/batch_id={batch_id}")


def read_batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The kept rows of all micro-batches, with their ``batch_id``."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(folder)
