"""Messages before the end mark of their batch, and messages that are not too old."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline import schemas


def end_marks(
    messages: DataFrame, is_mark: Column, batch: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """The first end mark of each batch that has one: the batch and ``stop_seq``."""
    return messages.where(is_mark).groupBy(*batch).agg(F.min("seq").alias("stop_seq"))


def before_end_mark(
    messages: DataFrame,
    marks: DataFrame,
    keep_open: bool = False,
    batch: list[str] = schemas.INSTANCE_KEY,
) -> DataFrame:
    """Messages ahead of the end mark of their batch.

    Batches without a mark are dropped, or kept whole with ``keep_open``.

    ``marks`` holds each batch once. One batch may hold much of all messages: give the
    marks as a stored table, so that both exchanges are directly under the join and
    AQE splits the batch by its measured size. Under an aggregate it cannot.
    """
    how = "left" if keep_open else "inner"
    joined = messages.join(marks.select(*batch, "stop_seq"), batch, how)
    ahead = F.col("seq") < F.col("stop_seq")
    if keep_open:
        ahead = F.col("stop_seq").isNull() | ahead
    return joined.where(ahead).select(*messages.columns)


def not_expired(
    messages: DataFrame,
    seen: DataFrame | None = None,
    seconds: int = schemas.RETENTION_SECONDS,
    sent: str = "sent",
) -> DataFrame:
    """Messages sent at most ``seconds`` before the newest in ``seen``, by default
    the newest of themselves.

    The cut-off is one value from a subquery, computed before the scan, so the
    filter is one on the stored column and skips row groups like a constant.
    """
    age = F.expr(f"interval {seconds} seconds")
    clock = messages if seen is None else seen
    cutoff = clock.agg((F.max(sent) - age).alias("cutoff")).scalar()
    return messages.where(F.col(sent) >= cutoff)
