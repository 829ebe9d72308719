"""Counts and yes/no answers: flags, named tables, request checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline import schemas


def sync_flag_count(jobs: DataFrame) -> DataFrame:
    """``n`` flagged rows and whether there is any."""
    n = F.count(F.lit(1))
    return jobs.where(F.col("is_run_sync") == schemas.YES).agg(
        n.alias("n"), (n > 0).alias("is_running")
    )


def is_empty(df: DataFrame) -> DataFrame:
    """One row, ``is_empty``. Each task stops at its first row; none is counted further."""
    return df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def named_table_counts(
    details: DataFrame,
    names: DataFrame | list[str],
    on: list[str] = schemas.INSTANCE_KEY,
) -> DataFrame:
    """How many of the named tables each instance has, active or not.

    ``names`` is a short list, or a frame of any size that holds each
    ``table_name`` once.
    """
    if isinstance(names, DataFrame):
        named = details.join(names.select("table_name"), "table_name", "left_semi")
    else:
        named = details.where(F.col("table_name").isin(names))
    return named.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def validate_requested(
    requested: DataFrame, details: DataFrame, on: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """Check requested tables (one row per name) against the details.

    A request is valid when as many details rows match as names were asked for,
    repeats included; so a repeated or an empty name makes it invalid. Details
    hold each (instance, table) once.

    Repeats of a name are counted before the join, which also shrinks a request
    that asks for the same name very often; both sides then have each key once.
    """
    key = [*on, "table_name"]
    asked = requested.groupBy(*key).agg(F.count(F.lit(1)).alias("_times"))
    known = details.select(*key, F.lit(1).alias("_known"))
    requested_n = F.sum("_times")
    matched_n = F.count("_known")
    return (
        asked.join(known, key, "left")
        .groupBy(*on)
        .agg(
            requested_n.alias("requested"),
            matched_n.alias("matched"),
            (requested_n == matched_n).alias("valid"),
        )
    )


def batch_completeness(
    messages: DataFrame, expected: DataFrame, batch: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """Whether all messages of a batch arrived.

    ``expected`` holds the batch and ``expected`` once per batch; a batch of which
    nothing arrived has received 0.
    """
    received = messages.groupBy(*batch).agg(F.count(F.lit(1)).alias("received"))
    n = F.coalesce(F.col("received"), F.lit(0))
    return expected.join(received, batch, "left").select(
        *batch, "expected", n.alias("received"), (F.col("expected") == n).alias("complete")
    )
