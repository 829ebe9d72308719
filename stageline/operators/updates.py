"""Updates of control tables. Each gives a new frame; a stage writer stores it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline import schemas
from stageline.functions.params import now_utc


def set_sync_flag(jobs: DataFrame, flag: str) -> DataFrame:
    """Set the sync flag on all rows."""
    return jobs.withColumn("is_run_sync", F.lit(flag))


def mark_synced(jobs: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Stamp all rows, changed or not, and clear the sync flag."""
    return jobs.withColumns(
        {
            "last_sync_timestamp": now_utc() if as_of is None else as_of,
            "is_run_sync": F.lit(schemas.NO),
        }
    )


def keyed_update(
    table: DataFrame,
    updates: DataFrame,
    on: list[str],
    columns: list[str],
    latest_by: str | None = None,
) -> DataFrame:
    """Set ``columns`` where the key is in ``updates``; no row is added or lost.

    Updates are reduced to one row per key: the latest by ``latest_by``, the greatest
    values among equally late ones. Without ``latest_by`` a key may repeat only with
    equal values; different ones have no order, and the query fails. A null in
    ``updates`` is a value and is set. Columns keep their types.
    """
    new = F.struct(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in columns])
    if latest_by is None:
        differ = F.raise_error(F.lit("updates of one key differ and have no order"))
        last = F.when(F.min(new).eqNullSafe(F.max(new)), F.max(new)).otherwise(differ)
    else:
        last = F.max_by(new, F.struct(F.col(latest_by).isNotNull(), latest_by, new))
    updates = updates.groupBy(*on).agg(last.alias("_new"))
    changed = F.col("_new").isNotNull()
    return table.join(updates, on, "left").select(
        *[
            F.when(changed, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else c
            for c in table.columns
        ]
    )


def update_instances(
    instances: DataFrame,
    updates: DataFrame,
    on: list[str] = schemas.INSTANCE_KEY,
    latest_by: str | None = None,
) -> DataFrame:
    """Set run id and state of the instances in ``updates``."""
    return keyed_update(instances, updates, on, ["job_run_id", "status"], latest_by)


def mark_started(
    instances: DataFrame, started: DataFrame, on: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """Store the run id of new runs; their state is unknown until they report."""
    updates = started.select(*on, "job_run_id", F.lit(schemas.STATE_UNKNOWN).alias("status"))
    return update_instances(instances, updates, on)


def mark_ended(
    instances: DataFrame,
    states: DataFrame,
    on: list[str] = schemas.INSTANCE_KEY,
    latest_by: str | None = None,
) -> DataFrame:
    """Store the last state of the runs that have ended; others are not touched."""
    ended = states.where(F.col("status").isin(schemas.STATES_TERMINAL))
    return update_instances(instances, ended, on, latest_by)


def stamp_details(
    details: DataFrame,
    loaded: DataFrame,
    as_of: Column | None = None,
    on: list[str] = schemas.DETAIL_KEY,
) -> DataFrame:
    """Stamp the last run of the tables in ``loaded``."""
    stamp = now_utc() if as_of is None else as_of
    updates = loaded.select(*on, stamp.alias("last_run_timestamp"))
    return keyed_update(details, updates, on, ["last_run_timestamp"])
