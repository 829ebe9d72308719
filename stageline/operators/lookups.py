"""Lookups in the control tables, for whole frames of keys at once.

Key frames hold each key once. No join is forced to broadcast: Spark does it when
the measured size is under ``spark.sql.autoBroadcastJoinThreshold``; above it the
join shuffles, and AQE splits a hot key of the many-rows side, which is kept
directly under the join for that. A many-rows side that is only asked for
existence is reduced to its keys before the shuffle instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline import schemas


def active_tables(
    details: DataFrame, keys: DataFrame | None = None, on: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """The active tables of the instances in ``keys``, or of all instances."""
    active = details.where(F.col("is_active") == schemas.YES).select(*on, "table_name")
    return active if keys is None else active.join(keys.select(*on), on, "left_semi")


def active_table_counts(details: DataFrame, on: list[str] = schemas.INSTANCE_KEY) -> DataFrame:
    """How many active tables each instance has."""
    active = details.where(F.col("is_active") == schemas.YES)
    return active.groupBy(*on).agg(F.count(F.lit(1)).alias("n_tables"))


def run_lookup(
    instances: DataFrame, keys: DataFrame, on: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """Stored run id and state of the instances in ``keys``; none for unknown keys."""
    return instances.join(keys.select(*on), on, "left_semi").select(
        "job_name", "job_instance", "job_run_id", "status"
    )


def maybe_running() -> Column:
    """Whether the stored state leaves it open that the run is still going."""
    return F.col("status").isin([*schemas.STATES_RUNNING, schemas.STATE_UNKNOWN])


def running_runs(runs: DataFrame) -> DataFrame:
    """Runs that are going by their true state."""
    return runs.where(F.col("actual_status").isin(schemas.STATES_RUNNING)).select(
        "job_run_id", "actual_status"
    )


def overlap_gate(instances: DataFrame, runs: DataFrame) -> DataFrame:
    """Instances whose last run is still going, so that no new run may start.

    The true state is asked only where the stored one is not final; rows without
    a run id never match.
    """
    open_runs = instances.where(maybe_running()).select("job_name", "job_instance", "job_run_id")
    return open_runs.join(running_runs(runs), "job_run_id").select(
        "job_name", "job_instance", "job_run_id", "actual_status"
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that carry an error text."""
    return runs.where(F.col("error_message").isNotNull())


def active_instances(jobs: DataFrame, instances: DataFrame) -> DataFrame:
    """Instances of active jobs."""
    active = jobs.where(F.col("is_active") == schemas.YES).select("job_name")
    return active.join(instances.select("job_name", "job_instance"), "job_name")


def jobs_with_instances(jobs: DataFrame, instances: DataFrame) -> DataFrame:
    """Active jobs that have any instance."""
    active = jobs.where(F.col("is_active") == schemas.YES).select("job_name")
    return active.join(instances.select("job_name").distinct(), "job_name", "left_semi")
