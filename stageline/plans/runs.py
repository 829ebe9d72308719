"""Run requests: which may start, and with which arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline import schemas
from stageline.functions.params import max_capacity, run_arguments
from stageline.functions.text import explode_tables
from stageline.operators.lookups import active_tables, maybe_running, running_runs
from stageline.operators.membership import validate_requested


def decide_runs(
    requests: DataFrame,
    instances: DataFrame,
    runs: DataFrame,
    details: DataFrame,
    on: list[str] = schemas.INSTANCE_KEY,
) -> DataFrame:
    """Each request with its ``decision``, ``arguments`` and ``max_capacity``.

    A request is one row per instance: the key, whose last column is the instance,
    ``tables`` (a piped list, or null for all active tables), ``max_dpu``,
    ``incr_from``, ``incr_to``, ``context``. Decisions: ``no_instance``, ``overlap``
    (a run is still going), ``bad_tables`` (a listed table is not in the details),
    ``start``. Instances and runs hold their keys once.
    """
    known = instances.select(*on, "job_run_id", maybe_running().alias("_maybe"), F.lit(True).alias("_known"))
    running = running_runs(runs).select("job_run_id", F.lit(True).alias("_running"))
    listed = requests.where(F.col("tables").isNotNull()).select(*on, "tables")
    checked = validate_requested(explode_tables(listed, "tables"), details, on).select(*on, "valid")
    decision = (
        F.when(F.col("_known").isNull(), "no_instance")
        .when(F.col("_maybe") & F.col("_running"), "overlap")
        .when(~F.col("valid"), "bad_tables")
        .otherwise("start")
    )
    return (
        requests.join(known, on, "left")
        .join(checked, on, "left")
        .join(running, "job_run_id", "left")
        .select(
            *on,
            "tables",
            decision.alias("decision"),
            run_arguments(
                F.col(on[-1]),
                F.col("tables"),
                F.col("incr_from"),
                F.col("incr_to"),
                F.col("context"),
            ).alias("arguments"),
            max_capacity(F.col("max_dpu")).alias("max_capacity"),
        )
    )


def tables_to_load(
    decided: DataFrame, details: DataFrame, on: list[str] = schemas.INSTANCE_KEY
) -> DataFrame:
    """One row per table of the runs that start: the listed or else the active ones.

    ``decided`` is used twice; write it first when it is not a stored table.
    """
    started = decided.where(F.col("decision") == "start")
    listed = started.where(F.col("tables").isNotNull()).select(*on, "tables")
    default = started.where(F.col("tables").isNull()).select(*on)
    return explode_tables(listed, "tables").unionByName(active_tables(details, default, on))
