"""Change plan: wanted jobs against listed jobs, as one full outer join.

Both sides hold each name once (operators.checks.duplicate_keys tells); a full
outer join cannot be broadcast or split, and needs neither on unique keys. The
plan is lazy, so a query that only counts actions reads four columns, while
``apply_changes`` takes its wide columns through the same single shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stageline import schemas
from stageline.functions.params import with_fields
from stageline.operators.membership import sync_flag_count
from stageline.operators.updates import mark_synced, set_sync_flag
from stageline.sinks.stage import refresh_stage


def merge_sides(wanted: DataFrame, listed: DataFrame, key: str = "job_name") -> DataFrame:
    """Full outer merge with ``merge_side`` left_only, right_only or both.

    Columns of ``listed`` other than the key are in the struct ``listed``. The
    sides are told by markers, not by data columns, which may be null.
    """
    others = [c for c in listed.columns if c != key]
    listed_cols = [F.struct(*others).alias("listed")] if others else []
    left = wanted.withColumn("_wanted", F.lit(True))
    right = listed.select(key, *listed_cols, F.lit(True).alias("_listed"))
    side = (
        F.when(F.col("_listed").isNull(), "left_only")
        .when(F.col("_wanted").isNull(), "right_only")
        .otherwise("both")
    )
    return (
        left.join(right, key, "full_outer")
        .withColumn("merge_side", side)
        .drop("_wanted", "_listed")
    )


def classify() -> Column:
    """The action of a merged row: create, update, delete or none.

    A job that is not active is deleted, and null counts as not active. An update
    needs a change that is newer than the last sync. Jobs that are only listed are
    not ours and are left alone.
    """
    side, active = F.col("merge_side"), F.col("is_active").eqNullSafe(schemas.YES)
    newer = F.col("modified_timestamp") > F.col("last_sync_timestamp")
    return (
        F.when((side == "left_only") & active, "create")
        .when((side == "both") & ~active, "delete")
        .when((side == "both") & newer, "update")
        .otherwise("none")
    )


def plan_changes(wanted: DataFrame, listed: DataFrame, key: str = "job_name") -> DataFrame:
    """Each wanted or listed job with its ``action``.

    Only the names of ``listed`` are used, each once: a name that the listing
    repeats very often is reduced before the shuffle and gets one action.
    """
    names = listed.select(key).distinct()
    return merge_sides(wanted, names, key).withColumn("action", classify())


def apply_changes(
    wanted: DataFrame,
    listed: DataFrame,
    columns: list[str],
    key: str = "job_name",
    params: str = "job_param",
) -> DataFrame:
    """The listed state after the plan: key and ``columns``.

    Created and updated jobs take the wanted values, with the defaults of the
    action for what is not set; the rest keeps the listed values. Wanted values
    are columns or fields of the JSON column ``params``, which is only parsed for
    the jobs that change. A name that the listing repeats counts once, as in the
    plan, with the greatest of its values.
    """
    others = [c for c in listed.columns if c != key]
    listed = listed.groupBy(key).agg(F.max(F.struct(*others)).alias("_last")).select(key, "_last.*")
    action = F.col("action")
    changes = action.isin("create", "update")
    stays = (F.col("merge_side") != "left_only") & (action != "delete")
    plan = merge_sides(wanted, listed, key).withColumn("action", classify())
    plan = plan.where(stays | (action == "create"))
    if params in wanted.columns:
        fields = {n: t for n, t in schemas.PARAM_TYPES.items() if n in columns}
        plan = with_fields(plan, F.when(changes, F.col(params)), fields)

    def value(name: str) -> Column:
        old = F.col("listed")[name] if name in listed.columns else F.lit(None)
        new = F.col(name) if name in plan.columns else F.lit(None)
        create = F.coalesce(new, F.lit(schemas.CREATE_DEFAULTS.get(name)))
        update = F.coalesce(new, F.lit(schemas.UPDATE_DEFAULTS.get(name)))
        if name in schemas.UPDATE_KEEPS:
            update = old
        return F.when(action == "create", create).when(action == "update", update).otherwise(old)

    return plan.select(key, *[value(c).alias(c) for c in columns])


def sync_cycle(
    spark: SparkSession,
    jobs_view: str,
    listed_view: str,
    root: str,
    columns: list[str],
    as_of: Column,
    buckets: int = 0,
) -> str:
    """Bring the listed stage table in line with the jobs stage table.

    Does nothing when a sync is flagged as running or there are no jobs; the flag is
    set for the time of the cycle, and cleared when it fails. ``as_of`` is the time
    before the jobs were read, and the stamp goes to the jobs as they are then, so that
    an edit between the two writes stays and is caught by the next cycle. With
    ``buckets`` both tables are stored by job name, and the next cycle merges them
    without a shuffle. Returns ``running``, ``empty`` or ``done``.
    """
    jobs = spark.table(jobs_view)
    if sync_flag_count(jobs).first()["is_running"]:
        return "running"
    if jobs.isEmpty():
        return "empty"

    def store(rows: DataFrame, view: str, folder: str) -> DataFrame:
        return refresh_stage(rows, view, f"{root}/{folder}", buckets, schemas.JOB_KEY)

    jobs = store(set_sync_flag(jobs, schemas.YES), jobs_view, "jobs")
    try:
        after = apply_changes(jobs, spark.table(listed_view), columns)
        store(after, listed_view, "listed")
        store(mark_synced(spark.table(jobs_view), as_of), jobs_view, "jobs")
    except Exception:
        store(set_sync_flag(spark.table(jobs_view), schemas.NO), jobs_view, "jobs")
        raise
    return "done"
