"""The change plan: edge rows, pandas as a second opinion, apply and plan again."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stageline.plans import sync
from stageline.plans.sync import apply_changes, plan_changes, sync_cycle
from stageline.registry import fixtures as fx
from stageline.sinks.stage import refresh_stage

WANTED = (
    "job_name string, is_active string, modified_timestamp timestamp_ntz, "
    "last_sync_timestamp timestamp_ntz"
)


def wanted_frame(spark, rows):
    df = spark.createDataFrame(rows, "k string, a string, m string, s string")
    return df.select(
        F.col("k").alias("job_name"),
        F.col("a").alias("is_active"),
        F.col("m").cast("timestamp_ntz").alias("modified_timestamp"),
        F.col("s").cast("timestamp_ntz").alias("last_sync_timestamp"),
    )


def names(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "job_name string")


def actions(df):
    return {r["job_name"]: r["action"] for r in df.collect()}


def test_edge_rows(spark):
    wanted = wanted_frame(
        spark,
        [
            ("a", "Y", "2024-01-02", "2024-01-01"),
            ("b", "Y", "2024-01-02", "2024-01-02"),
            ("c", None, "2024-01-02", None),
            ("d", "N", "2024-01-02", None),
            ("e", "Y", "2024-01-02", "2024-01-01"),
            ("f", "N", "2024-01-02", None),
            ("g", "Y", "2024-01-02", None),
            ("h", None, "2024-01-02", "2024-01-01"),
        ],
    )
    listed = names(spark, "abcdgz")
    assert actions(plan_changes(wanted, listed)) == {
        "a": "update",
        "b": "none",  # equal is not newer
        "c": "delete",  # null counts as not active
        "d": "delete",
        "e": "create",
        "f": "none",
        "g": "none",  # a null stamp is not older
        "h": "none",  # not active and not listed
        "z": "none",  # not ours
    }


def pandas_actions(wanted, listed):
    left = pd.DataFrame(wanted, columns=["k", "active", "modified", "synced"])
    left["modified"] = pd.to_datetime(left["modified"])
    left["synced"] = pd.to_datetime(left["synced"])
    both = left.merge(pd.DataFrame({"k": listed}, dtype=object), on="k", how="outer", indicator="side")
    out = pd.Series("none", index=both.index)
    active = both["active"] == "Y"
    out[(both["side"] == "left_only") & active] = "create"
    out[(both["side"] == "both") & active & (both["modified"] > both["synced"])] = "update"
    out[(both["side"] == "both") & ~active] = "delete"
    return dict(zip(both["k"], out))


days = st.sampled_from([None, "2024-01-01", "2024-01-02", "2024-01-03"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.dictionaries(
        st.sampled_from("abcdefghij"),
        st.tuples(st.sampled_from([None, "Y", "N", "y", ""]), days, days),
        min_size=1,
    ),
    listed=st.sets(st.sampled_from("abcdefghijklm")),
)
def test_same_as_pandas(spark, rows, listed):
    wanted = [(k, *v) for k, v in rows.items()]
    plan = plan_changes(wanted_frame(spark, wanted), names(spark, sorted(listed)))
    assert actions(plan) == pandas_actions(wanted, sorted(listed))


def test_actions_cover_the_merged_keys(spark, sf_dir):
    jobs, listed = fx.jobs(spark, sf_dir), fx.listed(spark, sf_dir).select("job_name")
    plan = plan_changes(jobs, listed)
    keys = jobs.select("job_name").union(listed).distinct().count()
    assert plan.count() == keys == plan.select("job_name").distinct().count()


def test_defaults_by_action(spark):
    wanted = wanted_frame(
        spark,
        [("new", "Y", "2024-01-02", "1970-01-01"), ("old", "Y", "2024-01-02", "1970-01-01")],
    ).withColumn(
        "job_param",
        F.when(F.col("job_name") == "new", '{"max_retries": "7"}').otherwise('{"glue_version": "9"}'),
    )
    listed = spark.createDataFrame(
        [("old", "1.0", 5, 5, "2"), ("other", "0.9", 6, 6, "2")],
        "job_name string, glue_version string, max_retries int, max_concurrent_runs int, python_version string",
    )
    columns = [
        "command_name", "python_version", "glue_version",
        "max_concurrent_runs", "max_retries", "timeout_minutes",
    ]
    result = {r[0]: tuple(r)[1:] for r in apply_changes(wanted, listed, columns).collect()}
    assert result == {
        "new": ("glueetl", "3", None, 10, 7, 180),
        "old": ("glueetl", "2", "1.0", 3, 1, 180),
        "other": (None, "2", "0.9", 6, 6, None),
    }


def test_cycle_twice(spark, sf_dir, shared):
    """After a sync, unchanged jobs need nothing; an edit after the stamp is caught."""
    stamp = F.lit("2030-01-01").cast("timestamp_ntz")
    name = shared.rsplit("-", 1)[-1]
    jobs_view, listed_view = f"jobs_{name}", f"listed_{name}"
    jobs = fx.jobs(spark, sf_dir).withColumn("is_run_sync", F.lit("N"))
    refresh_stage(jobs, jobs_view, f"{shared}/jobs")
    refresh_stage(fx.listed(spark, sf_dir), listed_view, f"{shared}/listed")
    columns = ["job_description", "glue_version", "max_retries", "timeout_minutes"]
    before = plan_changes(spark.table(jobs_view), spark.table(listed_view))
    assert before.where("action <> 'none'").count() > 0

    assert sync_cycle(spark, jobs_view, listed_view, shared, columns, stamp) == "done"
    after = plan_changes(spark.table(jobs_view), spark.table(listed_view))
    assert after.where("action <> 'none'").count() == 0
    assert spark.table(jobs_view).where("last_sync_timestamp <> timestamp_ntz '2030-01-01'").isEmpty()

    edited = spark.table(jobs_view).withColumn(
        "modified_timestamp",
        F.when(F.col("is_active") == "Y", F.lit("2030-01-02").cast("timestamp_ntz")).otherwise(
            F.col("modified_timestamp")
        ),
    )
    refresh_stage(edited, jobs_view, f"{shared}/jobs")
    again = plan_changes(spark.table(jobs_view), spark.table(listed_view))
    assert {r["action"] for r in again.collect()} == {"none", "update"}

    # a running sync and an empty table stop the cycle
    flagged = spark.table(jobs_view).withColumn("is_run_sync", F.lit("Y"))
    refresh_stage(flagged, jobs_view, f"{shared}/jobs")
    assert sync_cycle(spark, jobs_view, listed_view, shared, columns, stamp) == "running"
    refresh_stage(spark.table(jobs_view).where("false"), jobs_view, f"{shared}/jobs")
    assert sync_cycle(spark, jobs_view, listed_view, shared, columns, stamp) == "empty"


def test_repeated_listing_gives_one_action(spark):
    wanted = wanted_frame(spark, [("a", "N", "2024-01-02", None)])
    listed = names(spark, ["a"] * 1000 + ["z"])
    plan = plan_changes(wanted, listed)
    assert sorted(r["action"] for r in plan.collect()) == ["delete", "none"]


@pytest.mark.parametrize("fails", [False, True])
def test_edit_during_a_cycle(spark, shared, monkeypatch, fails):
    """The flag is set while the cycle runs; an edit between its writes stays and is
    caught by the next cycle; a failure clears the flag."""
    tag = shared.rsplit("-", 1)[-1]
    jobs_view, listed_view = f"jobs_{tag}", f"listed_{tag}"
    jobs = spark.sql(
        "select 'a' as job_name, 'old' as job_description, 'Y' as is_active, 'N' as is_run_sync,"
        " timestamp_ntz'2001-01-01 00:00:00' as modified_timestamp,"
        " timestamp_ntz'1970-01-01 00:00:00' as last_sync_timestamp"
    )
    listed = spark.createDataFrame([], "job_name string, job_description string")
    refresh_stage(jobs, jobs_view, f"{shared}/jobs")
    refresh_stage(listed, listed_view, f"{shared}/listed")
    stamp, real, flags = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"), refresh_stage, []

    def edited(rows, view, *more):
        result = real(rows, view, *more)
        if view == listed_view:
            now = spark.table(jobs_view)
            flags.append(now.first()["is_run_sync"])
            if fails:
                raise RuntimeError("lost")
            now = now.withColumns({"job_description": F.lit("new"), "modified_timestamp": F.date_add(stamp, 1).cast("timestamp_ntz")})
            real(now, jobs_view, f"{shared}/jobs")
        return result

    def cycle():
        return sync.sync_cycle(spark, jobs_view, listed_view, shared, ["job_description"], stamp)

    monkeypatch.setattr(sync, "refresh_stage", edited)
    if fails:
        with pytest.raises(RuntimeError, match="lost"):
            cycle()
    else:
        assert cycle() == "done"
        assert spark.table(jobs_view).first()["job_description"] == "new"
    monkeypatch.undo()
    assert flags == ["Y"] and spark.table(jobs_view).first()["is_run_sync"] == "N"
    if not fails:
        assert cycle() == "done"
        assert [tuple(r) for r in spark.table(listed_view).collect()] == [("a", "new")]
