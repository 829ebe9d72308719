"""Lookups, updates and checks on small rows, and on a key that holds most rows."""

import pytest
from pyspark.sql import functions as F

from stageline import schemas
from stageline.operators import checks, end_mark, lookups, membership, updates
from stageline.plans.runs import decide_runs, tables_to_load

KEY = schemas.INSTANCE_KEY


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def instances(spark):
    return spark.createDataFrame(
        [
            ("a", 1, "r1", "RUNNING"),
            ("a", 2, "r2", "UNKNOWN"),
            ("b", 1, "r3", "SUCCEEDED"),
            ("b", 2, None, "STARTING"),
            ("c", 1, "r5", "STOPPING"),
        ],
        "job_name string, job_instance int, job_run_id string, status string",
    )


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [("r1", "RUNNING", None), ("r2", "STOPPING", None), ("r3", "RUNNING", None), ("r5", "FAILED", "x")],
        "job_run_id string, actual_status string, error_message string",
    )


@pytest.fixture(scope="module")
def details(spark):
    return spark.createDataFrame(
        [("a", 1, "t", "Y"), ("a", 1, "u", "N"), ("b", 1, "t", "Y"), ("b", 1, "v", None), ("c", 1, "t", "Y"),
         ("c", 1, "w", "Y")],
        "job_name string, job_instance int, table_name string, is_active string",
    )


def test_overlap_gate(instances, runs):
    # r3 is not asked for: its stored state is final; r5 has ended meanwhile
    assert rows(lookups.overlap_gate(instances, runs)) == [
        ("a", 1, "r1", "RUNNING"),
        ("a", 2, "r2", "STOPPING"),
    ]
    assert rows(lookups.failed_runs(runs)) == [("r5", "FAILED", "x")]


def test_active_tables(spark, details):
    assert len(rows(lookups.active_tables(details))) == 4
    keys = spark.createDataFrame([("a", 1), ("zz", 9)], "job_name string, job_instance int")
    assert rows(lookups.active_tables(details, keys)) == [("a", 1, "t")]
    assert rows(lookups.active_table_counts(details)) == [("a", 1, 1), ("b", 1, 1), ("c", 1, 2)]


def test_jobs_and_instances(spark, instances):
    jobs = spark.createDataFrame([("a", "Y"), ("b", None), ("x", "Y")], "job_name string, is_active string")
    assert rows(lookups.active_instances(jobs, instances)) == [("a", 1), ("a", 2)]
    assert rows(lookups.jobs_with_instances(jobs, instances)) == [("a",)]


def test_membership(spark, details):
    # inactive rows count too
    assert rows(membership.named_table_counts(details, ["t", "u"])) == [("a", 1, 2), ("b", 1, 1), ("c", 1, 1)]
    names = spark.createDataFrame([("t",), ("u",)], "table_name string")
    assert rows(membership.named_table_counts(details, names)) == rows(
        membership.named_table_counts(details, ["t", "u"])
    )
    requests = spark.createDataFrame(
        [("a", 1, t) for t in ("t", "u")]
        + [("b", 1, t) for t in ("t", "t")]
        + [("c", 1, t) for t in ("t", "")]
        + [("d", 1, "t")],
        "job_name string, job_instance int, table_name string",
    )
    assert rows(membership.validate_requested(requests, details)) == [
        ("a", 1, 2, 2, True),
        ("b", 1, 2, 1, False),
        ("c", 1, 2, 1, False),
        ("d", 1, 1, 0, False),
    ]


def test_decide_runs(spark, instances, runs, details):
    requests = spark.createDataFrame(
        [
            ("a", 1, None, None),  # still going
            ("b", 1, " t | v ", 2),  # listed, one of them inactive
            ("c", 1, "t|nope", None),
            ("b", 2, None, None),  # never ran, no tables
            ("q", 1, None, None),
        ],
        "job_name string, job_instance int, tables string, max_dpu int",
    ).withColumns({c: F.lit(None).cast("string") for c in ("incr_from", "incr_to", "context")})
    decided = decide_runs(requests, instances, runs, details)
    assert {(r[0], r[1]): (r["decision"], r["max_capacity"]) for r in decided.collect()} == {
        ("a", 1): ("overlap", None),
        ("b", 1): ("start", 2.0),
        ("c", 1): ("bad_tables", None),
        ("b", 2): ("start", None),
        ("q", 1): ("no_instance", None),
    }
    assert rows(tables_to_load(decided, details)) == [("b", 1, "t"), ("b", 1, "v")]


def test_updates(spark, instances):
    new = spark.createDataFrame(
        [("a", 1, "n1", "FAILED"), ("b", 2, None, None), ("zz", 1, "n3", "FAILED")],
        "job_name string, job_instance int, job_run_id string, status string",
    )
    assert rows(updates.update_instances(instances, new)) == sorted(
        [
            ("a", 1, "n1", "FAILED"),
            ("a", 2, "r2", "UNKNOWN"),
            ("b", 1, "r3", "SUCCEEDED"),
            ("b", 2, None, None),
            ("c", 1, "r5", "STOPPING"),
        ],
        key=repr,
    )


def test_latest_update_wins(spark, instances):
    new = spark.createDataFrame(
        [("a", 1, "n1", "FAILED", 1), ("a", 1, "n2", "RUNNING", 3), ("a", 1, "n3", "TIMEOUT", 2)],
        "job_name string, job_instance int, job_run_id string, status string, seq int",
    )
    result = updates.update_instances(instances, new, latest_by="seq")
    assert result.count() == instances.count()
    assert result.where("job_name = 'a' and job_instance = 1").first()["job_run_id"] == "n2"
    # only final states are stored
    ended = updates.mark_ended(instances, new, latest_by="seq").where("job_name = 'a' and job_instance = 1")
    assert ended.first()["job_run_id"] == "n3"


def test_repeated_updates_add_no_rows(spark, instances):
    twice = [("a", 1, "n1", "FAILED"), ("a", 1, "n1", "FAILED"), ("zz", 1, "n3", None), ("zz", 1, "n3", None)]
    schema = "job_name string, job_instance int, job_run_id string, status string"
    result = updates.update_instances(instances, spark.createDataFrame(twice, schema))
    assert result.count() == instances.count()
    differ = spark.createDataFrame([*twice, ("a", 1, "n2", "FAILED")], schema)
    with pytest.raises(Exception, match="have no order"):
        updates.update_instances(instances, differ).collect()
    tied = differ.withColumn("seq", F.lit(None).cast("int"))
    result = updates.update_instances(instances, tied, latest_by="seq")
    assert result.count() == instances.count()
    assert result.where("job_name = 'a' and job_instance = 1").first()["job_run_id"] == "n2"


def test_stamp_keeps_the_type(spark):
    details = spark.createDataFrame([("a", 1, "t")], "job_name string, job_instance int, table_name string")
    details = details.withColumn("last_run_timestamp", F.lit(None).cast("timestamp_ntz"))
    assert updates.stamp_details(details, details).schema == details.schema


def test_flags(spark):
    jobs = spark.createDataFrame(
        [("a", "N", None)], "job_name string, is_run_sync string, last_sync_timestamp timestamp"
    )
    flagged = updates.set_sync_flag(jobs, "Y")
    assert tuple(membership.sync_flag_count(flagged).first()) == (1, True)
    assert tuple(membership.sync_flag_count(updates.mark_synced(flagged)).first()) == (0, False)
    assert updates.mark_synced(flagged).first()["last_sync_timestamp"].microsecond == 0
    assert not membership.is_empty(jobs).first()[0] and membership.is_empty(jobs.where("false")).first()[0]


def test_checks(spark):
    df = spark.createDataFrame(
        [("a", 1, "xx"), ("a", 1, None), ("a", None, "x"), (None, None, "xxx"), (None, None, "x")],
        "k string, i int, t string",
    )
    assert rows(checks.duplicate_keys(df, ["k", "i"])) == sorted([("a", 1, 2), (None, None, 2)], key=repr)
    assert len(rows(checks.null_rows(df, ["k", "t"]))) == 3
    assert rows(checks.long_rows(df, {"t": 1})) == sorted([("a", 1, "xx"), (None, None, "xxx")], key=repr)
    parent = spark.createDataFrame([("b",), ("c",)], "k string")
    assert rows(checks.orphans(df, parent, ["k"])) == [("a", 3)]


def test_batch_completeness(spark):
    batch = "job_name string, job_instance int"
    expected = spark.createDataFrame([("a", 1, 2), ("b", 1, 1), ("c", 1, 1)], f"{batch}, expected bigint")
    got = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 1)], batch)
    assert rows(membership.batch_completeness(got, expected)) == [
        ("a", 1, 2, 2, True),
        ("b", 1, 1, 2, False),
        ("c", 1, 1, 0, False),
    ]


# ------------------------------------------- one key with a third of the rows

HOT = 30_000


@pytest.fixture
def small_skew(spark):
    """AQE thresholds for test data, no broadcast: the plan of a large table."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_instances(spark):
    n = F.col("id")
    return spark.range(0, 3 * HOT, 1, 16).select(
        F.when(n < HOT, "hot").otherwise(F.concat(F.lit("j"), n % 500)).alias("job_name"),
        n.cast("int").alias("job_instance"),
        F.concat(F.lit("t"), n).alias("table_name"),
        F.lit("Y").alias("is_active"),
        F.lit(None).cast("string").alias("job_run_id"),
        F.lit("RUNNING").alias("status"),
    )


def jobs_of(spark):
    names = spark.range(500).select(F.concat(F.lit("j"), "id").alias("job_name"))
    return names.union(spark.createDataFrame([("hot",)], "job_name string")).withColumn("is_active", F.lit("Y"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()  # a new execution, to be as large as the query
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_job_is_split_in_joins(spark, small_skew):
    hot, jobs = hot_instances(spark), jobs_of(spark)
    for joined in (
        lookups.active_instances(jobs, hot),
        lookups.active_tables(hot, jobs, ["job_name"]),
    ):
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 3 * HOT


def test_hot_key_is_reduced_before_the_shuffle(spark, small_skew):
    """Key reports and existence joins shuffle at most one row per task and key."""
    hot, jobs = hot_instances(spark), jobs_of(spark)
    for report in (
        checks.duplicate_keys(hot, ["job_name"]),
        checks.orphans(hot, jobs.where("job_name <> 'hot'"), ["job_name"]),
        lookups.jobs_with_instances(jobs, hot),
        lookups.active_table_counts(hot, ["job_name"]),
    ):
        text = report._jdf.queryExecution().executedPlan().toString()
        shuffles = text.count("Exchange hashpartitioning")
        partial = text.count("partial_") + text.count("functions=[], output=[job_name")
        assert shuffles and partial
    assert rows(checks.orphans(hot, jobs.where("job_name <> 'hot'"), ["job_name"])) == [("hot", HOT)]
    assert lookups.jobs_with_instances(jobs, hot).count() == 501


def test_hot_batch_is_split(spark, small_skew, shared):
    hot = hot_instances(spark).withColumns({"seq": F.col("job_instance").cast("bigint"), "body": F.lit("t")})
    messages = hot.withColumn("body", F.when(F.col("seq").isin(20_000, 25_000, 70_000), "done!").otherwise("t"))
    batch = ["job_name"]
    end_mark.end_marks(messages, F.col("body") == "done!", batch).write.parquet(shared)
    marks = spark.read.parquet(shared)
    taken = end_mark.before_end_mark(messages, marks, batch=batch)
    assert taken.where("job_name = 'hot'").count() == 20_000
    marked = f"j{70_000 % 500}"
    same_job = messages.where(f"job_name = '{marked}'")
    assert taken.where(f"job_name = '{marked}'").count() == same_job.where("seq < 70000").count()
    assert taken.where(f"job_name not in ('hot', '{marked}')").isEmpty()
    opened = end_mark.before_end_mark(messages, marks, keep_open=True, batch=batch)
    others = messages.where(f"job_name not in ('hot', '{marked}')").count()
    assert opened.count() == taken.count() + others
    # the hot batch is split by its measured size
    assert "skew=true" in final_plan(opened)


def test_retention_pushes_its_cut_off(spark, sf_dir):
    from stageline.registry import fixtures as fx

    kept = end_mark.not_expired(fx.messages(spark, sf_dir))
    kept.collect()
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    newest = fx.messages(spark, sf_dir).agg(F.max("sent")).first()[0]
    assert kept.count() == fx.messages(spark, sf_dir).where(
        F.col("sent") >= F.lit(newest).cast("timestamp_ntz") - F.expr("interval 12 hours")
    ).count()
