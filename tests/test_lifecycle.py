"""The three flows one after another on the control tables, with their real keys."""

import datetime

from pyspark.sql import functions as F

from stageline import schemas
from stageline.operators import checks, updates
from stageline.plans.runs import decide_runs, tables_to_load
from stageline.registry import fixtures as fx
from stageline.sinks.stage import refresh_stage
from stageline.sinks.tables import convert_tables
from stageline.sources import control
from stageline.streaming import loads, run_states
from stageline.streaming.messages import read_messages


def test_convert_run_and_load(spark, sf_dir, shared):
    tag = shared.rsplit("-", 1)[-1]
    database, names = f"control_{tag}", ["nation", "region"]

    # what is there: three jobs, the tables each loads
    control.create_control_tables(spark, database, f"{shared}/control")
    control.append_rows(
        spark.createDataFrame([(j, "{}", "Y") for j in "abc"], "job_name string, job_param string, is_active string"),
        f"{database}.jobs",
    )
    control.append_rows(
        spark.createDataFrame(
            [("a", 1, None, None), ("b", 1, "r0", "RUNNING"), ("c", 1, "r1", "FAILED")],
            "job_name string, job_instance int, job_run_id string, status string",
        ),
        f"{database}.job_instances",
    )
    control.append_rows(
        spark.createDataFrame(
            [(j, 1, t, "Y") for j in "abc" for t in names],
            "job_name string, job_instance int, table_name string, is_active string",
        ),
        f"{database}.job_details",
    )
    tables = {t: control.scan_control(spark, database, t) for t in schemas.TABLES}
    assert checks.control_violations(tables).where("n > 0").isEmpty()

    # which runs start, and with which tables
    requests = spark.createDataFrame(
        [("a", 1, None), ("b", 1, None), ("c", 1, "nation"), ("c", 2, None)],
        "job_name string, job_instance int, tables string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("max_dpu", "incr_from", "incr_to", "context")})
    true_states = spark.createDataFrame(
        [("r0", "RUNNING", None), ("r1", "FAILED", "x")],
        "job_run_id string, actual_status string, error_message string",
    )
    decided = decide_runs(requests, tables["job_instances"], true_states, tables["job_details"])
    assert {(r[0], r[1]): r["decision"] for r in decided.collect()} == {
        ("a", 1): "start", ("b", 1): "overlap", ("c", 1): "start", ("c", 2): "no_instance",
    }
    to_load = tables_to_load(decided, tables["job_details"])
    assert sorted(map(tuple, to_load.collect())) == [("a", 1, "nation"), ("a", 1, "region"), ("c", 1, "nation")]

    started = decided.where("decision = 'start'").withColumn("job_run_id", F.concat(F.lit("new_"), "job_name"))
    instances = updates.mark_started(tables["job_instances"], started)
    refresh_stage(instances, f"instances_{tag}", f"{shared}/instances")
    refresh_stage(tables["job_details"], f"details_{tag}", f"{shared}/root/details")

    # the converter
    for t in names:
        fx.table(spark, sf_dir, t).write.option("header", True).csv(f"{shared}/csv/{t}")
    counts = convert_tables(spark, names, shared + "/csv/{}/*.csv", shared + "/data/{}/parquet")
    assert {r["table_name"]: r["n_rows"] for r in counts.collect()} == {"nation": 25, "region": 5}

    # the loads: a message per table, then the end mark
    ready = to_load.select("job_name", "job_instance", F.col("table_name").alias("body"))
    done = started.select("job_name", "job_instance", F.lit(schemas.END_MARK).alias("body"))
    sent = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz")
    for i, part in enumerate((ready, done)):
        messages = part.withColumns({"seq": F.lit(i).cast("bigint"), "sent": sent})
        messages.write.mode("append").parquet(f"{shared}/inbox")
    loads.run_table_loads(
        read_messages(spark, f"{shared}/inbox"),
        {t: f"{shared}/data/{t}/parquet" for t in names},
        f"stage_{{}}_{tag}",
        f"{shared}/root",
        f"details_{tag}",
    ).awaitTermination()
    assert spark.table(f"stage_nation_{tag}").count() == 25
    expected = to_load.groupBy(*schemas.INSTANCE_KEY).agg(F.count(F.lit(1)).alias("expected"))
    report = loads.batch_report(spark, f"{shared}/root", expected)
    assert {(r["job_name"], r["n_messages"], r["complete"]) for r in report.collect()} == {
        ("a", 2, True), ("c", 1, True),
    }
    stamped = spark.table(f"details_{tag}").where("last_run_timestamp is not null")
    assert stamped.select(*schemas.DETAIL_KEY).exceptAll(to_load.select(*schemas.DETAIL_KEY)).isEmpty()
    assert stamped.count() == 3

    # the runs report; the last final state is stored
    states = spark.createDataFrame(
        [(1, "a", 1, "RUNNING"), (2, "c", 1, "STOPPED"), (3, "a", 1, "SUCCEEDED")],
        "seq bigint, job_name string, job_instance int, body string",
    ).withColumn("sent", sent)
    states.write.parquet(f"{shared}/states")
    run_states.run_state_log(
        read_messages(spark, f"{shared}/states"), f"{shared}/log", state="body"
    ).awaitTermination()
    latest = run_states.read_state_log(spark, f"{shared}/log")
    reports = started.select(*schemas.INSTANCE_KEY, "job_run_id").join(latest, schemas.INSTANCE_KEY)
    reports = reports.withColumnRenamed("last_status", "status")
    ended = updates.mark_ended(spark.table(f"instances_{tag}"), reports)
    assert {r["job_name"]: (r["job_run_id"], r["status"]) for r in ended.collect()} == {
        "a": ("new_a", "SUCCEEDED"), "b": ("r0", "RUNNING"), "c": ("new_c", "UNKNOWN"),
    }
