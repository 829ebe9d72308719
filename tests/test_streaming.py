"""Staged loads: several micro-batches, restarts, failures, end marks, expiry."""

import datetime
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from stageline.operators.end_mark import not_expired
from stageline.operators.updates import update_instances
from stageline.session import drop_path
from stageline.sinks.stage import live_slot, refresh_stage
from stageline.streaming import loads, run_states, run_timeouts
from stageline.streaming.messages import MESSAGE_SCHEMA, read_messages
from stageline.streaming.order import next_missing

START = datetime.datetime(2024, 1, 1)


def send(spark, folder, bodies, first_seq, job="j", hours=0):
    """Append one file of messages."""
    rows = [
        (first_seq + i, job, 1, body, START + datetime.timedelta(hours=hours, seconds=first_seq + i))
        for i, body in enumerate(bodies)
    ]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def batches(spark, folder):
    return sorted(r[0] for r in spark.read.parquet(folder).select("batch_id").distinct().collect())


@pytest.fixture
def setting(spark, shared):
    """Two sources, an inbox, and details of one instance."""
    spark.range(3).write.parquet(f"{shared}/src/t")
    spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{shared}/src/u")
    tag = shared.rsplit("-", 1)[-1]
    details = spark.createDataFrame(
        [("j", 1, "t", None), ("j", 1, "u", None), ("k", 1, "t", None)],
        "job_name string, job_instance int, table_name string, last_run_timestamp timestamp_ntz",
    )
    refresh_stage(details, f"details_{tag}", f"{shared}/root/details")
    sources = {n: f"{shared}/src/{n}" for n in "tu"}

    def run(files_per_trigger=1, **kw):
        loads.run_table_loads(
            read_messages(spark, f"{shared}/inbox", files_per_trigger=files_per_trigger),
            sources,
            f"stage_{{}}_{tag}",
            f"{shared}/root",
            f"details_{tag}",
            F.lit("2030-01-01").cast("timestamp_ntz"),
            **kw,
        ).awaitTermination()

    return run, f"{shared}/inbox", f"{shared}/root", tag


def test_loads_and_stamps(spark, setting):
    run, inbox, root, tag = setting
    send(spark, inbox, ["t", " t\n", "t"], 1)
    run()
    assert spark.table(f"stage_t_{tag}").count() == 3
    assert not spark.catalog.tableExists(f"stage_u_{tag}")
    # three messages, one load
    assert live_slot(spark, f"stage_t_{tag}") == "a"
    stamped = {(r[0], r[2]): r[3] is not None for r in spark.table(f"details_{tag}").collect()}
    assert stamped == {("j", "t"): True, ("j", "u"): False, ("k", "t"): False}
    assert rows(loads.load_report(spark, root)) == [("t", 3, 3)]


def test_restart_reads_only_what_is_new(spark, setting):
    run, inbox, root, tag = setting
    send(spark, inbox, ["t"], 1)
    run()
    run()
    assert batches(spark, f"{root}/loads") == [0]
    assert live_slot(spark, f"stage_t_{tag}") == "a"
    send(spark, inbox, ["u", "t"], 2)
    run()
    assert batches(spark, f"{root}/loads") == [0, 1]
    assert rows(loads.load_report(spark, root)) == [("t", 2, 3), ("u", 1, 2)]
    assert spark.table(f"stage_u_{tag}").count() == 5


def test_failed_batch_is_repeated(spark, setting, monkeypatch):
    """A failure after the load and before the commit: repeated once, same content."""
    run, inbox, root, tag = setting
    send(spark, inbox, ["t", "u"], 1)
    real = loads.stamp_details

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(loads, "stamp_details", fail)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.table(f"stage_t_{tag}").count() == 3
    monkeypatch.setattr(loads, "stamp_details", real)
    run()
    assert batches(spark, f"{root}/loads") == [0]
    assert rows(loads.load_report(spark, root)) == [("t", 1, 1), ("u", 1, 2)]
    assert spark.table(f"stage_t_{tag}").count() == 3
    assert spark.table(f"details_{tag}").where("last_run_timestamp is not null").count() == 2


def test_unknown_table_is_set_aside(spark, setting):
    run, inbox, root, tag = setting
    send(spark, inbox, ["t", "nope"], 1)
    run()
    send(spark, inbox, ["u"], 3)
    run()
    assert spark.table(f"stage_t_{tag}").count() == 3 and spark.table(f"stage_u_{tag}").count() == 5
    assert rows(loads.rejected_report(spark, root)) == [("j", 1, "nope", 1, 2)]


def test_state_does_not_pile_up(spark, setting):
    """A micro-batch reads the state of the one before it, however many there were."""
    run, inbox, root, _ = setting
    for seq in range(1, 6):
        send(spark, inbox, ["done!"], seq, job=f"k{seq}")
        run()
    assert batches(spark, f"{root}/known_marks") == [3, 4]
    assert spark.read.parquet(f"{root}/known_marks/batch_id=4").count() == 5


@pytest.mark.parametrize("files_per_trigger", [1, None])
def test_end_mark(spark, setting, files_per_trigger):
    """The mark holds for later micro-batches; other batches stay open."""
    run, inbox, root, tag = setting
    send(spark, inbox, ["t", "t"], 1)
    send(spark, inbox, ["t"], 3, job="k")
    send(spark, inbox, [" done! ", "u"], 4)
    send(spark, inbox, ["u", "done!"], 6)
    run(files_per_trigger)
    assert rows(loads.load_report(spark, root)) == [("t", 3, 3)]
    assert not spark.catalog.tableExists(f"stage_u_{tag}")
    expected = spark.createDataFrame([("j", 1, 2)], "job_name string, job_instance int, expected bigint")
    assert rows(loads.batch_report(spark, root, expected)) == [("j", 1, 2, 2, True)]
    assert batches(spark, f"{root}/loads") == ([0, 1] if files_per_trigger else [0])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_order_is_restored_across_files(spark, setting, seed):
    """Files in any order, one a micro-batch, some twice: as if all had come in order."""
    run, inbox, root, tag = setting
    bodies = ["t", "t", "u", " done! ", "u", "t", "done!", "u"]
    files = [(i + 1, [b]) for i, b in enumerate(bodies)] + [(3, ["u"])]
    random.Random(seed).shuffle(files)
    for first, own in files:
        send(spark, inbox, own, first)
    run(first=1)
    assert rows(loads.load_report(spark, root)) == [("t", 2, 2), ("u", 1, 3)]
    expected = spark.createDataFrame([("j", 1, 3)], "job_name string, job_instance int, expected bigint")
    assert rows(loads.batch_report(spark, root, expected)) == [("j", 1, 3, 3, True)]


def test_a_gap_holds_what_follows(spark, setting):
    run, inbox, root, _ = setting
    send(spark, inbox, ["t"], 1)
    send(spark, inbox, ["u", "t"], 3)
    run(first=1)
    assert rows(loads.load_report(spark, root)) == [("t", 1, 1)]
    send(spark, inbox, ["u"], 2)
    run(first=1)
    assert rows(loads.load_report(spark, root)) == [("t", 2, 4), ("u", 2, 3)]


def test_next_missing(spark):
    def missing(numbers, start=1):
        return next_missing(spark.createDataFrame([(n,) for n in numbers], "seq long"), start)

    assert [missing(x) for x in ([], [1], [2, 3], [3, 1, 2, 2], [1, 2, 4, 5], [0, 1, 2])] == [1, 2, 1, 4, 3, 3]
    assert missing([5, 6, 8], 5) == 7


def test_batch_with_only_a_mark(spark, setting):
    run, inbox, root, _ = setting
    send(spark, inbox, ["done!"], 1)
    run()
    assert rows(loads.batch_report(spark, root)) == [("j", 1, 0)]


def test_expired_messages_load_nothing(spark, setting):
    run, inbox, root, tag = setting
    send(spark, inbox, ["t"], 1, hours=20)
    send(spark, inbox, ["u"], 2, hours=0)  # late by more than the retention
    run(seconds=43200)
    assert rows(loads.load_report(spark, root)) == [("t", 1, 1)]
    assert not spark.catalog.tableExists(f"stage_u_{tag}")


def test_retention_edge(spark):
    at = [START, START + datetime.timedelta(seconds=1), START + datetime.timedelta(seconds=43200)]
    df = spark.createDataFrame([(t,) for t in at], "sent timestamp_ntz")
    assert not_expired(df).count() == 3
    later = df.union(spark.createDataFrame([(at[2] + datetime.timedelta(seconds=1),)], df.schema))
    assert not_expired(later).count() == 3


def test_retention_in_another_zone(spark, shared):
    """The clock of a stream does not pass through the session's time zone."""
    send(spark, f"{shared}/inbox", ["t"], 1, hours=12)
    send(spark, f"{shared}/inbox", ["u", "v"], 0, hours=0)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        inbox = read_messages(spark, f"{shared}/inbox")
        loads.run_retention(inbox, shared).awaitTermination()
        kept = spark.read.parquet(f"{shared}/kept").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["body"] for r in kept} == {"t", "v"}


def test_partition_loads(spark, shared):
    def source(n):
        name = F.substring(F.lit("tuv"), (F.col("id") % 3 + 1).cast("int"), F.lit(1))
        df = spark.range(n).withColumn("table_name", name)
        df.write.mode("overwrite").partitionBy("table_name").parquet(f"{shared}/src")

    def run():
        loads.run_partition_loads(
            read_messages(spark, f"{shared}/inbox"), "tuv", f"{shared}/src", f"{shared}/stage", shared
        ).awaitTermination()

    def staged():
        return {r[0]: r[1] for r in spark.read.parquet(f"{shared}/stage").groupBy("table_name").count().collect()}

    source(30)
    send(spark, f"{shared}/inbox", ["t", "u"], 1)
    run()
    assert staged() == {"t": 10, "u": 10}
    source(60)
    # partitions that are not named are not read
    spark.createDataFrame([("not parquet",)], "value string").write.mode("append").text(
        f"{shared}/src/table_name=v"
    )
    send(spark, f"{shared}/inbox", ["u"], 3)
    run()
    assert staged() == {"t": 10, "u": 20}


def test_latest_state(spark, shared):
    """State is kept over micro-batches and a restart; an older report changes nothing."""
    inbox, root = f"{shared}/inbox", shared

    def run():
        run_states.run_state_log(
            read_messages(spark, inbox, files_per_trigger=1), root, ["job_name"], "body"
        ).awaitTermination()

    send(spark, inbox, ["UNKNOWN", "RUNNING"], 1, job="a")
    send(spark, inbox, ["UNKNOWN"], 3, job="b")
    run()
    send(spark, inbox, ["SUCCEEDED"], 5, job="a")
    send(spark, inbox, ["UNKNOWN"], 0, job="a")
    run()
    latest = run_states.read_state_log(spark, root, "job_name string")
    assert rows(latest) == [("a", "SUCCEEDED", 5), ("b", "UNKNOWN", 3)]

    instances = spark.createDataFrame(
        [("a", "r1", "UNKNOWN"), ("c", "r2", "UNKNOWN")], "job_name string, job_run_id string, status string"
    )
    new = latest.select("job_name", F.lit("r1").alias("job_run_id"), F.col("last_status").alias("status"))
    assert rows(update_instances(instances, new, ["job_name"])) == [
        ("a", "r1", "SUCCEEDED"),
        ("c", "r2", "UNKNOWN"),
    ]


def test_runs_end_by_their_timers(spark, shared):
    """Final in time, final too late, none at all, still open; a late report changes nothing."""
    schema = "seq long, job_name string, job_instance int, status string, sent timestamp_ntz"

    def at(minutes):
        return START + datetime.timedelta(minutes=minutes)

    def send_states(reports):
        rows = [(i, job, 1, status, at(m)) for i, (job, status, m) in enumerate(reports)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{shared}/inbox")

    def run():
        stream = read_messages(spark, f"{shared}/inbox", schema, files_per_trigger=1)
        run_timeouts.run_timeouts(stream, shared, minutes=60).awaitTermination()
        return {r.job_name: (r.ended, r.outcome) for r in run_timeouts.read_outcomes(spark, shared).collect()}

    send_states([("ok", "STARTING", 0), ("ok", "FAILED", 20), ("ok", "SUCCEEDED", 10), ("slow", "RUNNING", 5), ("hung", "RUNNING", 8)])
    assert run() == {}
    send_states([("slow", "SUCCEEDED", 70), ("open", "RUNNING", 100)])
    want = {"ok": (at(10), "SUCCEEDED"), "slow": (at(65), "TIMEOUT"), "hung": (at(68), "TIMEOUT")}
    assert run() == want
    send_states([("hung", "SUCCEEDED", 101), ("open", "SUCCEEDED", 110), ("new", "RUNNING", 200)])
    assert run() == want | {"open": (at(110), "SUCCEEDED")}
    assert run() == want | {"open": (at(110), "SUCCEEDED")}


def _timeouts(spark, shared, files, minutes=60, files_per_trigger=1, **options):
    """Outcomes after files of reports: key, status, minutes after the start or None."""
    schema = "seq long, job_name string, job_instance int, status string, sent timestamp_ntz"
    for reports in files:
        sent = [None if m is None else START + datetime.timedelta(minutes=m) for *_, m in reports]
        made = [(i, *key, status, at) for i, ((key, status, _), at) in enumerate(zip(reports, sent, strict=True))]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(f"{shared}/inbox")
    stream = read_messages(spark, f"{shared}/inbox", schema, files_per_trigger=files_per_trigger)
    query = run_timeouts.run_timeouts(stream, shared, minutes=minutes, **options)
    query.awaitTermination()
    told = run_timeouts.read_outcomes(spark, shared).collect()
    assert len({r[:2] for r in told}) == len(told)
    return query, {r[:2]: ((r.ended - START).total_seconds() / 60, r.outcome) for r in told}


def test_no_run_costs_a_call_of_python(spark, shared):
    """Timers are kept on frames: the work is Spark's, however many runs there are."""
    reports = [(("j", i), "SUCCEEDED" if i % 2 else "RUNNING", i) for i in range(200)]
    query, told = _timeouts(spark, shared, [reports])
    assert "InPandas" not in query._jsq.explainInternal(True)
    assert told == {("j", i): (i, "SUCCEEDED") if i % 2 else (i + 60, "TIMEOUT") for i in range(139)}


def test_runs_and_reports_without_key_or_time(spark, shared):
    reports = [((None, 1), "RUNNING", 0), (("j", None), "FAILED", 1), (("j", 1), "RUNNING", None), (("j", 2), "FAILED", None), (("j", 2), "RUNNING", 3)]
    told = _timeouts(spark, shared, [reports])[1]
    assert told == {}
    want = {(None, 1): (60, "TIMEOUT"), ("j", None): (1, "FAILED"), ("j", 2): (63, "TIMEOUT")}
    assert _timeouts(spark, shared, [[(("k", 1), None, 100)]])[1] == want
    later = [((None, 1), "FAILED", 101), (("j", None), "RUNNING", 102), (("j", 2), "RUNNING", 103), (("l", 1), "RUNNING", 500)]
    assert _timeouts(spark, shared, [later])[1] == want | {("k", 1): (160, "TIMEOUT")}


def test_timers_of_overlapping_files_and_a_repeated_micro_batch(spark, shared):
    a, b, c, late = [("j", i) for i in range(4)]
    files = [[(a, "RUNNING", 50), (b, "RUNNING", 90)], [(a, "FAILED", 60), (c, "RUNNING", 40), (b, "RUNNING", 95)]]
    _, told = _timeouts(spark, shared, files)
    assert told == {}
    # what is older than the watermark of an earlier query starts no run, and moves no timer
    want = {a: (60, "FAILED"), b: (150, "TIMEOUT")}
    _, told = _timeouts(spark, shared, [[(late, "FAILED", 30), (b, "SUCCEEDED", 94), (c, "SUCCEEDED", 97), (a, "RUNNING", 151)]])
    assert told == want | {c: (97, "SUCCEEDED")}
    # a micro-batch that was not acknowledged comes again
    last = max(int(f.name) for f in (pathlib.Path(shared) / "checkpoint/commits").iterdir() if f.name.isdigit())
    drop_path(spark, f"{shared}/checkpoint/commits/{last}")
    assert _timeouts(spark, shared, [])[1] == told
    assert _timeouts(spark, shared, [[(late, "FAILED", 152)], [(late, "RUNNING", 400)]])[1] == told | {late: (152, "FAILED")}


def test_late_reports_within_the_given_time_count(spark, shared):
    early, later = ("j", 1), ("j", 2)
    assert _timeouts(spark, shared, [[(later, "RUNNING", 100)]], late="90 minutes")[1] == {}
    assert _timeouts(spark, shared, [[(early, "SUCCEEDED", 20)]], late="90 minutes")[1] == {}
    told = _timeouts(spark, shared, [[(later, "FAILED", 171)]], late="90 minutes")[1]
    assert told == {early: (20, "SUCCEEDED")}
