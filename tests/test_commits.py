"""Stage tables that outlive a session, keyed changes, bucketed state, folded logs."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stageline.sinks import commits, stage
from stageline.sinks.stage import KEEP, change_stage, drop_leftovers, live_version, open_stage, refresh_stage, truncate_stage
from stageline.streaming import run_states
from stageline.streaming.keyed_state import FOLD, append_run, read_buckets, read_runs, update_buckets
from stageline.streaming.messages import read_messages

SESSION = """
import datetime, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from stageline.session import build_session
from stageline.sinks.stage import open_stage, refresh_stage
from stageline.streaming import loads
from stageline.streaming.messages import MESSAGE_SCHEMA, read_messages
conf = {{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.warehouse.dir": sys.argv[2] + "/wh" + sys.argv[1]}}
spark = build_session("s" + sys.argv[1], "local[2]", **conf)
spark.sparkContext.setLogLevel("ERROR")
root, turn = sys.argv[2], int(sys.argv[1])
def send(seq, bodies):
    rows = [(seq + i, "j", 1, b, datetime.datetime(2024, 1, 1)) for i, b in enumerate(bodies)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(root + "/inbox")
if turn == 1:
    spark.range(3).write.parquet(root + "/src/t")
    spark.range(5).write.parquet(root + "/src/u")
    details = [("j", 1, t, None) for t in "tuv"]
    details = spark.createDataFrame(details, "job_name string, job_instance int, table_name string, last_run_timestamp timestamp_ntz")
    refresh_stage(details, "details", root + "/root/details", 2, ["table_name"])
    send(1, ["t"])
else:
    assert not spark.catalog.tableExists("details") and not spark.catalog.tableExists("stage_t")
    send(2, ["u", "done!", "v"])
loads.run_table_loads(
    read_messages(spark, root + "/inbox", files_per_trigger=1), {{t: root + "/src/" + t for t in "tu"}}, "stage_{{}}",
    root + "/root", "details", F.lit("2030-01-0%d" % turn).cast("timestamp_ntz"),
).awaitTermination()
rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
print("T", spark.table("stage_t").count())
print("U", spark.table("stage_u").count() if spark.catalog.tableExists("stage_u") else None)
print("D", [(r.table_name, str(r.last_run_timestamp)[:10]) for r in spark.table("details").orderBy("table_name").collect()])
print("L", rows(loads.load_report(spark, root + "/root")))
details = spark.table("details")
plan = details.groupBy("table_name").count()._jdf.queryExecution().executedPlan().toString()
print("B", "Bucketed: true" in plan)
spark.stop()
"""


def session(turn, root):
    code = SESSION.format(repo=str(Path(__file__).resolve().parents[1]))
    done = subprocess.run([sys.executable, "-c", code, str(turn), root], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
    return dict(line.split(" ", 1) for line in done.stdout.splitlines() if line[:2] in ("T ", "U ", "D ", "L ", "B "))


def test_a_new_session_goes_on(shared):
    """Stop the session, start another with an empty catalog, continue the checkpoint."""
    first = session(1, shared)
    assert (first["T"], first["U"], first["B"]) == ("3", "None", "True")
    assert first["D"] == "[('t', '2030-01-01'), ('u', 'None'), ('v', 'None')]"
    second = session(2, shared)
    assert (second["T"], second["U"], second["B"]) == ("3", "5", "True")
    # the first session's stamp is there, and its message is not handled again
    assert second["D"] == "[('t', '2030-01-01'), ('u', '2030-01-02'), ('v', 'None')]"
    assert second["L"] == """["('t', 1, 1)", "('u', 1, 2)"]"""


def view_of(shared):
    return f"v_{shared.rsplit('-', 1)[-1]}"


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_a_frame_survives_three_refreshes(spark, shared):
    view = view_of(shared)
    frames = [refresh_stage(spark.range(n), view, shared) for n in range(1, 7)]
    assert [f.count() for f in frames[-KEEP:]] == [3, 4, 5, 6] and KEEP >= 4
    assert live_version(spark, view) == 6 and spark.table(view).count() == 6
    assert commits.versions(spark, shared) == [3, 4, 5, 6]
    assert sum(len(commits.children(spark, f"{shared}/{s}")) for s in "abcd") == KEEP


def test_opened_from_the_log(spark, shared):
    view, other = view_of(shared), view_of(shared) + "_again"
    assert open_stage(spark, view, shared) is None
    refresh_stage(spark.range(7).withColumn("v", F.lit("x")), view, shared, 4, ["id"])
    opened = open_stage(spark, other, shared)
    assert ids(opened) == list(range(7)) and opened.columns == ["id", "v"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = opened.join(spark.table(view), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    # another name refreshes the same table; the first one sees it when it is opened again
    refresh_stage(spark.range(2).withColumn("v", F.lit("y")), other, shared, 4, ["id"])
    assert ids(spark.table(view)) == list(range(7)) and ids(open_stage(spark, view, shared)) == [0, 1]
    assert truncate_stage(spark, view, shared).count() == 0
    assert commits.latest(spark, shared)[1]["buckets"] == 4


def test_one_of_two_writers_fails(spark, shared, monkeypatch):
    view = view_of(shared)
    refresh_stage(spark.range(1), view, shared)
    real = commits.latest
    monkeypatch.setattr(stage.commits, "latest", lambda *a: (0, {}))  # as if it had begun before the other
    with pytest.raises(commits.CommitConflict):
        refresh_stage(spark.range(9), view, shared)
    monkeypatch.setattr(stage.commits, "latest", real)
    assert spark.table(view).count() == 1 and open_stage(spark, view, shared).count() == 1
    assert drop_leftovers(spark, shared) == []


def test_leftovers_of_a_failed_write(spark, shared):
    view = view_of(shared)
    refresh_stage(spark.range(4), view, shared)
    spark.range(3).write.parquet(f"{shared}/b/v2-dead")
    change_stage(spark.createDataFrame([(1,)], "id long").withColumn("x", F.lit(1)).limit(0), view, shared, ["id"], ratio=1e9)
    data = commits.latest(spark, shared)[1]["data"]
    spark.range(3).write.parquet(f"{shared}/{data}.changes/_change=dead")
    assert sorted(drop_leftovers(spark, shared)) == sorted(["b/v2-dead", f"{data}.changes/_change=dead"])
    assert ids(spark.table(view)) == [0, 1, 2, 3]


def changes(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, stamp string")


def test_changes_are_merged_on_read(spark, shared):
    view = view_of(shared)
    base = [("a", 1, "old", 1.5), ("b", 1, "old", 2.5), ("b", 2, None, 3.5), (None, 3, "old", 4.5)]
    refresh_stage(spark.createDataFrame(base, "k string, n int, stamp string, w double"), view, shared)
    for rows in ([("a", 1, "s1"), ("zz", 9, "s1")], [("a", 1, "s2"), ("b", 1, None)], [(None, 3, "s3")], []):
        out = change_stage(changes(spark, rows), view, shared, ["k", "n"], ratio=1e9)
    want = [("a", 1, "s2", 1.5), ("b", 1, None, 2.5), ("b", 2, None, 3.5), (None, 3, "s3", 4.5)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert out.columns == ["k", "n", "stamp", "w"] and len(commits.latest(spark, shared)[1]["changes"]) == 4
    # another column: what waits is folded first
    other = spark.createDataFrame([("a", 1, 9.0)], "k string, n int, w double")
    out = change_stage(other, view, shared, ["k", "n"], ratio=1e9)
    assert ("a", 1, "s2", 9.0) in map(tuple, out.collect()) and out.count() == 4
    assert len(commits.latest(spark, shared)[1]["changes"]) == 1


def test_a_change_costs_its_rows_and_is_folded_in_time(spark, shared):
    view = view_of(shared)
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("n"), F.uuid().alias("stamp"))
    refresh_stage(rows, view, shared)
    before = commits.stored_bytes(spark, shared)
    few = changes(spark, [(str(i), 1, "new") for i in range(20)])
    change_stage(few, view, shared, ["k", "n"])
    assert commits.stored_bytes(spark, shared) - before < before / 100
    assert spark.table(view).where("stamp = 'new'").count() == 20 and spark.table(view).count() == 200_000
    many = rows.select("k", "n", F.concat(F.lit("again"), "stamp").alias("stamp"))
    change_stage(many, view, shared, ["k", "n"])
    version, content = commits.latest(spark, shared)
    assert content["changes"] == [] and content["base"] == version
    assert spark.table(view).where("stamp like 'again%'").count() == 200_000


# ------------------------------------------------------------- keyed state, log

STATE = "k string, v bigint"


def least(rows):
    return rows.groupBy("k").agg(F.min("v").alias("v"))


def state(spark, folder, keys=None):
    return {r.k: r.v for r in read_buckets(spark, folder, STATE, ["k"], keys).collect()}


def test_only_touched_buckets_are_written(spark, shared):
    folder = f"{shared}/state"
    for batch in range(3):
        rows = [(f"k{i}", 10 * i - batch) for i in range(100 * batch, 100 * (batch + 1))]
        update_buckets(spark.createDataFrame(rows, STATE), folder, batch, ["k"], STATE, least, bucket_rows=20)
    assert state(spark, folder) == {f"k{i}": 10 * i - i // 100 for i in range(300)}
    n = commits.latest(spark, folder)[1]["n"]
    assert n == 16
    one = spark.createDataFrame([("k5", 7), ("k5", 9)], STATE)
    update_buckets(one, folder, 3, ["k"], STATE, least, bucket_rows=20)
    assert len([c for c in commits.children(spark, f"{folder}/batch_id=3") if c.startswith("bucket=")]) == 1
    assert state(spark, folder)["k5"] == 7 and len(state(spark, folder)) == 300
    assert "k5" in state(spark, folder, one) and len(state(spark, folder, one)) < 60


def test_a_repeated_batch_changes_no_state(spark, shared):
    folder = f"{shared}/state"
    rows = spark.createDataFrame([("a", 5)], STATE)
    update_buckets(rows, folder, 0, ["k"], STATE, least)
    update_buckets(rows.withColumn("v", F.lit(1).cast("long")), folder, 0, ["k"], STATE, least)
    assert state(spark, folder) == {"a": 5}
    update_buckets(rows.limit(0), folder, 1, ["k"], STATE, least)
    assert state(spark, folder) == {"a": 5}
    assert state(spark, f"{shared}/none") == {}


def test_log_is_folded_by_levels(spark, shared):
    folder = f"{shared}/log"

    def last(rows):
        return rows.groupBy("k").agg(F.max("v").alias("v"))

    most = 0
    for batch in range(20):
        rows = spark.createDataFrame([("a", batch), (f"b{batch % 3}", batch)], STATE).coalesce(1)
        append_run(rows, folder, batch, last, STATE, fold=3)
        append_run(rows, folder, batch, last, STATE, fold=3)  # a repeat
        most = max(most, len(commits.latest(spark, folder)[1]["runs"]))
    assert most <= 2 * 3  # at most fold - 1 on each level, and there are three
    got = {r.k: r.v for r in last(read_runs(spark, folder, STATE)).collect()}
    assert got == {"a": 19, "b0": 18, "b1": 19, "b2": 17}
    assert len([c for c in commits.children(spark, folder) if c.startswith("run-")]) <= most + 4


def test_state_log_of_many_batches_reads_few_files(spark, shared):
    rows = [(i, f"j{i % 5}", 1, f"S{i}", None) for i in range(30)]
    schema = "seq bigint, job_name string, job_instance int, body string, sent timestamp_ntz"
    for part in range(10):
        spark.createDataFrame(rows[3 * part : 3 * part + 3], schema).coalesce(1).write.mode("append").parquet(f"{shared}/inbox")
    run_states.run_state_log(
        read_messages(spark, f"{shared}/inbox", files_per_trigger=1), shared, ["job_name"], state="body"
    ).awaitTermination()
    latest = run_states.read_state_log(spark, shared, "job_name string")
    assert {r.job_name: r.last_status for r in latest.collect()} == {f"j{i}": f"S{25 + i}" for i in range(5)}
    content = commits.latest(spark, f"{shared}/changes")[1]
    assert content["last"] == 9 and len(content["runs"]) <= FOLD
