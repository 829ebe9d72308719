"""Runs that end by themselves: event-time timers on the states that runs report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stageline import schemas
from stageline.session import drop_path
from stageline.sinks import commits
from stageline.streaming.keyed_state import append_run, read_runs
from stageline.streaming.messages import drain

TIMED_OUT = "TIMEOUT"
RUN = "started bigint, ended bigint, seq bigint, status string"
OUTCOME = "started timestamp_ntz, ended timestamp_ntz, outcome string"
#: manifests that stay, for a repeated micro-batch
KEEP = 2


def _reports(reports: DataFrame, on: list[str], final: Iterable[str]) -> DataFrame:
    """Each report as a run that has no other."""
    over = F.col("status").isin(list(final))
    ends = {"ended": "at", "seq": "seq", "status": "status"}
    return reports.select(*on, F.col("at").alias("started"), *[F.when(over, F.col(c)).alias(n) for n, c in ends.items()])


def _first(runs: DataFrame, on: list[str]) -> DataFrame:
    """First report of each run, and its first final one: time, number, status. Rows are
    combined per task before the shuffle."""
    end = F.when(F.col("ended").isNotNull(), F.struct("ended", "seq", "status"))
    first = runs.groupBy(*on).agg(F.min("started").alias("started"), F.min(end).alias("end"))
    return first.select(*on, "started", "end.*")


def _outcomes(runs: DataFrame, on: list[str], span: int) -> DataFrame:
    """How runs whose time is over ended."""
    due = F.col("started") + span
    in_time = F.coalesce(F.col("ended") <= due, F.lit(False))

    def time(at):
        return F.timestamp_micros(at).cast("timestamp_ntz")

    return runs.select(
        *on,
        time(F.col("started")).alias("started"),
        time(F.when(in_time, F.col("ended")).otherwise(due)).alias("ended"),
        F.when(in_time, F.col("status")).otherwise(TIMED_OUT).alias("outcome"),
    )


def _without(runs: DataFrame, told: DataFrame, on: list[str]) -> DataFrame:
    """Runs that have not been told; keys may be null."""
    keys = told.select([F.col(c).alias(f"told_{c}") for c in on])
    return runs.join(keys, [F.col(c).eqNullSafe(F.col(f"told_{c}")) for c in on], "left_anti")


def run_timeouts(
    states: DataFrame,
    root: str,
    on: list[str] = schemas.INSTANCE_KEY,
    every: str | None = None,
    minutes: int = schemas.CREATE_DEFAULTS["timeout_minutes"],
    late: str = "0 seconds",
    final: Iterable[str] = tuple(schemas.STATES_TERMINAL),
) -> StreamingQuery:
    """Keep one row per run when its time is over, for ``read_outcomes``: key, ``started``,
    ``ended``, ``outcome``.

    A stream of reports: the key, ``seq``, ``status`` and ``sent``. A run starts with its
    first report. Its outcome is its first final state if that came within ``minutes``,
    else TIMEOUT, at the end of that time. It is told once, with the micro-batch after
    which the watermark, the newest report less ``late``, has passed that end. Runs that
    have been told are remembered, so that later reports change nothing. Reports from
    before the watermark are dropped; within one query that is the one before the last
    micro-batch, so that files of neighbouring micro-batches may overlap in time.

    All is done on frames, whatever the number of runs. Four values of each open run are
    stored per micro-batch, told runs as a log that is folded by levels. What reaches the
    driver is one number per micro-batch.
    """
    folder, span, final = f"{root}/runs", minutes * 60_000_000, frozenset(final)
    # no micro-batch of this query came before
    fresh = [True]

    def handle(reports: DataFrame, batch_id: int) -> None:
        spark = reports.sparkSession
        kinds = ", ".join(f"{c} {reports.schema[c].dataType.simpleString()}" for c in on)
        stored = spark.read.schema(f"{kinds}, {RUN}, told boolean")
        version, content = commits.latest(spark, folder)
        if version <= batch_id:  # else a repeat of what is committed
            newest = content.get("newest")
            bound = newest if fresh[0] else content.get("before")
            reports = reports.withColumn("sent", F.col("sent").cast("timestamp"))
            seen = reports.agg(F.unix_millis(F.max("sent") - F.lit(late).cast("interval"))).first()[0]
            mark = max((m for m in (newest, seen) if m is not None), default=None)
            at = F.unix_micros("sent")
            in_time = at.isNotNull() if bound is None else at > bound * 1000
            runs = _reports(reports.where(in_time).withColumn("at", at), on, final)
            if content:
                known = stored.parquet(content["runs"]).where("not told").drop("told")
                runs = _without(_first(runs.unionByName(known), on), read_outcomes(spark, root, kinds), on)
            else:
                runs = _first(runs, on)
            over = F.coalesce(F.floor((F.col("started") + span) / 1000) < F.lit(mark), F.lit(False))
            path = f"{folder}/batch_id={batch_id}"
            # stored once: told runs and open ones are parts of the same rows
            runs.withColumn("told", over).write.mode("overwrite").partitionBy("told").parquet(path)
            content = {"newest": mark, "before": newest, "runs": path}
            commits.commit(spark, folder, batch_id + 1, content)
            for old in commits.forget(spark, folder, KEEP):
                drop_path(spark, old["runs"])
        fresh[0] = False
        told = _outcomes(stored.parquet(content["runs"]).where("told"), on, span)
        append_run(told, f"{root}/outcomes", batch_id, lambda log: log, f"{kinds}, {OUTCOME}")

    return drain(states, handle, f"{root}/checkpoint", every=every)


def read_outcomes(spark: SparkSession, root: str, key_types: str = "job_name string, job_instance int") -> DataFrame:
    """All outcomes told so far."""
    return read_runs(spark, f"{root}/outcomes", f"{key_types}, {OUTCOME}")
