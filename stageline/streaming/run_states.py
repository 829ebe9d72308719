"""Follow runs to their last state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stageline import schemas
from stageline.streaming.keyed_state import append_run, read_runs
from stageline.streaming.messages import drain

KEY_TYPES = "job_name string, job_instance int"


def latest_state(
    states: DataFrame,
    on: list[str] = schemas.INSTANCE_KEY,
    seq: str = "seq",
    state: str = "status",
) -> DataFrame:
    """The last state of each key by sequence number; on frames and on streams."""
    return states.groupBy(*on).agg(
        F.max_by(state, seq).alias("last_status"), F.max(seq).alias("last_seq")
    )


def run_state_log(
    stream: DataFrame,
    root: str,
    on: list[str] = schemas.INSTANCE_KEY,
    state: str = "status",
    every: str | None = None,
) -> StreamingQuery:
    """Keep the last state per key as stream state, and log the keys that changed.

    States are combined per task before the shuffle, so a run that reports much
    more than the others costs one row per task. Only changed keys are written, and the
    log is folded by levels, so that reading it does not grow with the micro-batches.
    """

    def handle(changed: DataFrame, batch_id: int) -> None:
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in changed.schema)
        append_run(changed, f"{root}/changes", batch_id, lambda log: _last(log, on), types)

    states = latest_state(stream, on, state=state)
    return drain(states, handle, f"{root}/checkpoint", "update", every)


def read_state_log(spark: SparkSession, root: str, key_types: str = KEY_TYPES) -> DataFrame:
    """The last state per key from the log, ready for ``mark_ended``."""
    log = read_runs(spark, f"{root}/changes", f"{key_types}, last_status string, last_seq bigint")
    return _last(log, [c for c in log.columns if c not in ("last_status", "last_seq")])


def _last(log: DataFrame, on: list[str]) -> DataFrame:
    return latest_state(log, on, "last_seq", "last_status")
