"""Order restored across files: messages are released by number, gaps are waited for.

Files carry no order among themselves, so a micro-batch may hold messages whose
predecessors come later. Those are held back, and released with the micro-batch that
closes the gap before them. What reaches the driver is one number per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline.session import drop_path
from stageline.sinks import commits

#: manifests that stay, for a repeated micro-batch
KEEP = 2


def next_missing(messages: DataFrame, start: int, seq: str = "seq") -> int:
    """The first number from ``start`` on that no message has.

    Each number also names the one after it; the least that is only named is missing. One
    aggregate over pairs of numbers, combined per task: no sort and no window over all.
    """
    here = messages.where(F.col(seq) >= start).select(
        F.explode(F.array(F.struct(F.col(seq).alias("n"), F.lit(True).alias("there")),
                          F.struct((F.col(seq) + 1).alias("n"), F.lit(False).alias("there")))).alias("x")
    ).select("x.*")
    named = messages.sparkSession.range(start, start + 1).select(F.col("id").alias("n"), F.lit(False).alias("there"))
    missing = here.unionByName(named).groupBy("n").agg(F.max("there").alias("there")).where("not there")
    return missing.agg(F.min("n")).first()[0]


def in_order(
    handle: Callable[[DataFrame, int], None], root: str, first: int, seq: str = "seq"
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that gives ``handle`` the messages that no gap precedes.

    Numbers run from ``first`` without gaps. Released and held messages are stored per
    micro-batch, so that a repeated one releases the same. A message that comes again after
    its number was released is dropped; of several with one number one is kept. What is
    held follows the disorder of the files; a message that never comes holds all after it.
    """
    folder = f"{root}/order"

    def ordered(messages: DataFrame, batch_id: int) -> None:
        spark, schema = messages.sparkSession, messages.schema
        out, wait = f"{folder}/released/batch_id={batch_id}", f"{folder}/held/batch_id={batch_id}"
        version, content = commits.latest(spark, folder)
        if version <= batch_id:  # else a repeat of what is committed
            start, rows = content.get("next", first), messages
            if content:
                rows = rows.unionByName(spark.read.schema(schema).parquet(content["held"]))
            # stored once: what is released and what is held are parts of the same rows
            both = f"{folder}/taken"
            rows.where(F.col(seq) >= start).dropDuplicates([seq]).write.mode("overwrite").parquet(both)
            rows = spark.read.schema(schema).parquet(both)
            upto = next_missing(rows, start, seq)
            rows.where(F.col(seq) < upto).write.mode("overwrite").parquet(out)
            rows.where(F.col(seq) >= upto).write.mode("overwrite").parquet(wait)
            commits.commit(spark, folder, batch_id + 1, {"next": upto, "held": wait, "released": out})
            for old in commits.forget(spark, folder, KEEP):
                drop_path(spark, old["held"])
                drop_path(spark, old["released"])
        handle(spark.read.schema(schema).parquet(out), batch_id)

    return ordered
