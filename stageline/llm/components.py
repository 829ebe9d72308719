"""Connected components of links between 64-bit nodes, by large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import written


def _least(links: DataFrame) -> DataFrame:
    """Per node the least of it and its neighbours; stored, so that the join with it has
    plain exchanges on both sides and a node with very many links can be split."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return written(least.select(F.col("u").alias("node"), F.least("u", "least").alias("least")), "least")


def _star(links: DataFrame, keep) -> DataFrame:
    joined = links.join(_least(links), F.col("u") == F.col("node"))
    return joined.where(keep).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _settled(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return roles.where("up > 1 or up = 1 and root = 1").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: the least node it reaches.

    Each round ties the larger neighbours of a node to its least neighbour, then the
    smaller ones; the rounds grow with the logarithm of the longest path. All rounds are
    stored; nothing but an answer per round reaches the driver. Without edges there are no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = written(links, "links")
    for _ in range(max_rounds):
        if _settled(links):
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, F.col("v") > F.col("u")).where("u <> v").distinct()
        large = written(large, "links")
        # small star: every node has its smaller neighbours; tie them and itself to the least
        least = _least(large)
        joined = large.join(least, F.col("u") == F.col("node"))
        small = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select(F.col("node").alias("u"), F.col("least").alias("v"))
        )
        links = written(small.where("u <> v").distinct(), "links")
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
