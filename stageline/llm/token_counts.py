"""Token counts by an exact histogram of encoded lengths.

Documents are aggregated by length before anything else moves. Suffix sums over the
histogram then answer, for every context limit, how much of the corpus fits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import written
from stageline.llm.tokens import token_lengths

#: lengths of one block of the suffix sums
BLOCK = 256


def length_histogram(docs: DataFrame, vocabulary: str | None = None, **columns: str) -> DataFrame:
    """``n_tokens``, ``n_docs``: combined per task before the shuffle."""
    lengths = token_lengths(docs, vocabulary, **columns)
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limit_answers(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as the context limit.

    n_docs and n_tokens at that length; n_longer and longer_tokens beyond it;
    truncated_total, the tokens left when each document is cut at the limit;
    share, the part of documents that fit whole. Sums run in blocks of lengths, so that
    no task sees the whole histogram. An empty histogram gives no rows.
    """
    rows = histogram.select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.expr(f"n_tokens div {BLOCK}").alias("block")
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    after = Window.partitionBy(F.lit(0)).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("block_docs").over(whole).alias("all_docs"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        "tokens",
        "all_docs",
        (F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("docs_after")).alias("n_longer"),
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("tokens_after")).alias("longer_tokens"),
    )
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return joined.withColumn("all_tokens", total).select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "n_longer",
        "longer_tokens",
        (F.col("all_tokens") - F.col("longer_tokens") + F.col("n_longer") * F.col("n_tokens")).alias("truncated_total"),
        "all_tokens",
        ((F.col("all_docs") - F.col("n_longer")) / F.col("all_docs")).alias("share"),
    )


def quantiles(answers: DataFrame, shares: list[float]) -> DataFrame:
    """The least length that at least the given share of documents does not exceed."""
    wanted = answers.sparkSession.createDataFrame([(float(s),) for s in shares], "wanted double")
    return (
        answers.join(F.broadcast(wanted), F.col("share") >= F.col("wanted"))
        .groupBy("wanted")
        .agg(F.min("context_limit").alias("n_tokens"))
    )


def token_counts(docs: DataFrame, vocabulary: str | None = None, **columns: str) -> DataFrame:
    """``limit_answers`` of the documents. Null and empty texts have length 0; repeated
    rows count one by one; other columns are not read."""
    return limit_answers(written(length_histogram(docs, vocabulary, **columns), "lengths"))
