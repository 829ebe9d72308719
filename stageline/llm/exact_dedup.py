"""Exact dedup: two passes with a Bloom filter, DataFrame functions only.

Pass 1 sets, for each row, two cells of a hash space; a cell that two rows set is
kept. Pass 2 tests each row against the kept cells: a row with a cell of its own has
no equal, and passes straight through. Only the others, which may repeat, shuffle.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import SPACES, written

#: cells of a row, as a power of two of the count of rows
CELLS_PER_ROW = 16
#: bits of one bitmap row of the filter: what ``bitmap_construct_agg`` makes
BITMAP_BITS = 32768
#: most cells of the filter: 2**29 bits, 64 MB; the proven bound of what is broadcast
MAX_CELLS = 1 << 29


def normalised(text: Column) -> Column:
    """The text without space, tab, line feed, vertical tab, form feed, carriage return."""
    return functools.reduce(
        lambda t, c: F.replace(t, F.lit(chr(c)), F.lit("")), SPACES, F.coalesce(text, F.lit(""))
    )


def with_signature(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn("__sha", F.sha2(normalised(F.col(text_col)).cast("binary"), 256))


def filter_cells(rows: int) -> int:
    """Cells for so many rows; all sizes follow the same rule up to the bound."""
    return min(MAX_CELLS, max(BITMAP_BITS, 1 << (CELLS_PER_ROW * max(rows, 1) - 1).bit_length()))


def _cells(cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64("__sha", F.lit(seed)), F.lit(cells)) for seed in (1, 2)]


def repeat_filter(signatures: DataFrame, cells: int) -> DataFrame:
    """Bitmaps of the cells that two rows or more have set: ``bucket``, ``bits``."""
    cell = signatures.select(F.explode(F.array(*_cells(cells))).alias("cell"))
    twice = cell.groupBy("cell").count().where("count >= 2")
    return twice.groupBy(F.expr(f"cell div {BITMAP_BITS}").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(cell % {BITMAP_BITS})").alias("bits")
    )


def flag_repeats(signatures: DataFrame, bitmaps: DataFrame, cells: int) -> DataFrame:
    """Column ``__maybe``: both cells of the row were set twice. Never false for a repeat."""
    out = signatures
    for i, cell in enumerate(_cells(cells)):
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"__b{i}"), F.col("bits").alias(f"__w{i}")))
        at = F.pmod(cell, F.lit(BITMAP_BITS))
        byte = F.conv(F.hex(F.substring(F.col(f"__w{i}"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
        out = (
            out.join(side, F.expr(f"pmod(xxhash64(__sha, {i + 1}), {cells}L) div {BITMAP_BITS}") == F.col(f"__b{i}"), "left")
            .withColumn(f"__m{i}", F.coalesce(F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1, F.lit(False)))
            .drop(f"__b{i}", f"__w{i}")
        )
    return out.withColumn("__maybe", F.col("__m0") & F.col("__m1")).drop("__m0", "__m1")


def _signatures(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    slim = with_signature(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    slim = slim.select("doc_id", "__sha", F.coalesce(F.length("text"), F.lit(0)).alias("__points"))
    slim = written(slim, "signatures")
    cells = filter_cells(slim.count())
    return slim, written(repeat_filter(slim, cells), "repeat-filter"), cells


def _groups(maybe: DataFrame) -> DataFrame:
    """Per text: the row that stays and the count of rows."""
    best = F.min(F.struct((-F.col("__points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id"))
    groups = maybe.groupBy("__sha").agg(best["doc_id"].alias("keep_id"), F.count("*").alias("group_size"))
    # stored, so that a join has plain exchanges on both sides, which Spark can split for a hot text
    return written(groups, "groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Equal are texts that are identical without white space. The longest original text,
    then the smallest id, stays. Null text is empty; a null id comes after all others;
    rows that repeat an id count one by one and carry the same answer. Other columns
    are not read. An empty table gives no rows.
    """
    slim, bitmaps, cells = _signatures(docs, id_col, text_col)
    flagged = flag_repeats(slim, bitmaps, cells)
    alone = flagged.where("not __maybe").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
    maybe = flagged.where("__maybe")
    again = maybe.join(_groups(maybe), "__sha").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
    return alone.unionByName(again)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns. Texts that surely have no equal do not shuffle.

    Of rows that repeat the id that stays, one is kept.
    """
    slim, bitmaps, cells = _signatures(docs, id_col, text_col)
    flagged = flag_repeats(with_signature(docs, text_col), bitmaps, cells)
    winners = _groups(flag_repeats(slim, bitmaps, cells).where("__maybe")).select(
        F.col("__sha").alias("__won"), F.col("keep_id").alias("__keep")
    )
    stay = flagged.where("__maybe").join(
        winners, (F.col("__sha") == F.col("__won")) & F.col(id_col).eqNullSafe(F.col("__keep"))
    )
    one = stay.dropDuplicates(["__sha"])
    return flagged.where("not __maybe").select(*docs.columns).unionByName(one.select(*docs.columns))
