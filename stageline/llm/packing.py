"""Best-fit packing by patterns.

The histogram of piece lengths is all the planner sees: it enumerates patterns of few
documents that fill a sequence, fits how often each repeats by non-negative least
squares, rounds down, and packs the residual histogram best fit. Spark then ranks the
pieces of each length and every piece finds its slot by length and rank.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import slices, text_rows, written
from stageline.llm.tokens import encoded, encoder, read_vocabulary

CAPACITY = 2048
END_ID = 0
#: pieces of one length that are ranked together; a common length is split into more groups
RANK_GROUP = 1000
#: patterns of three that the fit may use, spread over all lengths
TRIPLES = 6000
SWEEPS = 40
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encode_pieces(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Documents as ids and an end id, longer ones cut; the first piece takes the remainder."""
    spec = read_vocabulary(vocabulary)
    names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids

    def cut(batches):
        encode = encoder(spec)
        for batch in slices(batches):
            keys = batch.column("id").to_pylist()
            rows = []
            for i, ids in encoded(batch, encode):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for k, start in enumerate(starts):
                    own = ids[start : starts[k + 1] if k + 1 < len(starts) else None]
                    rows.append((keys[i], k, start, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)

    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def patterns(lengths: list[int], capacity: int) -> list[tuple[int, ...]]:
    """Few-document patterns that fill a sequence to the last token."""
    known = set(lengths)
    out = [(n,) for n in lengths if n == capacity]
    out += [(n, capacity - n) for n in lengths if n >= capacity - n and capacity - n in known]
    triples = []
    step = max(1, len(lengths) * len(lengths) // (4 * TRIPLES))
    at = 0
    for i, a in enumerate(lengths):
        for b in lengths[: i + 1]:
            at += 1
            c = capacity - a - b
            if at % step == 0 and 0 < c <= b and c in known:
                triples.append((a, b, c))
    return out + triples


def fit_repeats(found: list[tuple[int, ...]], counts: dict[int, int]) -> np.ndarray:
    """x >= 0 with the least squared error of the lengths used, by coordinate descent."""
    residual = {n: float(c) for n, c in counts.items()}
    columns = [[(n, p.count(n)) for n in sorted(set(p))] for p in found]
    norms = [sum(m * m for _, m in col) for col in columns]
    x = np.zeros(len(found))
    for _ in range(SWEEPS):
        moved = 0.0
        for j, col in enumerate(columns):
            step = max(-x[j], sum(m * residual[n] for n, m in col) / norms[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, m in col:
                    residual[n] -= m * step
        if moved < 0.25:
            break
    return x


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """([(length, how many), ...], repeats): patterns that use every piece exactly once."""
    left = {n: c for n, c in counts.items() if c > 0}
    found = patterns(sorted(left), capacity)
    out = []
    x = fit_repeats(found, left)
    for j in np.argsort(-x, kind="stable"):
        need = [(n, found[j].count(n)) for n in sorted(set(found[j]), reverse=True)]
        repeats = min(int(x[j] + 1e-9), *(left.get(n, 0) // m for n, m in need))
        if repeats > 0:
            out.append((need, repeats))
            for n, m in need:
                left[n] -= m * repeats
    left = {n: c for n, c in left.items() if c}
    open_lengths = sorted(left)
    while open_lengths:
        space, need = capacity, []
        top = len(open_lengths)
        while space and (top := bisect.bisect_right(open_lengths, space, 0, top)):
            n = open_lengths[top - 1]
            many = min(space // n, left[n])
            need.append((n, many))
            space -= n * many
            top -= 1
        repeats = min(left[n] // m for n, m in need)
        out.append((need, repeats))
        for n, m in need:
            left[n] -= m * repeats
            if not left[n]:
                open_lengths.pop(bisect.bisect_left(open_lengths, n))
    return out


def slots(planned: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows of length, first rank, pieces per sequence, first sequence, offset; sorted."""
    used, rows, sequence = {}, [], 0
    for need, repeats in planned:
        offset = 0
        for n, m in need:
            rows.append((n, used.get(n, 0), m, sequence, offset))
            used[n] = used.get(n, 0) + m * repeats
            offset += n * m
        sequence += repeats
    table = np.array(rows, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Column ``rank``: 0, 1, ... within a length, in groups so that no length is one task."""
    spark = pieces.sparkSession
    groups = [(n, -(-c // RANK_GROUP)) for n, c in counts.items()]  # at most ``capacity`` rows
    groups = spark.createDataFrame(groups, "length long, groups long")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("groups"))
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "part").count()
    bases = bases.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = dealt.withColumn("at", F.row_number().over(order) - 1)
    return numbered.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("at")).drop("groups", "part", "at", "base")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (``length``, keys) with ``sequence_id`` and ``offset``: gapless from 0."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    table = slots(plan(counts, capacity))
    names = [*pieces.columns, "sequence_id", "offset"]
    key = lambda length, rank: length.astype(np.int64) * (1 << 45) + rank

    def place(batches):
        firsts = key(table[:, 0], table[:, 1])
        for batch in batches:
            length, rank = batch.column("length").to_numpy(False), batch.column("rank").to_numpy(False)
            own = table[np.searchsorted(firsts, key(length, rank), "right") - 1]
            nth = rank - own[:, 1]
            found = [pa.array(own[:, 3] + nth // own[:, 2]), pa.array(own[:, 4] + nth % own[:, 2] * length)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names[:-2]] + found, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked(pieces, counts).select(*pieces.columns, "rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, **columns: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset.

    A null or empty text is the end id alone. Rows that repeat a document are packed
    each; a null id stays null. Other columns are not read; an empty table gives none.
    """
    return pack(written(encode_pieces(docs, vocabulary, capacity, with_ids, **columns), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from ``pack_documents(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
