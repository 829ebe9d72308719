"""Helpers shared by the operators: written steps, Arrow slices, words as hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text that a task turns into arrays at a time; a longer text comes alone
SLICE_BYTES = 1 << 20
#: the white space that separates words and that exact dedup ignores
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def step_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors see: under spark.checkpoint.dir, else the warehouse."""
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a stored table: cuts the lineage, and a lost executor loses nothing."""
    path = step_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id`` and ``text`` only, so that no other name can clash; null text is empty."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``limit`` bytes of text, whole rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call."""
    if len(_powers[base]) < n:
        row = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        row[0] = 1
        _powers[base] = np.cumprod(row)
    return _powers[base][:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of codes[t] * BASE**t for i <= t < j, modulo 2**64."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of spans, equal for equal spans wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start] + (end - start).astype(np.uint64))


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of the len(values)-k+1 runs of k consecutive values."""
    n = max(0, len(values) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(BASE)
        out += values[j : j + n]
    return mix(out)


def space_words() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def alnum_words() -> np.ndarray:
    """ASCII digits and letters, and every byte of a character beyond ASCII."""
    table = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = True
    return table


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, with_lengths: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes of the words of all rows, A-Z lower-cased, and where each row's words begin (n+1);
    if asked for, the bytes of each word too."""
    inside = is_word[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = prefix_sums(BYTE_CODES[LOWER[data]])
    found = span_hashes(sums, start, end), np.searchsorted(start, offsets)
    return (*found, (end - start).astype(float)) if with_lengths else found


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least value of each run of w consecutive values."""
    width = 1
    while width * 2 <= w:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = w - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true flags."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def summed(parts: DataFrame) -> DataFrame:
    """Adds the arrays ``values`` of equal ``row`` in two levels; tasks send few rows each."""

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, values in zip(batch.column("row").to_pylist(), batch.column("values"), strict=True):
                held[row] = held.get(row, 0) + values.values.to_numpy(False)
        if held:
            values = pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), values], names=["row", "values"])

    schema = "row int, values array<double>"
    some = parts.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16)))
    return some.repartition("row", "part").drop("part").mapInArrow(add, schema).repartition("row").mapInArrow(add, schema)
