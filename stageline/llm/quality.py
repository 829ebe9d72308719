"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Document statistics are standardised; cosines of random directions approximate a
Gaussian kernel over them; each partition sums its part of the normal equations, the
sums are added up, and the ridge scores are calibrated by pooling adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import slices, space_words, summed, text_bytes, text_rows, words, written

#: random directions, width of the kernel in standard deviations, ridge, score bins
FEATURES, WIDTH, RIDGE, BINS, SEED = 192, 4.0, 1.0, 2000, 20240
THRESHOLD = 0.7


def _bytes_of(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: shares of bytes that count as statistics
CLASSES = {
    "upper": _bytes_of((0x41, 0x5A)),
    "lower": _bytes_of((0x61, 0x7A)),
    "digit": _bytes_of((0x30, 0x39)),
    "beyond_ascii": _bytes_of((0x80, 0xFF)),
    "space": _bytes_of((0x20, 0x20), (0x09, 0x0D)),
    "newline": _bytes_of((0x0A, 0x0A)),
    "comma_stop": _bytes_of((0x2C, 0x2C), (0x2E, 0x2E)),
    "shout": _bytes_of((0x21, 0x21), (0x3F, 0x3F)),
    "symbol": _bytes_of((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60)),
    "bar": _bytes_of((0x7B, 0x7E)),
}
STATISTICS = [
    *CLASSES, "log_bytes", "log_words", "word_bytes", "word_spread", "distinct_words", "repeated_pairs",
    "top_word", "words_a_line", "repeated_lines", "short_words", "long_words",
]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(row: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the count of distinct values (by 40 bits) and of the most frequent one."""
    packed = np.sort(row.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    at = np.flatnonzero(np.append(True, packed[1:] != packed[:-1])) if len(packed) else np.zeros(0, np.int64)
    r = (packed[at] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, r, np.diff(np.append(at, len(packed))))
    return np.bincount(r, minlength=n).astype(float), most


def document_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` per text; a text without bytes or words has zeros there."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    cell = np.repeat(np.arange(0, 256 * n, 256), np.diff(offsets))
    cell += data
    histogram = np.bincount(cell, minlength=256 * n).reshape(n, 256)
    out = [histogram @ table / size for table in CLASSES.values()]
    not_space = space_words()
    hashes, starts, length = words(data, offsets, not_space, with_lengths=True)
    count = np.diff(starts)
    row = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1)
    mean = _sums(length, starts) / some
    spread = np.sqrt(np.maximum(_sums(length**2, starts) / some - mean**2, 0))
    distinct, top = _distinct(row, hashes, n)
    same = row[1:] == row[:-1]
    pairs, _ = _distinct(row[1:][same], (hashes[1:] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1])[same], n)
    newline = np.zeros(256, bool)
    newline[0x0A] = True
    lines, line_starts = words(data, offsets, ~newline)
    n_lines = np.diff(line_starts)
    own_lines, _ = _distinct(np.repeat(np.arange(n), n_lines), lines, n)
    out += [
        np.log1p(np.diff(offsets)),
        np.log1p(count),
        mean,
        spread,
        distinct / some,
        1 - pairs / np.maximum(count - 1, 1),
        top / some,
        np.log1p(count / np.maximum(n_lines, 1)),
        1 - own_lines / np.maximum(n_lines, 1),
        _sums(length <= 3, starts) / some,
        _sums(length >= 12, starts) / some,
    ]
    return np.nan_to_num(np.stack(out, axis=1))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and an array of statistics per document, one pass over the texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = document_statistics(*text_bytes(batch.column("text")))
            flat = pa.array(found.reshape(-1))
            ends = pa.array(np.arange(0, flat.__len__() + 1, len(STATISTICS), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "stats"])

    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return rows.mapInArrow(scan, "doc_id long, stats array<double>")


@dataclass
class Model:
    """Centre and scale of the statistics, directions, phases, weights, calibration."""

    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.centre) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack((np.ones((len(z), 1)), z / len(self.centre) ** 0.5, waves))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0, 1)


def pool_adjacent(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``value`` (isotonic regression)."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1] += b[1]
            a[2] += b[2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _stats_matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def fit(stats: DataFrame, labels: DataFrame, held_out: Column, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE) -> Model:
    """Learns from every labelled document that is not held out, each one once.

    ``stats`` has doc_id and stats, ``labels`` doc_id and label (0 or 1; null or clashing
    labels of an id are left out). Only sums go to the driver: moments, the normal
    equations and the score bins, whose sizes do not depend on the data. Without any
    labelled row all scores are 0.5.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("__max"))
    known = known.where("label = __max").select("doc_id", F.col("label").cast("double").alias("label"))
    train = written(stats.where(~held_out).join(known, "doc_id").select("stats", "label"), "train")
    k = len(STATISTICS)
    rng = np.random.default_rng(SEED)
    directions, phases = rng.standard_normal((k, features)) / width, rng.uniform(0, 2 * np.pi, features)

    def moments(batches):
        total = None
        for batch in batches:
            x = _stats_matrix(batch.column("stats"))
            if len(x):
                own = (np.array([float(len(x))]), x.sum(0), (x**2).sum(0))
                total = own if total is None else tuple(a + b for a, b in zip(total, own, strict=True))
        if total:
            rows = [v.tolist() for v in total]
            yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["row", "values"])

    schema = "row int, values array<double>"
    sums = {r["row"]: np.array(r["values"]) for r in summed(train.mapInArrow(moments, schema)).collect()}  # 3 rows
    if not sums:
        return Model(np.zeros(k), np.ones(k), directions, phases, np.zeros(1 + k + features), np.array([0.0]), np.array([0.5]))
    centre = sums[1] / sums[0]
    scale = np.sqrt(np.maximum(sums[2] / sums[0] - centre**2, 0))
    scale[scale < 1e-9] = 1.0
    model = Model(centre, scale, directions, phases, np.zeros(1 + k + features), np.zeros(1), np.zeros(1))

    def equations(batches):
        """The task's part of X'X and X'y, one row per feature."""
        total = 0
        for batch in batches:
            if batch.num_rows:
                x = model.features(_stats_matrix(batch.column("stats")))
                total = total + x.T @ np.hstack((x, batch.column("label").to_numpy()[:, None]))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "values"])

    rows = sorted(summed(train.mapInArrow(equations, schema)).collect())  # one per feature
    normal = np.array([r["values"] for r in rows])
    penalty = np.eye(len(normal)) * ridge
    penalty[0, 0] = 1e-9
    model.weights = np.linalg.solve(normal[:, :-1] + penalty, normal[:, -1])

    def bins(batches):
        total = np.zeros((3, BINS))
        for batch in batches:
            if batch.num_rows:
                raw, label = model.raw(_stats_matrix(batch.column("stats"))), batch.column("label").to_numpy()
                at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
                for j, w in enumerate((np.ones(len(raw)), label, raw)):
                    total[j] += np.bincount(at, w, BINS)
        yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "values"])

    count, ones, raw = (np.array(r["values"]) for r in sorted(summed(train.mapInArrow(bins, schema)).collect()))
    used = count > 0
    model.edges = raw[used] / count[used]
    model.levels = pool_adjacent(ones[used] / count[used], count[used])
    return model


def scored(stats: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    def score(batches):
        for batch in batches:
            if batch.num_rows:
                s = model.score(_stats_matrix(batch.column("stats")))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return stats.mapInArrow(score, "doc_id long, score double, predicted int")


def is_held_out(doc_id: Column) -> Column:
    """Documents that no fit may see: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    Statistics of the whole text are all that a score sees. Null text is empty and is
    scored like any other; rows that repeat an id are scored one by one; an empty table
    gives no rows. Other columns are not read.
    """
    stats = written(statistics(docs, id_col, text_col), "statistics")
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
    model = fit(stats, known, is_held_out(F.col("doc_id")))
    return scored(stats, model).withColumn("held_out", is_held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that the classifier does not reject, all columns; texts stay in place."""
    stats = statistics(docs)
    labelled = stats.join(labels.select(F.col("doc_id").alias("__id")).distinct(), F.col("doc_id") == F.col("__id"), "left_semi")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    model = fit(labelled, known, is_held_out(F.col("doc_id")))

    def good(batches):
        for batch in slices(batches):
            score = model.score(document_statistics(*text_bytes(batch.column("text"))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(good, docs.schema)
