"""Benchmark decontamination by winnowing.

A fingerprint is the hash of a gram of GRAM words; of each run of grams that fill one
window the least hash is kept. Equal windows keep the same hash, so every shared
window of ``window`` words shares a fingerprint: none is missed. Fingerprints of
documents are joined with those of the benchmark, each hit is extended over the
windows around it, and a window counts only if all its words agree.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stageline.llm.common import (
    alnum_words,
    gram_hashes,
    runs,
    sliding_min,
    slices,
    text_bytes,
    text_rows,
    words,
    written,
)

GRAM = 5
#: benchmark windows that may be sent to every task (24 bytes each); beyond, Spark joins
MAX_SENT_WINDOWS = 1_000_000
OUT = "id long, n_words long, n_hit long, n_items long, items_sha256 string, hit_starts array<int>, hit_ends array<int>, items array<long>"


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; its words' grams are part of no other rule."""
    return gram_hashes(hashes, size)


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words the least hash of its grams."""
    gram = min(GRAM, size)
    grams = gram_hashes(hashes, gram)
    return sliding_min(grams, size - gram + 1) if len(grams) >= size - gram + 1 else grams[:0]


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows of (size, print, hash, item) for the windows of benchmark items."""
    table = alnum_words()
    for batch in slices(batches):
        hashes, starts = words(*text_bytes(batch.column("text")), table)
        for item, a, b in zip(batch.column("id").to_pylist(), starts[:-1], starts[1:], strict=True):
            size = min(window, b - a)
            if not size:
                continue
            own, least = windows(hashes[a:b], size), fingerprints(hashes[a:b], size)
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array(np.full(len(own), size, np.int32)),
                    "print": pa.array(least.view(np.int64)),
                    "hash": pa.array(own.view(np.int64)),
                    "item": pa.array([item] * len(own), pa.int64()),
                }
            )


def item_windows(benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    return (
        text_rows(benchmark, id_col, text_col)
        .withColumn("id", F.col("id").cast("long"))
        .mapInArrow(lambda b: _item_windows(b, window), "size int, print long, hash long, item long")
        .distinct()
    )


class Probe:
    """Windows of the benchmark by size: sorted fingerprints, sorted windows, items."""

    def __init__(self, rows: pd.DataFrame):
        self.sizes = {}
        for size, part in rows.groupby("size"):
            part = part.assign(hash=part["hash"].to_numpy().view(np.uint64)).sort_values("hash")
            prints = np.unique(part["print"].to_numpy().view(np.uint64))
            self.sizes[int(size)] = prints, part["hash"].to_numpy(), part["item"].astype(object).to_numpy()

    @staticmethod
    def found(values: np.ndarray, among: np.ndarray) -> np.ndarray:
        at = np.searchsorted(among, values)
        at[at == len(among)] = 0
        return among[at] == values if len(among) else np.zeros(len(values), bool)

    def hits(self, hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict[int, set]]:
        """Which words of all rows are hit, and the items found in each row."""
        flags, items = np.zeros(len(hashes), bool), {}
        for size, (prints, known, owner) in self.sizes.items():
            least = fingerprints(hashes, size)
            at = np.flatnonzero(self.found(least, prints))  # windows that hold a joined fingerprint
            row = np.searchsorted(starts, at, "right") - 1
            inside = at + size <= starts[row + 1]  # no window crosses rows
            at, row = at[inside], row[inside]
            own = np.zeros(len(at), np.uint64)
            if len(at):
                own = gram_hashes_at(hashes, at, size)
            real = self.found(own, known)
            at, row, own = at[real], row[real], own[real]
            for j in range(size):
                flags[at + j] = True
            low, high = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
            for r, a, b in zip(row.tolist(), low.tolist(), high.tolist(), strict=True):
                items.setdefault(r, set()).update(owner[a:b])
        return flags, items


def gram_hashes_at(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``gram_hashes`` at chosen places only."""
    return windows(hashes[at[:, None] + np.arange(size)].reshape(-1), size)[::size]


def items_digest(items: set) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _scan(batches: Iterator[pa.RecordBatch], probe: Probe) -> Iterator[pa.RecordBatch]:
    table = alnum_words()
    for batch in slices(batches):
        hashes, starts = words(*text_bytes(batch.column("text")), table)
        flags, items = probe.hits(hashes, starts)
        total = np.concatenate(([0], np.cumsum(flags)))
        out = {k: [] for k in ("n_items", "items_sha256", "hit_starts", "hit_ends", "items")}
        n_hit = total[starts[1:]] - total[starts[:-1]]
        for r in range(batch.num_rows):
            own = items.get(r, set())
            s, e = runs(flags[starts[r] : starts[r + 1]]) if n_hit[r] else ([], [])
            for key, value in zip(out, (len(own), items_digest(own), s, e, sorted(own)), strict=True):
                out[key].append(value)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").cast(pa.int64()),
                pa.array(np.diff(starts), pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(out["n_items"], pa.int64()),
                pa.array(out["items_sha256"], pa.string()),
                pa.array(out["hit_starts"], pa.list_(pa.int32())),
                pa.array(out["hit_ends"], pa.list_(pa.int32())),
                pa.array(out["items"], pa.list_(pa.int64())),
            ],
            names=["id", "n_words", "n_hit", "n_items", "items_sha256", "hit_starts", "hit_ends", "items"],
        )


def _doc_windows(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """All windows of the given sizes with their fingerprints, for benchmarks that are not sent."""
    table = alnum_words()
    for batch in slices(batches, limit=1 << 18):
        hashes, starts = words(*text_bytes(batch.column("text")), table)
        for r in range(batch.num_rows):
            own = hashes[starts[r] : starts[r + 1]]
            for size in sizes:
                found = windows(own, size)
                if len(found):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array([batch.column("row")[r].as_py()] * len(found), pa.int64()),
                            "size": pa.array(np.full(len(found), size, np.int32)),
                            "at": pa.array(np.arange(len(found), dtype=np.int32)),
                            "print": pa.array(fingerprints(own, size).view(np.int64)),
                            "hash": pa.array(found.view(np.int64)),
                        }
                    )


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hit spans of each row from its joined windows."""
    for part in batches:
        rows = []
        for row in part.itertuples():
            ends = {}
            for hit in row.hits if row.hits is not None else []:
                ends[hit["at"]] = max(ends.get(hit["at"], 0), hit["at"] + hit["size"])
            spans = []
            for a in sorted(ends):
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], ends[a])
                else:
                    spans.append([a, ends[a]])
            items = set(row.items) if row.items is not None else set()
            rows.append(
                (row.id, row.n_words, sum(b - a for a, b in spans), len(items), items_digest(items),
                 [a for a, _ in spans], [b for _, b in spans], sorted(items))
            )
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])


def _by_join(docs: DataFrame, bench: DataFrame, sizes: list[int]) -> DataFrame:
    """The same by a shuffle join on fingerprint and window, for a benchmark of any size."""
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = rows.mapInArrow(
        lambda b: _doc_windows(b, sizes), "row long, size int, at int, print long, hash long"
    ).join(bench, ["size", "print", "hash"])
    hits = found.groupBy("row").agg(F.collect_set(F.struct("at", "size")).alias("hits"), F.collect_set("item").alias("items"))
    empty = Probe(pd.DataFrame({"size": [], "print": [], "hash": [], "item": []}))

    def count(batches):
        for batch in slices(batches):
            out = next(_scan(iter([batch.select(["id", "text"])]), empty))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), out.column("id"), out.column("n_words")], names=["row", "id", "n_words"]
            )

    counted = rows.mapInArrow(count, "row long, id long, n_words long")
    return counted.join(hits, "row", "left").mapInPandas(_merged, OUT)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    max_sent: int = MAX_SENT_WINDOWS,
) -> DataFrame:
    """One row per document: counts, digest, hit spans in words, and the items found.

    Words are runs of ASCII letters, digits and any character beyond ASCII; A-Z count as
    a-z. An item shorter than ``window`` is one window of its own length; items and
    documents without words (null, empty) hit nothing. Repeated rows are answered row
    by row, equal windows of several items count for each item, and an empty table on
    either side gives no hits. Other columns are not read.
    """
    bench = written(item_windows(benchmark, window, item_col, text_col), "windows")
    rows = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    if bench.count() <= max_sent:
        probe = Probe(bench.toPandas())
        out = rows.mapInArrow(lambda b: _scan(b, probe), OUT)
    else:
        sizes = [r["size"] for r in bench.select("size").distinct().collect()]  # at most ``window``
        out = _by_join(rows, bench, sizes)
    return out.withColumnRenamed("id", "doc_id").withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_sent: int = MAX_SENT_WINDOWS
) -> DataFrame:
    """The documents that hold no window of the benchmark, all columns.

    Each row is judged by its own text, whatever its id: null ids, repeated ids and
    repeated rows change nothing. A null text has no words and stays. An empty benchmark
    drops nothing, an empty table gives no rows. Up to ``max_sent`` windows the benchmark
    goes to the tasks and rows stay in place; beyond, the numbers of the rows that are hit
    are joined off, with the same result.
    """
    bench = written(item_windows(benchmark, window), "windows")
    if bench.count() > max_sent:
        number = "__row_" + uuid.uuid4().hex  # a name that no document has
        rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        hit = contamination(rows, benchmark, window, id_col=number, max_sent=max_sent)
        hit = hit.where("contaminated").select(F.col("doc_id").alias(number))
        return rows.join(hit, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    probe, table = Probe(bench.toPandas()), alnum_words()

    def clean(batches):
        for batch in slices(batches):
            hashes, starts = words(*text_bytes(batch.column("text")), table)
            flags, _ = probe.hits(hashes, starts)
            total = np.concatenate(([0], np.cumsum(flags)))
            yield batch.filter(pa.array(total[starts[1:]] == total[starts[:-1]]))

    return docs.mapInArrow(clean, docs.schema)
