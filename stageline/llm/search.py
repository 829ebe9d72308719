"""Ranked lexical search by pipelined term partitioning.

The terms of the queries are dealt to a few owners, rare terms first. Documents are cut
into shards, and for every shard a bundle travels from owner to owner: it carries, for
each query item, sparse accumulators (document, score so far). A stage cogroups the
bundles with the postings that its owner holds, adds their integer contributions, and
lets go of the accumulators that the owners still to come cannot lift into the best k.
After the last owner the best of all shards are selected.

What is let go: a document whose score so far, with the most that all later owners can
add in its shard, stays below the k-th best score so far of the item. At least k
documents end at or above that, so that the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import alnum_words, slices, summed, text_bytes, text_rows, words, written

#: results per item, and owners that the terms are dealt to
BEST, OWNERS = 10, 4
#: documents and bytes of text in a shard: bounds of what one task holds
SHARD_DOCS, SHARD_BYTES = 4096, 16 << 20
#: items and distinct terms that are searched at a time; more items are more blocks
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 16

POSTINGS = "values array<double>, ids array<long>, lengths array<long>, docs array<int>, terms array<int>, counts array<int>"
ROUTED = "owner int, shard long, docs array<int>, terms array<int>, adds array<long>, later array<long>, ids array<long>"
BUNDLE = "shard long, starts array<long>, docs array<int>, scores array<long>, best array<long>"
FOUND = "item int, doc_id long, score long"


def _item_terms(batches: Iterator[pa.RecordBatch], items: int, most: int) -> Iterator[pa.RecordBatch]:
    """Items with their distinct terms, dealt to blocks in the order of the task."""
    table, block, n_items, n_terms = alnum_words(), 0, 0, 0
    for batch in slices(batches):
        hashes, starts = words(*text_bytes(batch.column("text")), table)
        own = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        blocks = []
        for terms in own:
            if n_items and (n_items >= items or n_terms + len(terms) > most):
                block, n_items, n_terms = block + 1, 0, 0
            n_items, n_terms = n_items + 1, n_terms + len(terms)
            blocks.append(block)
        columns = [batch.column("id"), pa.array(blocks, pa.int64()), pa.array(own, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "block", "terms"])


def item_blocks(queries: DataFrame, id_col: str, text_col: str, items: int, most: int) -> DataFrame:
    """``place, id, block, terms``, stored. A block holds at most ``items`` items and ``most``
    terms; only an item that has more terms by itself is a block beyond that."""
    rows = text_rows(queries, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.repartition(max(1, -(-rows.count() // items)))
    found = rows.mapInArrow(lambda b: _item_terms(b, items, most), f"id {kind}, block long, terms array<long>")
    part = F.shiftright(F.monotonically_increasing_id(), 33)
    return written(
        found.select(
            F.monotonically_increasing_id().alias("place"),
            "id",
            (F.shiftleft(part.cast("long"), 33) + F.col("block")).alias("block"),
            "terms",
        ),
        "search-items",
    )


@dataclass
class Block:
    """The items of a block: their terms, sorted, and which item asks for which term."""

    terms: np.ndarray
    asked_by: np.ndarray
    asks_for: np.ndarray
    n_items: int

    @classmethod
    def of(cls, own: list[np.ndarray]) -> Block:
        flat = np.concatenate([*own, np.zeros(0, np.uint64)])
        terms, place = np.unique(flat, return_inverse=True)
        item = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(place, kind="stable")
        return cls(terms, item[order], place[order], len(own))


def _rows(**columns) -> pa.RecordBatch:
    """One row; numpy arrays are list columns."""
    arrays = {}
    for name, value in columns.items():
        kind = value.type if isinstance(value, pa.Array) else pa.from_numpy_dtype(value.dtype)
        arrays[name] = pa.array([value], pa.list_(kind))
    return pa.RecordBatch.from_pydict(arrays)


def _postings(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per shard: (document, term, count) for the terms of the block, the lengths and
    ids of those documents, and for the statistics each term's documents, then the
    documents that have any term and all their terms."""
    table, n = alnum_words(), max(1, len(terms))
    held: list[tuple] = []

    def shard() -> pa.RecordBatch:
        values, ids, lengths, docs, term, count = zip(*held, strict=True)
        first = np.cumsum([0, *(len(x) for x in lengths[:-1])], dtype=np.int32)
        docs = [d + a for d, a in zip(docs, first, strict=True)]
        flat = [np.concatenate(x) for x in (lengths, docs, term, count)]
        names = ("lengths", "docs", "terms", "counts")
        return _rows(values=np.sum(values, axis=0), ids=pa.concat_arrays(ids), **dict(zip(names, flat, strict=True)))

    n_docs = size = 0
    for batch in slices(b.slice(at, SHARD_DOCS) for b in batches for at in range(0, b.num_rows, SHARD_DOCS)):
        data, offsets = text_bytes(batch.column("text"))
        if held and (n_docs + batch.num_rows > SHARD_DOCS or size + len(data) > SHARD_BYTES):
            yield shard()
            held, n_docs, size = [], 0, 0
        n_docs, size = n_docs + batch.num_rows, size + len(data)
        hashes, starts = words(data, offsets, table)
        length = np.diff(starts)
        at = np.searchsorted(terms, hashes)
        at[at == len(terms)] = 0
        hit = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
        doc = np.repeat(np.arange(len(length)), length)[hit]
        pair, count = np.unique(doc * n + at[hit], return_counts=True)
        doc, term = pair // n, pair % n
        some, doc = np.unique(doc, return_inverse=True)
        stats = np.append(np.bincount(term, minlength=n), [(length > 0).sum(), length.sum()]).astype(float)
        ids = batch.column("id").take(pa.array(some))
        held.append((stats, ids, length[some], doc.astype(np.int32), term.astype(np.int32), count.astype(np.int32)))
    if held:
        yield shard()


@dataclass
class Plan:
    """Weights and owners of the terms, and what the length of a document is measured against."""

    weights: np.ndarray
    owner: np.ndarray
    n_docs: int
    n_terms: int

    @classmethod
    def of(cls, df: np.ndarray, n_docs: int, n_terms: int, owners: int) -> Plan:
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
        order = np.argsort(df, kind="stable")
        owner = np.zeros(len(df), np.int32)
        total = np.cumsum(df[order])
        # rare terms first, each owner about the same number of postings
        owner[order] = np.minimum(owners - 1, (total - 1) * owners // max(1, total[-1] if len(total) else 1))
        owner[df == 0] = 0
        return cls(np.array(weights, np.int64), owner, n_docs, n_terms)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        values, at = np.unique(lengths, return_inverse=True)
        exact = [10 + 90 * int(v) * self.n_docs // self.n_terms for v in values]
        return np.array(exact, np.int64)[at]


def _list(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _route(batches: Iterator[pa.RecordBatch], block: Block, plan: Plan, owners: int) -> Iterator[pa.RecordBatch]:
    """A row per shard and owner: its postings by term, as contributions, and per item the
    most that later owners can add in this shard."""
    for batch in batches:
        for row in range(batch.num_rows):
            docs, terms, counts, lengths = (_list(batch, c, row) for c in ("docs", "terms", "counts", "lengths"))
            counts, norms = counts.astype(np.int64), plan.norms(lengths)
            adds = plan.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * norms[docs]))
            peaks = np.zeros(len(block.terms), np.int64)
            np.maximum.at(peaks, terms, adds)
            asked, owner = block.asks_for, plan.owner[terms]
            for o in range(owners):
                mine = np.flatnonzero(owner == o)
                mine = mine[np.argsort(terms[mine], kind="stable")]
                most = np.where(plan.owner[asked] > o, peaks[asked], 0)
                later = np.bincount(block.asked_by, most, minlength=block.n_items).astype(np.int64)
                ids = batch.column("ids")[row].values if o == owners - 1 else pa.array([], pa.int64())
                lists = _rows(docs=docs[mine], terms=terms[mine], adds=adds[mine], later=later, ids=ids)
                key = [pa.array([o], pa.int32()), batch.column("shard").slice(row, 1)]
                yield pa.RecordBatch.from_arrays([*key, *lists.columns], names=["owner", "shard", *lists.schema.names])


def _largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row the k largest values, in no order; zeros where there are fewer."""
    if scores.shape[1] < k:
        scores = np.pad(scores, ((0, 0), (0, k - scores.shape[1])))
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k :]


class Stage:
    """What the owner of some terms does with the bundle of a shard."""

    def __init__(self, block: Block, k: int, floor: np.ndarray, last: bool = False):
        self.k, self.floor, self.last, self.n_items = k, floor, last, block.n_items
        self.asked_by = block.asked_by
        self.asks = np.searchsorted(block.asks_for, np.arange(len(block.terms) + 1))

    def __call__(self, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        bundle, postings = bundle.combine_chunks(), postings.combine_chunks()
        docs, terms, adds, later = (_list(postings, c, 0) for c in ("docs", "terms", "adds", "later"))
        starts, held, scores = (_list(bundle, c, 0) for c in ("starts", "docs", "scores"))
        n_docs = 1 + int(max(docs.max(initial=-1), held.max(initial=-1)))
        sums = np.zeros((self.n_items, n_docs), np.int64)
        sums[np.repeat(np.arange(self.n_items), np.diff(starts)), held] = scores
        edges = np.append(np.flatnonzero(np.diff(terms, prepend=-1)), len(terms))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            t = terms[a]
            items = self.asked_by[self.asks[t] : self.asks[t + 1]]
            sums[items[:, None], docs[a:b]] += adds[a:b]
        best = _largest(sums, self.k)
        floor = np.maximum(self.floor, best.min(axis=1))
        keep = (sums > 0) & (sums + later[:, None] >= floor[:, None])
        item, doc = np.nonzero(keep)
        if self.last:
            ids = postings.column("ids").chunk(0)[0].values.take(pa.array(doc))
            return self.selected(item, ids, sums[item, doc])
        out = {
            "starts": np.searchsorted(item, np.arange(self.n_items + 1)),
            "docs": doc.astype(np.int32),
            "scores": sums[item, doc],
            "best": best.reshape(-1),
        }
        shard = postings.column("shard").combine_chunks()
        lists = _rows(**out)
        return pa.Table.from_arrays([shard, *lists.columns], names=["shard", *out])

    def selected(self, item: np.ndarray, ids: pa.Array, score: np.ndarray) -> pa.Table:
        """The best k of the shard: by score, then id, rows without an id last."""
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((ids.fill_null(0).to_numpy(), missing, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.k]
        columns = [pa.array(item[order], pa.int32()), ids.take(pa.array(order)), pa.array(score[order])]
        return pa.Table.from_arrays(columns, names=["item", "doc_id", "score"])


def _floors(bundles: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Per item the k-th best score so far, over all shards. Each task sends one row."""

    def merge(batches):
        held = np.zeros((n_items, k), np.int64)
        for batch in batches:
            for best in batch.column("best"):
                held = _largest(np.hstack((held, best.values.to_numpy().reshape(n_items, k))), k)
        yield _rows(best=held.reshape(-1))

    some = bundles.select("best").mapInArrow(merge, "best array<long>")
    some = some.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16))).repartition(16, "part").drop("part")
    rows = some.mapInArrow(merge, "best array<long>").collect()
    return _largest(np.hstack([np.array(r["best"]).reshape(n_items, k) for r in rows]), k).min(axis=1)


def _visited(bundles: DataFrame, postings: DataFrame, owner: int, stage: Stage, schema: str) -> DataFrame:
    """The bundles after they met the postings of an owner."""

    def visit(bundle, held):
        return stage(bundle, held)

    own = postings.where(F.col("owner") == owner)
    return bundles.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(visit, schema)


def _search_block(docs: DataFrame, block: Block, k: int, owners: int) -> DataFrame:
    """``item, doc_id, score`` of the best k of every shard, for the items of one block."""
    found = docs.mapInArrow(lambda b: _postings(b, block.terms), POSTINGS)
    stored = written(found.withColumn("shard", F.monotonically_increasing_id()), "search-postings")
    total = summed(stored.select(F.lit(0).alias("row"), "values")).collect()
    values = np.array(total[0]["values"], np.int64) if total else np.zeros(3, np.int64)
    if not len(block.terms) or not values[:-2].any():
        return docs.sparkSession.createDataFrame([], FOUND)
    plan = Plan.of(values[:-2], int(values[-2]), int(values[-1]), owners)
    routed = stored.select("shard", "ids", "lengths", "docs", "terms", "counts").mapInArrow(
        lambda b: _route(b, block, plan, owners), ROUTED
    )
    postings = written(routed, "search-owners")
    floor = np.zeros(block.n_items, np.int64)
    nothing = F.array().cast("array<long>")
    bundles = postings.where("owner = 0").select(
        "shard", F.array_repeat(F.lit(0).cast("long"), block.n_items + 1).alias("starts"),
        nothing.cast("array<int>").alias("docs"), nothing.alias("scores"), nothing.alias("best"),
    )
    for o in range(owners - 1):
        bundles = written(_visited(bundles, postings, o, Stage(block, k, floor), BUNDLE), "search-bundles")
        floor = _floors(bundles, block.n_items, k)
    return _visited(bundles, postings, owners - 1, Stage(block, k, floor, last=True), FOUND)


def search(
    docs: DataFrame, queries: DataFrame, k: int = BEST, owners: int = OWNERS, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``k`` best documents per item: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII digits and letters and of all characters beyond ASCII, A-Z
    lower-cased, and are compared by 64-bit hashes. All documents count for the statistics,
    each of their terms with all its occurrences; an item counts each of its terms once.
    Only scores above 0 are ranked; equal ones by ascending id, rows without an id last.
    Null and empty texts have no terms: such a document is in no statistic, such an item
    has no rows. Rows that repeat an id, documents or items, stand for themselves, so that
    a repeated item is ranked once per row. Other columns are not read. Empty tables give
    no rows. Very long texts are read alone, as whole texts. Ids of documents are whole
    numbers. Items beyond ``block_items`` or ``block_terms`` are searched in further blocks,
    each with one pass over the documents.
    """
    items = item_blocks(queries, item_col, item_text_col, block_items, block_terms)
    texts = text_rows(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    results = []
    for (number,) in items.select("block").distinct().orderBy("block").collect():
        own = items.where(F.col("block") == number)
        rows = own.select("place", "terms").orderBy("place").collect()
        block = Block.of([np.array(r["terms"], np.int64).view(np.uint64) for r in rows])
        found = _search_block(texts, block, k, owners)
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        first = min(r["place"] for r in rows)
        names = own.select((F.col("place") - first).cast("int").alias("item"), F.col("id").alias("item_id"))
        results.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        kind = queries.schema[item_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
