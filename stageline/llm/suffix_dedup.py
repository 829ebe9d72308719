"""Substring dedup over suffixes, by bucket-pointer refinement.

Every suffix belongs to the bucket of a q-gram it starts near: the gram of least hash
among those of its first ``length`` bytes. Equal strings have the same such gram, so
only suffixes of one bucket can be equal. Neighbouring suffixes with the same gram make
one block; buckets whose blocks are all one string need no sorting (all but the first
occurrence go), and buckets with one block are done. The suffixes of all other buckets
are refined: initial q-gram buckets, then sorts on the bucket identifiers of later
offsets, each round reading the buckets that the rounds before have updated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import (
    BYTE_CODES,
    gram_hashes,
    mix,
    prefix_sums,
    runs,
    sliding_min,
    slices,
    span_hashes,
    text_bytes,
    written,
)

LENGTH = 100
GRAM = 16
#: suffixes of one bucket that a task refines together; larger buckets are dealt out by
#: the fingerprint of the whole string instead
BUCKET_SUFFIXES = 2_000_000
#: bytes of blocks that a task refines at a time, cut between buckets
REFINE_BYTES = 2 << 20
FIRST_GRAM = 8
LAST_ID = (1 << 63) - 1
BLOCK = "m long, h long, doc long, th long, start long, n long, again boolean, range boolean"
SPAN = "doc long, th long, s long, e long"


def blocks(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of starts with the same least gram: start, starts, gram, string, repeats.

    The last says that the gram stands twice in the block, so that it may repeat itself.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, bool))
    sums = prefix_sums(BYTE_CODES[data])
    at = np.arange(n - gram + 1)
    grams = span_hashes(sums, at, at + gram)
    w = length - gram + 1
    least = sliding_min(grams, w)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    inside = at[: len(least)] + length <= ends
    same = np.zeros(len(least), bool)
    same[1:] = inside[:-1] & (least[1:] == least[:-1]) & (ends[1:] == ends[:-1])
    start = np.flatnonzero(inside & ~same)
    if not len(start):
        return blocks(data[:0], offsets[:1], length, gram)
    count = np.add.reduceat(inside.astype(np.int64), start)
    m = least[start]
    span = count + w - 1
    first = np.cumsum(span) - span
    each = np.arange(span.sum()) - np.repeat(first - start, span)
    twice = np.add.reduceat((grams[each] == np.repeat(m, span)).astype(np.int64), first) > 1
    return start, count, m, span_hashes(sums, start, start + count + length - 1), twice


def _scan(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Blocks of all texts. Blocks that a slice of the task has earlier are known to
    repeat; they come as ranges, so that a common block is not sent again and again."""
    for batch in slices(batches):
        data, offsets = text_bytes(batch.column("text"))
        start, count, m, h, twice = blocks(data, offsets, length, gram)
        row = np.searchsorted(offsets, start, "right") - 1
        doc, th = (batch.column(c).to_numpy(False)[row] for c in ("doc", "th"))
        start = start - offsets[row]
        order = np.lexsort((start, th, doc, h, m))
        repeat = np.zeros(len(m), bool)
        a, b = order[:-1], order[1:]
        first = np.zeros(len(order), np.int64)  # the first of each equal run, by place in the order
        new = np.append(True, (m[a] != m[b]) | (h[a] != h[b]))[: len(order)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        head = order[first]
        repeat[order] = (doc[head] != doc[order]) | (th[head] != th[order]) | (start[head] != start[order])
        # neighbours in a text that both repeat make one range
        end = start + count + length - 1
        joined = np.zeros(len(m), bool)
        joined[1:] = repeat[1:] & repeat[:-1] & (row[1:] == row[:-1])
        heads = np.flatnonzero(repeat & ~joined)
        tails = np.flatnonzero(repeat & ~np.append(joined[1:], False)[: len(m)])
        keep = ~repeat
        spread = mix(th[heads].view(np.uint64) ^ start[heads].astype(np.uint64))  # ranges have no bucket
        columns = (
            np.concatenate((m[keep], spread)).view(np.int64),
            np.concatenate((h[keep], spread)).view(np.int64),
            np.concatenate((doc[keep], doc[heads])),
            np.concatenate((th[keep], th[heads])),
            np.concatenate((start[keep], start[heads])),
            np.concatenate((count[keep], end[tails] - start[heads])),
            np.concatenate((twice[keep], np.zeros(len(heads), bool))),
            np.concatenate((np.zeros(keep.sum(), bool), np.ones(len(heads), bool))),
        )
        names = [c.split()[0] for c in BLOCK.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def refine(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the joined blocks: does the string of ``length`` bytes that starts
    here, inside its block, also start earlier? ``bounds`` are block ends (n+1).

    A bucket pointer is where a suffix's bucket begins in sorted order. A round sorts the
    members of each open bucket by the pointers ``step`` bytes later, which the rounds
    before have refined to the same depth; a suffix alone in its bucket is settled. Only
    suffixes that some string of ``length`` bytes leads to are sorted: those that start
    one in the last round, and in each round before also those ``step`` bytes later.
    """
    n = len(data)
    again = np.zeros(n, bool)
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    depths = [min(FIRST_GRAM, length)]
    while depths[-1] < length:
        depths.append(min(2 * depths[-1], length))
    steps = np.diff(depths, prepend=0).tolist()
    needs = [room >= length]
    for step in steps[:0:-1]:
        need = needs[-1].copy()
        need[step:] |= needs[-1][:-step]
        needs.append(need)
    padded = np.concatenate((data, np.zeros(FIRST_GRAM, np.uint8)))
    pointers = np.zeros(n, np.int64)
    settled = np.zeros(n, bool)
    for depth, step, need in zip(depths, steps, needs[::-1], strict=True):
        open_ = np.flatnonzero(need & ~settled)
        if not len(open_):
            break
        old = pointers[open_]
        if depth == depths[0]:
            key = np.zeros(len(open_), np.uint64)
            for j in range(step):
                key <<= np.uint64(8)
                key |= padded[open_ + j]
        else:
            key = old * np.int64(n + 1) + pointers[open_ + step]
        order = np.argsort(key, kind="stable")
        ranked, old = key[order], old[order]
        at = np.arange(len(order))
        new = np.append(True, ranked[1:] != ranked[:-1])
        first = np.maximum.accumulate(np.where(new, at, 0))
        bucket = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        sorted_ = open_[order]
        pointers[sorted_] = old + first - bucket
        if depth == length:
            again[sorted_] = at != first  # the sort is stable: the first of a bucket is its earliest
        settled[sorted_[new & np.append(new[1:], True)]] = True
    return again


def _refined(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans to remove, from blocks sorted by bucket and then by place."""

    def work(parts):
        table = pa.Table.from_batches(parts).combine_chunks()
        key = [table.column(c).to_numpy() for c in ("m", "doc", "th", "start")]
        new = np.append(True, np.any([k[1:] != k[:-1] for k in key], axis=0))  # rows that repeat a document
        table = table.filter(pa.array(new))
        data, bounds = text_bytes(table.column("body").combine_chunks())
        s, e = runs(refine(data, bounds, length))
        # a run never leaves its block: the last bytes of a block start nothing
        at = np.searchsorted(bounds, s, "right") - 1
        doc, th, start = (table.column(c).to_numpy()[at] for c in ("doc", "th", "start"))
        move = start - bounds[at]
        columns = (doc, th, s + move, e + move + length - 1)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "th", "s", "e"])

    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        m = batch.column("m").to_numpy(False)
        total = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column("body")).to_numpy(False), dtype=np.int64)))
        begin = 0
        for cut in np.flatnonzero(np.append(m[0] != last, m[1:] != m[:-1])).tolist():
            if size + total[cut] - total[begin] >= REFINE_BYTES and (held or cut > begin):
                yield work([*held, batch.slice(begin, cut - begin)])
                held, size, begin = [], 0, cut
        held.append(batch.slice(begin))
        size += total[-1] - total[begin]
        last = m[-1]
    if held:
        yield work(held)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one: they cross the network twice."""
    tool = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        body = pa.array([tool.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("th"), body], names=["doc", "th", "z"])


def _unpacked(row: bytes, tool: zstandard.ZstdDecompressor) -> bytes:
    return tool.decompress(row) if row else b""


def _bodies(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the blocks that are asked for, from the texts they stand in."""
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, th, z, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc", "th", "z", "wanted")), strict=True):
            text = _unpacked(z, tool)
            out += [(w["m"], w["large"], doc, th, w["start"], text[w["start"] : w["start"] + w["n"] + length - 1]) for w in wanted]
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        names = ["m", "large", "doc", "th", "start", "body"]
        for at in range(0, len(out), 20_000):
            columns = zip(*out[at : at + 20_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _strings(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per suffix of a block: the fingerprint of its first ``length`` bytes."""
    for batch in slices(batches, "body", 1 << 18):
        for doc, th, start, body in zip(*(batch.column(c).to_pylist() for c in ("doc", "th", "start", "body")), strict=True):
            codes = BYTE_CODES[np.frombuffer(body, np.uint8)]
            found = gram_hashes(codes, length)
            rows = (found.view(np.int64), np.full(len(found), doc), np.full(len(found), th), start + np.arange(len(found)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["c", "doc", "th", "start"])


def _answers(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc, z, spans in zip(*(batch.column(c).to_pylist() for c in ("id", "z", "spans")), strict=True):
            text = _unpacked(z, tool)
            gone = np.zeros(len(text) + 1, np.int32)
            for span in spans or []:
                gone[span["s"]] += 1
                gone[span["e"]] -= 1
            flags = np.cumsum(gone[:-1]) > 0
            s, e = runs(flags)
            left = np.frombuffer(text, np.uint8)[~flags].tobytes()
            out.append((doc, len(text), int(flags.sum()), len(s), hashlib.sha256(left).hexdigest(), s.tolist(), e.tolist(), left))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends", "kept"]
        k = len(kinds) if with_text else len(kinds) - 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns[:k], kinds, strict=False)], names=names[:k])


def repeated_spans(rows: DataFrame, length: int, gram: int, bucket_suffixes: int = BUCKET_SUFFIXES) -> DataFrame:
    """``doc, th, s, e``: every string of ``length`` bytes that starts earlier, joined to spans."""
    found = rows.mapInArrow(lambda b: _scan(b, length, gram), BLOCK).repartition("m")
    place = F.struct("doc", "th", "start")
    same, bucket = Window.partitionBy("m", "h"), Window.partitionBy("m")
    judged = (
        found.withColumn("later", F.min(place).over(same) < place)
        .withColumn("several", F.min("h").over(bucket) != F.max("h").over(bucket))
        .withColumn("suffixes", F.sum(F.when(F.col("later"), 0).otherwise(F.col("n"))).over(bucket))
    )
    judged = judged.where("range or later or several or again").select(
        "m", "doc", "th", "start", "n", (F.col("range") | F.col("later")).alias("gone"), "range",
        (F.col("suffixes") > bucket_suffixes).alias("large"),
    )
    judged = written(judged, "blocks")
    end = F.col("start") + F.col("n") + F.when(F.col("range"), 0).otherwise(length - 1)
    spans = judged.where("gone").select("doc", "th", F.col("start").alias("s"), end.alias("e"))
    wanted = judged.where("not gone").groupBy("doc", "th").agg(F.collect_set(F.struct("m", "start", "n", "large")).alias("wanted"))
    texts = rows.mapInArrow(_pack, "doc long, th long, z binary")
    bodies = texts.join(wanted, ["doc", "th"]).mapInArrow(
        lambda b: _bodies(b, length), "m long, large boolean, doc long, th long, start long, body binary"
    )
    bodies = written(bodies, "bodies")
    small = bodies.where("not large").drop("large")
    refined = small.repartition("m").sortWithinPartitions("m", "doc", "th", "start").mapInArrow(lambda b: _refined(b, length), SPAN)
    strings = bodies.where("large").mapInArrow(lambda b: _strings(b, length), "c long, doc long, th long, start long")
    first = written(strings.groupBy("c").agg(F.min(place).alias("first")), "strings")
    late = strings.join(first, "c").where(F.col("first") < place).select("doc", "th", F.col("start").alias("s"), (F.col("start") + length).alias("e"))
    return spans.unionByName(refined).unionByName(late)


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False,
    id_col: str = "doc_id", text_col: str = "text", bucket_suffixes: int = BUCKET_SUFFIXES,
) -> DataFrame:
    """One row per document: sizes, digest, removed spans in bytes (and the bytes left).

    A byte goes if it is part of a string of ``length`` bytes that also starts earlier: in
    a document of smaller id, or before in the same. Null text is empty. A null id comes
    after all others; of one id, texts are ordered by hash; rows that repeat both id and
    text are one document, answered per row. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("th"), text.alias("text"),
    )
    spans = repeated_spans(rows.select("doc", "th", "text"), length, gram, bucket_suffixes)
    spans = written(spans.groupBy("doc", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")

    def pack(batches):
        for batch in batches:
            body = next(_pack(iter([batch])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *body.columns], names=["id", "doc", "th", "z"])

    texts = rows.mapInArrow(pack, "id long, doc long, th long, z binary")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>"
    schema += ", kept binary" * with_text
    return texts.join(spans, ["doc", "th"], "left").select("id", "z", "spans").mapInArrow(lambda b: _answers(b, with_text), schema)
