"""N-gram Jaccard join by universe partition and pigeonhole.

Shingles are hashed into the segments of a size band. Two sets that link differ in at
most H shingles, so of segments that a document fills, in one order for all, some
segment among the first H+1 is the same in both: its hash is the signature. Segments
are ordered by the cost that the corpus shows for them; expensive ones come last, and to
make up for them cheap ones also get signatures of all one-deletion neighbours, which
tolerate one difference and so count twice. Signatures shared by documents propose
pairs; a pair links only if its exact sets say so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import (
    SLICE_BYTES,
    gram_hashes,
    mix,
    slices,
    space_words,
    summed,
    text_bytes,
    words,
    written,
)
from stageline.llm.components import components
from stageline.llm.exact_dedup import BITMAP_BITS, filter_cells

SHINGLE, PERCENT = 5, 75
#: segments of the bands of small sets, where nearly each shingle has its own
SMALL_SEGMENTS, SMALL_SET = 8192, 128
#: cells a segment's signatures are counted in, and how many times the median is expensive
CELLS, EXPENSIVE = 4, 4
LAST_ID = (1 << 63) - 1
#: bytes of text that become arrays at a time; the arrays take many times as much
TEXT_BYTES = 1 << 18
#: names of sets that a task remembers, so that copies give no second row
KNOWN_NAMES = 1 << 18
#: pairs whose packed texts are taken out of a batch at a time
PAIRS = 1024
#: rows of one signature that are compared at a time
COMPARE = 512
#: rounds in which a signature with many pairs gives the nearest only, before all others
NEAREST_ROUNDS = 2
#: shingles of sets that a task keeps for the next pairs
KNOWN_SHINGLES = 1 << 21
#: pairs per set of a signature beyond which the nearest come first
MANY = 4
#: sets, and shingles, of a class beyond which it is dealt into blocks to count its links
LINK_SETS, LINK_SHINGLES = 256, 1 << 20
#: shingles that block pairs are multiplied in at a time
COLUMNS = 4096
#: keys of rows to drop that are sent to the tasks, 4 MB; beyond, Spark joins by shuffle
MAX_SENT_KEYS = 1 << 18
#: rows of a signature beyond which they are dealt into blocks, each of about half as many
GROUP_ROWS = 4096
#: sets link only if their sizes lie in the same or in neighbouring powers of this (> 4/3)
SIZE_STEP = 1.34


@dataclass
class Band:
    """Segments of one size band: rank in the common order, and which have neighbours."""

    segments: int
    rank: np.ndarray
    deletions: np.ndarray


def band_segments(band: int) -> int:
    return SMALL_SEGMENTS if (1 << band) < SMALL_SET else 1 << band


def most_errors(n: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Most shingles in which a set of n may differ from any of the band that it links with:
    (n + m) (1 - t) / (1 + t) for the largest such m, which is n / t or the band's largest."""
    m = np.minimum(100 * n // PERCENT, (np.int64(2) << band) - 1)
    return (n + m) * (100 - PERCENT) // (100 + PERCENT)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted within each, and where the rows begin (n+1)."""
    hashes, starts = words(data, offsets, space_words())
    count = np.diff(starts)
    row = np.repeat(np.arange(len(count)), count)
    grams = gram_hashes(hashes, shingle)
    whole = row[: len(grams)] == row[shingle - 1 :][: len(grams)]
    row, found = row[: len(grams)][whole], grams[whole]
    few = np.flatnonzero((count > 0) & (count < shingle))
    if len(few):
        alone = [int(gram_hashes(hashes[starts[r] : starts[r + 1]], int(count[r]))[0]) for r in few]
        row, found = np.append(row, few), np.append(found, np.array(alone, np.uint64))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.append(True, (row[1:] != row[:-1]) | (found[1:] != found[:-1]))[: len(row)]
    row, found = row[new], found[new]
    return found, np.searchsorted(row, np.arange(len(count) + 1))


def set_sums(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(found))))
    return total[starts[1:]] - total[starts[:-1]]


def nodes(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit name per set: equal sets have the same."""
    return mix(set_sums(found, starts) + np.diff(starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sketch(own: np.ndarray) -> bytes:
    """Parity bits of a set: two sets differ in at least as many shingles as bits."""
    bits = max(256, 1 << int(len(own) - 1).bit_length())
    at = np.bincount((own >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits)
    return np.packbits((at & 1).astype(np.uint8), bitorder="little").tobytes()


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.col(id_col).cast("long")
    return docs.select(key.alias("id"), F.coalesce(key, F.lit(LAST_ID)).alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=TEXT_BYTES):
        found, starts = shingle_sets(*text_bytes(batch.column("text")), shingle)
        bits = pa.array([sketch(found[i:j]) for i, j in zip(starts[:-1], starts[1:], strict=True)], pa.binary())
        columns = [*(batch.column(c) for c in ("id", "doc", "th")), pa.array(nodes(found, starts)), pa.array(np.diff(starts)), bits]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "doc", "th", "node", "n", "bits"])


class _Segments:
    """Segments that the sets of a slice fill, for all bands that each set takes part in."""

    def __init__(self, found: np.ndarray, starts: np.ndarray, segments: dict[int, int], ranks: dict[int, np.ndarray] | None):
        n = np.diff(starts)
        own = np.array([max(int(x).bit_length() - 1, 0) for x in n])
        some = np.flatnonzero(n)
        upper = some[PERCENT * (2 << own[some]) <= 100 * n[some]]  # may link into the next band
        self.row = np.concatenate((some, upper))
        self.band = np.concatenate((own[some], own[upper] + 1))
        each = np.repeat(np.arange(len(self.row)), n[self.row])
        at = np.arange(len(each)) - np.repeat(np.cumsum(n[self.row]) - n[self.row], n[self.row]) + starts[self.row][each]
        token = found[at]
        m = np.array([segments[b] for b in self.band], np.uint64)
        segment = ((token >> np.uint64(8)) % m[each]).astype(np.int64) if len(each) else np.zeros(0, np.int64)
        place = segment
        if ranks is not None:
            base = np.cumsum([0] + [len(ranks[b]) for b in sorted(ranks)])
            first = dict(zip(sorted(ranks), base, strict=False))
            joined = np.concatenate([ranks[b] for b in sorted(ranks)])
            place = joined[segment + np.array([first[b] for b in self.band])[each]] if len(each) else segment
        order = np.lexsort((place, each))
        self.token, self.each, self.segment = mix(token[order]), each[order], segment[order]
        new = np.append(True, (self.each[1:] != self.each[:-1]) | (self.segment[1:] != self.segment[:-1]))[: len(order)]
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(order)))
        self.hash = np.add.reduceat(self.token, self.start) if len(self.start) else np.zeros(0, np.uint64)
        self.of = self.each[self.start]  # which entry of row and band the filled segment belongs to


def _costs(batches: Iterator[pa.RecordBatch], shingle: int, segments: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Counts of signatures by band, segment and cell, then the sets that fill too few segments."""
    total: dict[int, np.ndarray] = {}
    for batch in slices(batches, limit=TEXT_BYTES):
        found, starts = shingle_sets(*text_bytes(batch.column("text")), shingle)
        got = _Segments(found, starts, segments, None)
        cell = got.segment[got.start] * CELLS + (mix(got.hash) % np.uint64(CELLS)).astype(np.int64)
        filled = np.bincount(got.of, minlength=len(got.row))
        short = filled < most_errors(np.diff(starts)[got.row], got.band) + 1
        for band in np.unique(got.band).tolist():
            counts = np.bincount(cell[got.band[got.of] == band], minlength=segments[band] * CELLS)
            counts = np.append(counts, (short & (got.band == band)).sum())
            total[band] = total.get(band, 0) + counts
    if total:
        values = pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], names=["row", "values"])


def allocate(counts: np.ndarray, band: int) -> Band:
    """Orders the segments of a band by cost, the pairs that their signatures propose.

    Expensive segments come last. Where the others cannot fill the largest set's need,
    the cheapest get one-deletion neighbours, which count for one segment more.
    """
    m = len(counts) // CELLS
    cost = (counts.reshape(m, CELLS) ** 2).sum(1)
    order = np.argsort(cost, kind="stable")
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    usable = int((cost <= EXPENSIVE * max(np.median(cost), 1)).sum())
    largest = (2 << band) - 1
    filled = 1 - np.exp(-largest / m)
    missing = int(np.ceil((most_errors(np.int64(largest), np.int64(band + 1)) + 1) / filled)) - usable
    deletions = np.zeros(m, bool)
    if m < SMALL_SEGMENTS:  # in bands of small sets a neighbour of one shingle is nothing
        deletions[order[: min(max(missing, 0), usable)]] = True
    return Band(m, rank, deletions)


def _signatures(batches: Iterator[pa.RecordBatch], shingle: int, bands: dict[int, Band]) -> Iterator[pa.RecordBatch]:
    segments = {b: x.segments for b, x in bands.items()}
    ranks = {b: x.rank for b, x in bands.items()}
    done: set[int] = set()
    for batch in slices(batches, limit=TEXT_BYTES):
        found, starts = shingle_sets(*text_bytes(batch.column("text")), shingle)
        names, n = nodes(found, starts), np.diff(starts)
        fresh = []  # a set that the task has seen needs no second row
        for r, name in enumerate(names.tolist()):
            if n[r] and name not in done:
                fresh.append(r)
                done.add(name)
        if len(done) > KNOWN_NAMES:
            done.clear()
        if not fresh:
            continue
        keep = np.zeros(len(n), bool)
        keep[fresh] = True
        found = found[np.repeat(keep, n)]
        names, n = names[keep], n[keep]
        starts = np.concatenate(([0], np.cumsum(n)))
        got = _Segments(found, starts, segments, ranks)
        band, segment = got.band[got.of], got.segment[got.start]
        twice = np.zeros(len(segment), bool)
        for b in np.unique(band).tolist():
            mine = band == b
            twice[mine] = bands[b].deletions[segment[mine]]
        weight = np.where(twice & (got.size > 1), 2, 1)
        before = np.cumsum(weight) - weight
        firsts = np.flatnonzero(np.append(True, got.of[1:] != got.of[:-1]))
        before = before - np.repeat(before[firsts], np.diff(np.append(firsts, len(before))))
        use = before <= most_errors(n[got.row], got.band)[got.of]
        salt = mix(segment.astype(np.uint64) * np.uint64(64) + band.astype(np.uint64) + np.uint64(1))
        sig, owner = [mix(got.hash[use] ^ salt[use])], [got.of[use]]
        near = np.flatnonzero(use & twice & (got.size > 1))
        if len(near):
            each = np.repeat(near, got.size[near])
            at = np.arange(len(each)) - np.repeat(np.cumsum(got.size[near]) - got.size[near], got.size[near]) + got.start[each]
            sig.append(mix((got.hash[each] - got.token[at]) ^ salt[each]))
            owner.append(got.of[each])
        sig, owner = np.concatenate(sig), got.row[np.concatenate(owner)]
        yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(names[owner])], names=["sig", "node"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches, limit=TEXT_BYTES):
        z = pa.array([tool.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("th"), z], names=["doc", "th", "z"])


def _unpack(z: bytes, shingle: int) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), shingle)[0]


def _apart(x: bytes, y: bytes) -> int:
    """Shingles in which two sets differ at least, by their parity bits."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    folded = _fold(np.frombuffer(y, np.uint8)[None, :], len(x))[0]
    return int(np.bitwise_count(np.frombuffer(x, np.uint8) ^ folded).sum(dtype=np.int64))


def _not_ruled_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the proposed pairs, those that parity bits leave open."""
    for batch in _few(batches, PAIRS):
        total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
        most = total * (100 - PERCENT) // (100 + PERCENT)
        sides = zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), most.tolist(), strict=True)
        yield batch.select(["a", "b"]).filter(pa.array([_apart(x, y) <= m for x, y, m in sides], pa.bool_()))


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _linked(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Of the proposed pairs, those whose sets overlap enough."""
    known: dict[int, np.ndarray] = {}
    held = 0
    for batch in _few(batches, PAIRS):
        out = np.zeros(batch.num_rows, bool)
        for i, (a, b, za, zb) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "za", "zb")), strict=True)):
            if held > KNOWN_SHINGLES:
                known.clear()
                held = 0
            for node, z in ((a, za), (b, zb)):
                if node not in known:
                    known[node] = _unpack(z, shingle)
                    held += len(known[node])
            x, y = known[a], known[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            out[i] = 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(out))


def _fold(bits: np.ndarray, to: int) -> np.ndarray:
    while bits.shape[1] > to:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _near_pairs(part: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of one signature that lie in different components and that neither size nor
    parity bits rule out: both places, and the share of shingles that must differ. Of two
    blocks (``side``) only pairs with a row in each."""
    n, comp, side = (part.column(c).to_numpy() for c in ("n", "comp", "side"))
    two = bool(side.any())
    raw = part.column("bits").to_pylist()
    width = np.array([len(x) for x in raw])
    for w in np.unique(width).tolist():  # a set meets those with as many bits, and with more
        left = np.flatnonzero(width == w)
        right = np.flatnonzero(width >= w)
        stack = np.vstack([_fold(np.frombuffer(raw[i], np.uint8)[None, :], w) for i in right])
        mine = np.vstack([np.frombuffer(raw[i], np.uint8) for i in left])
        for at in range(0, len(left), COMPARE):
            a = left[at : at + COMPARE]
            for to in range(0, len(right), COMPARE):
                b = right[to : to + COMPARE]
                small, large = np.minimum(n[a][:, None], n[b]), np.maximum(n[a][:, None], n[b])
                ok = (comp[a][:, None] != comp[b]) & (100 * small >= PERCENT * large) & ((a[:, None] < b) | (width[b] > w))
                if two:
                    ok &= side[a][:, None] != side[b]
                i, j = np.nonzero(ok)
                for lo in range(0, len(i), 1 << 16):
                    p, q = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
                    differ = np.bitwise_count(mine[at + p] ^ stack[to + q]).sum(1, dtype=np.int64)
                    total = n[a[p]] + n[b[q]]
                    near = differ <= total * (100 - PERCENT) // (100 + PERCENT)
                    yield a[p[near]], b[q[near]], differ[near] / total[near]


def _nearest(part: pa.Table) -> list[np.ndarray]:
    """Of the pairs of a signature, the nearest of each component: component, both places, distance."""
    comp = part.column("comp").to_numpy()
    best = [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]  # component, both places, distance
    for a, b, far in _near_pairs(part):
        sides = (np.concatenate((comp[a], comp[b])), np.tile(a, 2), np.tile(b, 2), np.tile(far, 2))
        best = [np.concatenate(x) for x in zip(best, sides, strict=True)]
        order = np.lexsort((best[3], best[0]))
        first = order[np.append(True, np.diff(best[0][order]) != 0)[: len(order)]]
        best = [x[first] for x in best]
    return best


COMPARED = "a long, b long, open long, comp long, far double"


def _compared(batches: Iterator[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs to verify, from rows sorted by signature and pair of blocks: all of them; or, if
    ``nearest`` and a signature has more than MANY pairs per set or is dealt into blocks, the
    nearest of each component (``comp``, ``far``), and the signature itself as ``open``, to be
    compared again when those are joined."""

    def rows(part, a, b, open_=None, comp=None, far=None):
        node = part.column("node").to_numpy()
        x, y = node[a], node[b]
        more = ((open_, pa.int64()), (comp, pa.int64()), (far, pa.float64()))
        more = [pa.nulls(len(x), k) if c is None else pa.array(c, k) for c, k in more]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), *more], names=["a", "b", "open", "comp", "far"])

    def pairs(parts):
        part = pa.Table.from_batches(parts)
        dealt = part.column("x")[0].as_py() != part.column("y")[0].as_py() or part.column("x")[0].as_py() > 0
        held, count = [], 0
        for a, b, _ in _near_pairs(part):
            held.append((a, b))
            count += len(a)
            if nearest and count > (0 if dealt else MANY * len(part)):
                comp, a, b, far = _nearest(part)
                yield rows(part, a, b, np.full(len(a), part.column("sig")[0].as_py()), comp, far)
                return
            if not nearest and count > 100_000:
                yield from (rows(part, *x) for x in held)
                held, count = [], 0
        if count:
            yield rows(part, *(np.concatenate(x) for x in zip(*held, strict=True)))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy(False) for c in ("sig", "x", "y")])
        begin = 0
        last = [held[-1].column(c)[-1].as_py() for c in ("sig", "x", "y")] if held else None
        for cut in np.flatnonzero(np.append(key[:, 0].tolist() != last, (key[:, 1:] != key[:, :-1]).any(0))).tolist():
            parts = [*held, batch.slice(begin, cut - begin)] if cut > begin else held
            if parts:
                yield from pairs(parts)
            held, begin = [], cut
        held.append(batch.slice(begin))
    if held:
        yield from pairs(held)


def _maybe_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among the wanted ones, and few others, without a shuffle of the
    rows. What is broadcast is a bitmap of at most 64 MB (``exact_dedup.MAX_CELLS``); beyond
    about 33 million keys more rows pass, which the join that follows removes."""
    cells = filter_cells(wanted.count())
    cell = f"pmod(xxhash64({key}), {cells}L)"
    set_cells = wanted.select(F.expr(cell).alias("cell"))
    bitmaps = set_cells.groupBy(F.expr(f"cell div {BITMAP_BITS}").alias("bucket")).agg(
        F.expr(f"bitmap_construct_agg(cell % {BITMAP_BITS})").alias("cells")
    )
    byte = f"cast(conv(hex(substring(cells, cast({cell} % {BITMAP_BITS} div 8 as int) + 1, 1)), 16, 10) as bigint)"
    found = rows.join(F.broadcast(written(bitmaps, "wanted")), F.expr(f"{cell} div {BITMAP_BITS}") == F.col("bucket"))
    return found.where(f"getbit({byte}, cast({cell} % 8 as int)) = 1").drop("bucket", "cells")


def _near(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that the sizes and parity bits of their sets do not rule out."""
    a = members.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("xa"))
    b = members.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("xb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_not_ruled_out, "a long, b long")


def _verified(pairs: DataFrame, members: DataFrame, rows: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The pairs whose exact sets link, and the texts (``node, z``) of all sets in a pair; only
    those are read further."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    need = written(members.join(ends, "node").select("node", "doc", "th"), "need")
    texts = _maybe_in(rows.select("doc", "th", "text"), need.select("doc"), "doc")
    bodies = texts.mapInArrow(_bodies, "doc long, th long, z binary").dropDuplicates(["doc", "th"])
    bodies = written(bodies.join(need, ["doc", "th"]).select("node", "z"), "bodies")
    a = bodies.select(F.col("node").alias("a"), F.col("z").alias("za"))
    b = bodies.select(F.col("node").alias("b"), F.col("z").alias("zb"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "za", "zb")
    return written(joined.mapInArrow(lambda x: _linked(x, shingle), "a long, b long"), "edges"), bodies


def _block_links(found: np.ndarray, starts: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the sets ``right`` each of the sets ``left`` links with, and the other way round."""
    n = np.diff(starts)
    names, token = np.unique(found, return_inverse=True)
    each = np.repeat(np.arange(len(n)), n)
    several = np.bincount(token, minlength=len(names)) > 1
    column = np.cumsum(several) - 1
    each, token = each[several[token]], column[token[several[token]]]
    order = np.argsort(token, kind="stable")
    each, token = each[order], token[order]
    both = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, int(several.sum()), COLUMNS):
        i, j = np.searchsorted(token, (low, low + COLUMNS))
        held = np.zeros((len(n), COLUMNS), np.float32)
        held[each[i:j], token[i:j] - low] = 1
        both += (held[left] @ held[right].T).astype(np.int64)
    links = 100 * both >= PERCENT * (n[left][:, None] + n[right] - both)
    links &= left[:, None] != right
    return links.sum(1), links.sum(0)


def _counted(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Links of each set within its pair of blocks, from rows sorted by class and blocks."""
    tool = zstandard.ZstdDecompressor()

    def answer(group, node, side, z):
        texts = [np.frombuffer(tool.decompress(x), np.uint8) for x in z]
        found, n = [], []
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= SLICE_BYTES):
                size += len(texts[to])
                to += 1
            own, starts = shingle_sets(np.concatenate(texts[at:to]), np.cumsum([0, *map(len, texts[at:to])]), shingle)
            found.append(own)
            n.append(np.diff(starts))
            at = to
        starts = np.concatenate(([0], np.cumsum(np.concatenate(n))))
        side = np.array(side)
        if group[1] == group[2]:
            left = right = np.arange(len(node))
            links = _block_links(np.concatenate(found), starts, left, right)[0]
        else:
            left, right = np.flatnonzero(side == group[1]), np.flatnonzero(side == group[2])
            links = np.zeros(len(node), np.int64)
            links[left], links[right] = _block_links(np.concatenate(found), starts, left, right)
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links, pa.int64())], names=["node", "links"])

    last, held = None, ([], [], [])
    for batch in batches:
        for root, low, high, *row in zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high", "node", "block", "z")), strict=True):
            if last is not None and (root, low, high) != last:
                yield answer(last, *held)
                held = ([], [], [])
            last = (root, low, high)
            for column, value in zip(held, row, strict=True):
                column.append(value)
    if last is not None:
        yield answer(last, *held)


def link_counts(joined: DataFrame, members: DataFrame, bodies: list[DataFrame], shingle: int) -> DataFrame:
    """``node, n_links``: with how many other sets each set of a class links.

    All pairs of a class of three sets or more are compared, as copies of blocks of sets
    that meet in a task for each pair of blocks; what leaves a task is a count per set.
    """
    sizes = joined.join(members.select("node", "n"), "node").groupBy("root").agg(F.count("*").alias("sets"), F.sum("n").alias("n"))
    blocks = F.greatest(F.ceil(F.col("sets") / F.lit(LINK_SETS)), F.least(F.col("sets"), F.ceil(F.col("n") / F.lit(LINK_SHINGLES))))
    classes = joined.join(written(sizes.select("root", "sets", blocks.alias("blocks")), "classes"), "root")
    two = classes.where("sets = 2").select("node", F.lit(1).cast("long").alias("links"))
    own = classes.where("sets > 2").select("node", "root", "blocks", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).alias("block"))
    texts = bodies[0]
    for more in bodies[1:]:
        texts = texts.unionByName(more.join(texts.select("node"), "node", "left_anti"))
    dealt = own.join(texts, "node").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "block", "z")
    dealt = dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    counted = dealt.mapInArrow(lambda b: _counted(b, shingle), "node long, links long")
    return written(two.unionByName(counted).groupBy("node").agg(F.sum("links").alias("n_links")), "links")


def _dealt(rest: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of open signatures with their sizes and bits, and the pair of blocks ``x, y``
    that they are to be compared in; ``side`` tells the blocks apart.

    A signature of more than GROUP_ROWS is dealt by size and hash; each pair of its blocks
    whose sizes may link is a group of its own, so that no group grows with the signature.
    """
    own = rest.join(members.select("node", "n", "bits"), "node")
    whole = own.where(F.col("rows") <= GROUP_ROWS).withColumn("x", F.lit(0)).withColumn("y", F.lit(0)).withColumn("side", F.lit(0))
    columns = ["sig", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "side", "node", "n", "comp", "bits"]
    hot = own.where(F.col("rows") > GROUP_ROWS).withColumn("step", F.floor(F.log("n") / F.log(F.lit(SIZE_STEP))))
    steps = hot.groupBy("sig", "step").agg(F.ceil(F.count("*") / F.lit(GROUP_ROWS / 2)).alias("blocks"))
    steps = written(steps, "steps")
    if steps.isEmpty():
        return whole.select(*columns)
    # a block's name: its step and its place there, never 0
    blocks = steps.select("sig", "step", F.explode(F.sequence(F.lit(1).cast("long"), "blocks")).alias("place"))
    blocks = blocks.withColumn("block", F.col("step") * F.lit(1 << 32) + F.col("place"))
    x = blocks.select("sig", F.col("step").alias("x_step"), F.col("block").alias("x"))
    y = blocks.select("sig", F.col("step").alias("y_step"), F.col("block").alias("y"))
    met = written(x.join(y, "sig").where("x <= y and y_step - x_step <= 1").select("sig", "x", "y"), "block-pairs")
    sent = met.select("sig", F.col("x").alias("block"), "x", "y", F.lit(0).alias("side"))
    sent = sent.unionByName(met.where("x < y").select("sig", F.col("y").alias("block"), "x", "y", F.lit(1).alias("side")))
    place = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")) + 1
    hot = hot.join(steps, ["sig", "step"]).withColumn("block", F.col("step") * F.lit(1 << 32) + place)
    return whole.select(*columns).unionByName(hot.join(sent, ["sig", "block"]).select(*columns))


def _open_pairs(shared: DataFrame, joined: DataFrame, members: DataFrame, nearest: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs to verify (``a, b``), of different components and with a signature in common;
    signatures to compare again; then the rows of the signatures compared."""
    own = shared.join(joined, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("comp"))
    own = written(own, "open")
    groups = own.groupBy("sig").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("x"), F.sum(F.xxhash64("node", F.lit(7)).cast("decimal(38,0)")).alias("y"),
    )
    # signatures with the same members are compared once
    open_ = groups.where("low <> high").groupBy("rows", "x", "y").agg(F.min("sig").alias("sig")).select("sig", "rows")
    rest = written(own.join(written(open_, "open-signatures"), "sig"), "open")
    dealt = _dealt(rest, members).repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y", "n", "node")
    found = written(dealt.mapInArrow(lambda b: _compared(b, nearest), COMPARED), "compared")
    again = found.where("open is not null")
    near = again.groupBy("open", "comp").agg(F.min_by(F.struct("a", "b"), F.struct("far", "a", "b")).alias("pair")).select("pair.*")
    pairs = found.where("open is null").select("a", "b").unionByName(near)
    return pairs, again.select(F.col("open").alias("sig")).distinct(), rest.drop("comp", "rows")


def bands_of(rows: DataFrame, top: int, shingle: int) -> dict[int, Band]:
    """The allocation of each size band, from counts over all documents. A band in which
    some set fills too few segments for the pigeonhole gets more of them."""
    segments = {b: band_segments(b) for b in range(top + 2)}
    bands: dict[int, Band] = {}
    todo = segments
    while todo:
        texts = rows.select("text")
        found = summed(texts.mapInArrow(lambda x, s=dict(segments): _costs(x, shingle, s), "row int, values array<double>"))
        got = {r["row"]: np.array(r["values"]) for r in found.collect()}  # a row per size band
        short = {b for b, v in got.items() if v[-1] > 0}
        for b in segments:
            if b not in short:
                bands[b] = allocate(got[b][:-1] if b in got else np.zeros(segments[b] * CELLS), b)
        todo = {b: 4 * segments[b] for b in short}
        segments = segments | todo
    return bands


def jaccard_classes(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", with_links: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links, set_id.

    component_id is the smallest id that links reach; n_links counts all
    other sets that the document's set links with directly (copies share one set); without
    ``with_links`` it is null and costs nothing. Null and empty texts, and texts without words, have no
    shingles and stand alone. A null id stays null and takes the smallest id of its
    class; rows that repeat an id are answered one by one. Other columns are not read.
    """
    classes = _classes(_rows(docs, id_col, text_col), shingle, with_links)
    smallest = written(classes.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    out = classes.where("n > 0").join(smallest, "root").unionByName(classes.where("n = 0").withColumn("component_id", F.col("id")))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        "n_links", F.col("node").alias("set_id"),
    )


def _classes(rows: DataFrame, shingle: int, with_links: bool) -> DataFrame:
    """Per row its id, the hash of its text (``th``), its set and the class of it (``root``)."""
    sets = written(rows.mapInArrow(lambda b: _sets(b, shingle), "id long, doc long, th long, node long, n long, bits binary"), "sets")
    largest = sets.agg(F.max("n")).first()[0] or 0
    bands = bands_of(rows, max(largest, 1).bit_length() - 1, shingle) if largest else {}

    # signatures that more than one set has
    found = rows.select("text").mapInArrow(lambda b: _signatures(b, shingle, bands), "sig long, node long")
    of = Window.partitionBy("sig")
    shared = found.withColumn("hub", F.min("node").over(of)).withColumn("top", F.max("node").over(of)).where("hub <> top")
    shared = shared.withColumn("others", F.max(F.expr("node <> hub and node <> top")).over(of))
    shared = written(shared.select("sig", "node", "hub", "others").distinct(), "shared")

    # those sets, each with its bits and with one document that has it
    some = sets.join(shared.select("node").distinct(), "node", "left_semi").groupBy("node", "n")
    members = some.agg(F.min(F.struct("doc", "th")).alias("at"), F.first("bits").alias("bits"))
    members = written(members.select("node", "n", "at.doc", "at.th", "bits"), "members")

    # first each set against the hub, the least set, of each of its signatures
    first = shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    first = written(_near(first, members), "pairs")
    edges, texts = _verified(first, members, rows, shingle)
    bodies = [texts]
    joined = written(components(edges), "components")

    # then, in signatures that more than two sets have and that still span components, all
    # sets that may yet link; where these are very many, the nearest of each component first
    tried, left = first, shared.where("others").select("sig", "node")
    for i in range(NEAREST_ROUNDS + 1):
        found, again, left = _open_pairs(left, joined, members, i < NEAREST_ROUNDS)
        pairs = written(found.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        more, texts = (None, None) if pairs.isEmpty() else _verified(pairs, members, rows, shingle)
        if more is not None and not more.isEmpty():
            tried = tried.unionByName(pairs)
            bodies.append(texts)
            joined = _extended(joined, more)
        again = written(again, "again")
        if again.isEmpty():
            break
        left = left.join(again, "sig", "left_semi")

    classes = sets.select("id", "th", "node", "n").join(joined, "node", "left")
    if with_links:
        links = link_counts(joined, members, bodies, shingle)
        classes = classes.join(links, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
    else:
        classes = classes.withColumn("n_links", F.lit(None).cast("long"))
    return classes.withColumn("root", F.coalesce("root", "node"))


def _extended(joined: DataFrame, more: DataFrame) -> DataFrame:
    """The components after more edges, which join those that are there: the graph of
    components is all that is gone through again."""
    a, b = (joined.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    ends = more.join(a, "a", "left").join(b, "b", "left")
    top = components(ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    top = written(top, "joins")
    moved = joined.join(top.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
    fresh = top.join(joined.select("node"), "node", "left_anti")
    return written(moved.select("node", F.coalesce("up", "root").alias("root")).unionByName(fresh), "components")


def _sent(keys: DataFrame) -> DataFrame:
    """Stored keys, marked to be sent to all tasks where there are few enough (16 bytes each)."""
    return F.broadcast(keys) if keys.count() <= MAX_SENT_KEYS else keys


def keep_one_of_each_class(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each class, all columns: the one of the smallest id.

    Rows are judged by id and text: rows that repeat an id with other texts are other
    documents, of equal ids in a class that of the smaller text hash stays, and of rows
    that repeat both one stays. A null id comes after all others. Rows without shingles
    (null, empty, no words) are in no class and stay, all of them. An empty table gives
    no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    classes = _classes(_rows(docs, "doc_id", "text"), shingle, with_links=False).where("n > 0")
    classes = written(classes.groupBy("root", "id", "th").agg(F.count(F.lit(1)).alias("rows")), "class-rows")
    key = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    first = written(classes.groupBy("root").agg(F.min(key).alias("first")), "firsts")
    judged = classes.join(first, "root").withColumn("stays", key == F.col("first"))
    mine, hash_ = F.col("doc_id").cast("long"), F.xxhash64(text)
    same = mine.eqNullSafe(F.col("__id")) & (hash_ == F.col("__th"))
    named = [F.col("id").alias("__id"), F.col("th").alias("__th")]
    gone = written(judged.where("not stays").select(*named), "gone")
    again = written(judged.where("stays and rows > 1").select(*named), "repeated")
    left = docs.join(_sent(gone), same, "left_anti")
    if again.isEmpty():
        return left
    again = _sent(again)
    one = left.join(again, same, "left_semi").select("*", mine.alias("__id"), hash_.alias("__th"))
    one = one.dropDuplicates(["__id", "__th"]).drop("__id", "__th")
    return left.join(again, same, "left_anti").unionByName(one)
