"""Conversation prefix trie on node tables with minimal perfect hashes.

Every prefix of a conversation has a digest. Tasks take shards of conversations,
enumerate the distinct prefix digests of a shard, and give each a slot by a minimal
perfect hash, verified against the digest that the slot holds. Counts are scattered into
flat arrays by slot; sums over subtrees run through an array of parent slots, deepest
nodes first. All of it adds up, so that a node may stand in many shards: Spark sums the
parts by digest. No shard holds more than a bounded number of turns, whatever first turn,
text or conversation is common.

A conversation is cut into pieces of ``PIECE`` turns, and a long one is dealt out by
piece: the digest of a place is made of the digest before its piece and the chain of the
turns in its piece, and what later pieces of a conversation sum up to is added at the end
of the piece before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import mix, written

#: turns in a piece of a conversation, and turns that a shard holds before it is closed
PIECE, SHARD_TURNS = 1024, 50_000
#: conversations share the first turns of the first one of their hundred, fewer than this
FAMILY, MOST_SHARED = 100, 6
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
#: levels of a perfect hash before it gives up; each leaves less than half of the keys
LEVELS, ROOM = 64, 2

PLACES = "conv long, pos long, digest binary, parent binary, points long"
PARTS = "digest binary, parent binary, depth long, conv long, n long, points long"
SUMS = "digest binary, saved long, leaves long"


class NodeTable:
    """A minimal perfect hash of distinct 16-byte digests: each key has a slot below their number.

    A level gives each key left a cell; keys alone in their cell stay there, the others
    go to the next level. The slot is the rank of the cell among all that are taken. The
    table keeps the digests by slot: a key that is not the one in its slot is found out.
    """

    def __init__(self, keys: np.ndarray):
        """``keys``: distinct, one row of two 64-bit words each."""
        self.levels: list[tuple[int, np.ndarray]] = []
        left, first = keys, 0
        while len(left):
            if len(self.levels) == LEVELS:
                raise ValueError("keys that do not part: they repeat")
            cells = self._cells(left, len(self.levels), size := ROOM * len(left))
            alone = np.bincount(cells, minlength=size) == 1
            ranks = np.where(alone, np.cumsum(alone) - 1 + first, -1)
            self.levels.append((size, ranks))
            first += int(alone.sum())
            left = left[~alone[cells]]
        self.keys = np.zeros_like(keys)
        self.keys[self._place(keys)] = keys

    @staticmethod
    def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys[:, 0] ^ mix(keys[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        for level, (size, ranks) in enumerate(self.levels):
            open_ = np.flatnonzero(slots < 0)
            if not len(open_):
                break
            slots[open_] = ranks[self._cells(keys[open_], level, size)]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The verified slots of keys that are in the table; -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        slots = self._place(keys)
        return np.where((slots >= 0) & (self.keys[slots] == keys).all(axis=1), slots, -1)


def _keys(column: pa.Array) -> np.ndarray:
    """16-byte values as two 64-bit words a row."""
    fixed = column.cast(pa.binary(16))
    data = np.frombuffer(fixed.buffers()[1], np.uint64)
    return data.reshape(-1, 2)[fixed.offset : fixed.offset + len(fixed)]


def _binary(keys: np.ndarray) -> pa.Array:
    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys))])
    return flat.cast(pa.binary())


def _distinct(keys: np.ndarray) -> np.ndarray:
    return np.unique(np.ascontiguousarray(keys).view("V16").reshape(-1)).view(np.uint64).reshape(-1, 2)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _shards(batches: Iterator[pa.RecordBatch], piece: int, most: int) -> Iterator[pa.Table]:
    """Sorted rows in shards of whole pieces: at most ``most`` rows and one more piece."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, part = batch.column("conv").to_numpy(), batch.column("pos").to_numpy() // piece
        begins = np.flatnonzero((conv[1:] != conv[:-1]) | (part[1:] != part[:-1])) + 1
        if last != (conv[0], part[0]):
            begins = np.append(0, begins)
        at = 0
        for edge in begins.tolist():
            if size + edge - at >= most and (size or edge):
                if edge > at:
                    held.append(batch.slice(at, edge - at))
                yield pa.Table.from_batches(held)
                held, size, at = [], 0, edge
        held.append(batch.slice(at))
        size, last = size + batch.num_rows - at, (conv[-1], part[-1])
    if held:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------ turns and places


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos, key, points``: each turn's place in its conversation, stored.

    The turns are sorted into ranges, so that one conversation may span many tasks; its
    turns in earlier ranges are counted per range.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.unhex(F.substring(F.sha2(framed.cast("binary"), 256), 1, 32)).alias("key"),
        F.length(text).cast("long").alias("points"),
    )
    # equal turns may be told apart in any way
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("__copy")]
    rows = rows.withColumn("__copy", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(rows.select("conv", "key", "points", F.spark_partition_id().alias("part"), place.alias("place")), "turns")
    parts = rows.groupBy("part", "conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = written(parts.select("part", "conv", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), "turn-parts")
    placed = rows.join(parts, ["part", "conv"])
    return written(placed.select("conv", (F.col("place") + F.col("shift")).alias("pos"), "key", "points"), "ordered-turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of all rebuilt conversations, and the conversations with their lengths."""
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED
    own = written(own.select("conv", "n", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), shared.alias("h")), "convs")
    bases = own.where("conv = base").select("base", F.least("n", F.lit(MOST_SHARED)).alias("there"))
    convs = own.join(bases, "base", "left")
    head = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.select("conv", "base", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"))
    convs = written(convs, "convs")
    rest = turns.join(convs.select("conv", "h", "head"), "conv").where("pos >= h")
    rest = rest.select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "key", "points")
    # a first conversation has few rows here, and at most two hundred that share them
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv", "base")
    heads = heads.join(convs.select("conv", "base", "h"), "base").where("pos < h").select("conv", "pos", "key", "points")
    return written(rest.unionByName(heads), "rebuilt"), convs


def _chains(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[tuple[pa.RecordBatch, list, list, list]]:
    """Per batch of sorted rows: the chain digest in the piece, the digest, the parent."""
    now, chain, above, before = None, b"", ROOT, ROOT
    for batch in batches:
        links, digests, parents = [], [], []
        rows = (batch.column(c).to_pylist() for c in ("conv", "pos", "key", "above"))
        for conv, pos, key, start in zip(*rows, strict=True):
            if now != (conv, pos // piece):
                now, chain = (conv, pos // piece), b""
                above = before = ROOT if start is None else start
            chain = hashlib.blake2b(chain + key, digest_size=16).digest()
            parents.append(before)
            before = hashlib.blake2b(above + chain, digest_size=16).digest()
            links.append(chain)
            digests.append(before)
        yield batch, links, digests, parents


def _dealt(rows: DataFrame, piece: int) -> DataFrame:
    """Whole pieces to a task, sorted; conversations that may share turns side by side."""
    part = F.expr(f"pos div {piece}")
    return rows.repartition(F.expr(f"conv div {FAMILY}"), part).sortWithinPartitions("conv", "pos")


def _starts(rows: DataFrame, long: DataFrame, piece: int) -> DataFrame:
    """``conv, piece, above`` for the later pieces of long conversations: 16 bytes a piece
    of one conversation meet in a task."""

    def ends(batches):
        for batch, links, _, _ in _chains(batches, piece):
            last = pa.array(batch.column("pos").to_numpy() % piece == piece - 1)
            part = pa.array(batch.column("pos").to_numpy() // piece)
            columns = [batch.column("conv"), part, pa.array(links, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv", "piece", "chain"]).filter(last)

    def chained(table):
        table = table.sort_by("piece")
        above, out = ROOT, []
        for chain in table.column("chain").to_pylist():
            above = hashlib.blake2b(above + chain, digest_size=16).digest()
            out.append(above)
        part = pa.array(np.array(table.column("piece").to_pylist(), np.int64) + 1)
        return pa.Table.from_arrays([table.column("conv"), part, pa.array(out, pa.binary())], names=["conv", "piece", "above"])

    some = rows.join(long, "conv", "left_semi").withColumn("above", F.lit(None).cast("binary"))
    found = _dealt(some, piece).mapInArrow(ends, "conv long, piece long, chain binary")
    return written(found.groupBy("conv").applyInArrow(chained, "conv long, piece long, above binary"), "pieces")


def prefix_digests(rows: DataFrame, convs: DataFrame, piece: int) -> DataFrame:
    """The digest of each place's prefix, and that of its parent; stored."""
    long = convs.where(F.col("total") > piece).select("conv")
    if long.isEmpty():
        rows = rows.withColumn("above", F.lit(None).cast("binary"))
    else:
        starts = _starts(rows, long, piece)
        rows = rows.withColumn("piece", F.expr(f"pos div {piece}")).join(starts, ["conv", "piece"], "left").drop("piece")

    def digests(batches):
        for batch, _, own, parent in _chains(batches, piece):
            columns = [batch.column("conv"), batch.column("pos"), pa.array(own, pa.binary()), pa.array(parent, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("points")], names=[c.split()[0] for c in PLACES.split(", ")])

    return written(_dealt(rows, piece).mapInArrow(digests, PLACES), "prefixes")


# ------------------------------------------------------------------ node tables


def _node_parts(batches: Iterator[pa.RecordBatch], piece: int, most: int) -> Iterator[pa.RecordBatch]:
    """A row per node of a shard: its conversations there, and the least of them."""
    for shard in _shards(batches, piece, most):
        keys = _keys(shard.column("digest").combine_chunks())
        table = NodeTable(_distinct(keys))
        slot, n = table.slots(keys), len(table.keys)
        conv = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(conv, slot, _numbers(shard, "conv"))
        first = np.zeros(n, np.int64)
        first[slot] = np.arange(len(slot))  # all rows of a node agree in what is taken from this one
        parent = _keys(shard.column("parent").combine_chunks())[first]
        columns = [
            _binary(table.keys), _binary(parent), pa.array(_numbers(shard, "pos")[first] + 1), pa.array(conv),
            pa.array(np.bincount(slot, minlength=n)), pa.array(_numbers(shard, "points")[first]),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PARTS.split(", ")])


def nodes(places: DataFrame, convs: DataFrame, piece: int, most: int) -> DataFrame:
    """``digest, parent, depth, conv_id, n_convs, points`` of all nodes, the root too; stored."""
    parts = places.mapInArrow(lambda b: _node_parts(b, piece, most), PARTS)
    found = parts.groupBy("digest").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv").alias("conv_id"),
        F.sum("n").alias("n_convs"), F.min("points").alias("points"),
    )
    root = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        F.lit(bytearray(ROOT)).alias("digest"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("points"),
    )
    return written(found.unionByName(root), "nodes")


def _subtree_parts(batches: Iterator[pa.RecordBatch], piece: int, most: int) -> Iterator[pa.RecordBatch]:
    """A row per node of a shard: the sums over the part of its subtree that is there."""
    for shard in _shards(batches, piece, most):
        keys, above = (_keys(shard.column(c).combine_chunks()) for c in ("digest", "parent"))
        pos = _numbers(shard, "pos")
        # the first place of a later piece hangs on a node that another shard sums up
        inside = (pos == 0) | (pos % piece != 0)
        table = NodeTable(_distinct(np.concatenate((keys, above[inside]))))
        slot, n = table.slots(keys), len(table.keys)
        parent, depth = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        parent[slot[inside]], depth[slot] = table.slots(above[inside]), pos + 1
        sums = np.zeros((2, n), np.int64)
        for row, column in enumerate(("saved", "leaves")):
            np.add.at(sums[row], slot, _numbers(shard, column))
        order = np.argsort(-depth, kind="stable")
        edges = np.append(np.flatnonzero(np.diff(depth[order], prepend=-1)), n)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            level = order[a:b]
            level = level[parent[level] >= 0]
            for row in sums:
                np.add.at(row, parent[level], row[level])
        columns = [_binary(table.keys), pa.array(sums[0]), pa.array(sums[1])]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SUMS.split(", ")])


def subtree_sums(places: DataFrame, table: DataFrame, convs: DataFrame, piece: int, most: int) -> DataFrame:
    """``digest, saved, leaves``: sums over all subtrees.

    What a node adds stands at one place only: in the least of its conversations, which
    has one node of each depth.
    """
    parents = table.select(F.col("parent").alias("digest")).distinct().withColumn("inner", F.lit(True))
    own = table.where("depth > 0").join(parents, "digest", "left").select(
        F.col("conv_id").alias("conv"), (F.col("depth") - 1).alias("pos"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved"), F.col("inner").isNull().cast("long").alias("leaves"),
    )
    own = written(own, "node-values")
    none = F.lit(0).cast("long")
    rows = places.drop("points").join(own, ["conv", "pos"], "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), none) for c in ("saved", "leaves")})
    if not (long := convs.where(F.col("total") > piece).select("conv")).isEmpty():
        # what later pieces hold is added at the last place of the piece before them
        part = F.expr(f"pos div {piece}").alias("piece")
        each = own.join(long, "conv", "left_semi").groupBy("conv", part)
        each = each.agg(F.sum("saved").alias("more"), F.sum("leaves").alias("ends"))
        every = places.join(long, "conv", "left_semi").where(f"pos % {piece} = 0").select("conv", part)
        later = Window.partitionBy("conv").orderBy("piece").rowsBetween(1, Window.unboundedFollowing)
        tails = every.join(each, ["conv", "piece"], "left").select(
            "conv", (F.col("piece") * piece + piece - 1).alias("pos"),
            *[F.coalesce(F.sum(c).over(later), none).alias(c) for c in ("more", "ends")],
        )
        rows = rows.join(written(tails, "piece-tails"), ["conv", "pos"], "left")
        rows = rows.withColumn("saved", F.col("saved") + F.coalesce("more", none))
        rows = rows.withColumn("leaves", F.col("leaves") + F.coalesce("ends", none)).drop("more", "ends")
    parts = _dealt(rows, piece).mapInArrow(lambda b: _subtree_parts(b, piece, most), SUMS)
    return written(parts.groupBy("digest").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")), "subtrees")


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv): the SHA-256 of each node's ids, one at a time."""
    now = state = None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if digest != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = digest, hashlib.sha256(str(conv).encode())
            else:
                state.update(b",%d" % conv)
        columns = [pa.array([d for d, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["digest", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_pydict({"digest": pa.array([now], pa.binary()), "ends_sha256": [state.hexdigest()]})


def ends(places: DataFrame, convs: DataFrame) -> DataFrame:
    """``digest, ends_sha256`` of the nodes at which conversations end.

    A hash is one run over its ids in order, so that the ids of one node are one task,
    which sorts them with spilling and holds one at a time.
    """
    last = convs.where("total > 0").select("conv", (F.col("total") - 1).alias("pos"))
    here = places.select("conv", "pos", "digest").join(last, ["conv", "pos"]).select("digest", "conv")
    bare = convs.where("total = 0").select(F.lit(bytearray(ROOT)).alias("digest"), "conv")
    rows = here.unionByName(bare).repartition("digest").sortWithinPartitions("digest", "conv")
    return written(rows.mapInArrow(_end_hashes, "digest binary, ends_sha256 string"), "ends")


def prefix_trie(conversations: DataFrame, piece: int = PIECE, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversations are rebuilt first: the first h turns of the first conversation of their
    hundred, then their own after their first h. A null role or text is the empty text; a
    null turn comes first; turns of one number are in the order of a digest of role and
    text, and repeated rows are turns of their own. Rows without a conversation id belong
    to none and are left out. A negative id counts towards the hundred nearer to zero. A
    conversation without turns is a member of the root. Roles and texts are compared by
    128-bit digests. Very long texts and very long conversations are no special case. Other
    columns are not read. An empty table gives no rows, not even a root.
    """
    turns = ordered_turns(conversations.select("conv_id", "turn", "role", "text"))
    rows, convs = rebuilt(turns)
    places = prefix_digests(rows, convs, piece)
    table = nodes(places, convs, piece, shard_turns)
    sums = subtree_sums(places, table, convs, piece, shard_turns)
    children = table.groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    children = written(children.where("digest is not null"), "children")
    parents = table.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    leaf = F.col("n_children").isNull()
    # the root has no place, so that its own leaf is not among the sums
    n_leaves = F.when(leaf & (F.col("depth") == 0), F.lit(1).cast("long")).otherwise(F.col("leaves"))
    out = table.join(sums, "digest", "left").join(children, "digest", "left")
    out = out.join(ends(places, convs), "digest", "left").join(parents, "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        n_leaves.alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
