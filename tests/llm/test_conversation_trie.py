"""The trie against one that is built in memory."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import clashing

from stageline.llm.conversation_trie import NodeTable, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv in own:
        own[conv].sort(key=lambda t: t[:2])
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        first = own.get(conv - int(math.fmod(conv, 100)), [])
        out[conv] = [t[2:] for t in first[:h]] + [t[2:] for t in turns[h:]]
    return out


def brute(rows):
    full = rebuild(rows)
    members, children, saved, leaves = defaultdict(list), defaultdict(list), {}, {}
    for conv, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), above, len(convs), len(children[node]), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select(*OUT).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    openings = [[("user", f"open {i} é"), ("assistant", "ok")] for i in range(3)]
    out = []
    for conv in [*range(0, 12), *range(95, 130), *range(250, 262), 400, 401, -1, -100, -150, 10**15 + 7]:
        turns = list(rng.choice(openings)) * rng.randrange(2) + [
            (rng.choice(["user", "assistant"]), rng.choice(["a", "b", "long text"])) for _ in range(rng.randrange(0, 7))
        ]
        turns = turns or [("system", "")]
        out += [(conv, 10 * t, role, text) for t, (role, text) in enumerate(turns)]
    out += [(7, 1, None, "no role"), (7, 2, "user", None), (8, None, "user", "no number"), (None, 0, "user", "no id")]
    out += [(450, t, "user", f"t{t % 3}") for t in range(40)] + [(451, t, "user", f"t{t % 3}") for t in range(37)]
    out += [(500, 0, "user", "same")] * 9  # repeated rows are turns of their own
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bounds", [{}, {"piece": 4, "shard_turns": 10}, {"piece": 1, "shard_turns": 1}])
def test_against_a_trie_in_memory(spark, rows, bounds):
    """Also with conversations cut into many pieces, and many shards."""
    got = prefix_trie(clashing(spark.createDataFrame(rows, SCHEMA).repartition(3)), **bounds)
    assert got.columns == OUT
    assert found(got) == brute(rows)


def test_many_copies_and_one_first_turn(spark):
    copies = [(100 * c, t, "user", f"t{t}") for c in range(60) for t in range(3)]
    rows = copies + [(100 * c, t, "user", f"{c * t}") for c in range(60, 120) for t in range(3)]
    want = brute(rows)
    assert found(prefix_trie(spark.createDataFrame(rows, SCHEMA), shard_turns=20)) == want
    assert max(r[3] for r in want if r[1] == 1) == 60


def test_turnless_and_empty(spark):
    # no first conversation of the hundred, and fewer turns than are left out
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(conv, 0, "user", "gone")]
    want = brute(rows)
    assert [w[1:6] for w in want] == [(0, None, 1, 0, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie(frame)) == want
    assert found(prefix_trie(frame.limit(0))) == []
    assert found(prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA))) == []


def test_turns_of_one_number_have_one_order(spark):
    rows = [(3, 0, "user", "x"), (3, 0, "user", "y"), (300, 0, "user", "y"), (300, 0, "user", "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(prefix_trie(frame)) == found(prefix_trie(frame.orderBy("text")))


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_slots_are_minimal_perfect_and_verified(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
    keys[: n // 2, 0] = 7  # halves that are equal do not matter
    table = NodeTable(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(n))
    assert (table.keys[table.slots(keys)] == keys).all()
    strangers = rng.integers(0, 1 << 63, (100, 2)).astype(np.uint64)
    assert (table.slots(strangers) == -1).all()


def test_keys_that_repeat_are_refused():
    with pytest.raises(ValueError, match="repeat"):
        NodeTable(np.ones((2, 2), np.uint64))
