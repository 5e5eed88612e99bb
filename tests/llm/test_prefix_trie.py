"""The trie of conversation prefixes against a plain one built from dictionaries, for small and large shards."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from awkward import shipped  # noqa: F401

from deskmart.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def _code(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, _code(role, text), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            children[node],
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def _rows(seed, convs=300, hot=0.0):
    """Conversations that share beginnings, are copies, have one turn only, many turns, odd turns."""
    rng = random.Random(seed)
    texts = ["", None, "a", "ab", "né", "\U0001f600x", "long " * 50]
    roles = ["user", "assistant", None, ""]
    chains, rows = [[]], []
    for _ in range(40):
        chains.append([*rng.choice(chains), (rng.choice(roles), rng.choice(texts))])
    deep = [("user", f"t{i}") for i in range(90)]
    for i in range(convs):
        c = rng.choice([i, 100 * (i % 7), 100 * (i % 5) + i % 60, 2**53 + i])
        chain = rng.choice(chains) if rng.random() > hot else deep
        for turn, (role, text) in enumerate(chain):
            rows.append((c, rng.choice([turn, turn, turn // 2]), role, text))
    return [*rows, rows[0], (None, 0, "user", "lost"), (7, None, "user", "first"), (999_950, 0, "user", "family without a head")]


def _made(spark, rows, shards, **options):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' as seq", "1 as part", "'y' as key", "'z' as ends").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        return sorted((tuple(r) for r in prefix_trie.conversation_trie(df, **options).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize(("seed", "hot", "shards"), [(1, 0.0, 1), (2, 0.4, 7), (3, 0.9, 40)])
def test_trie(spark, seed, hot, shards):
    rows = _rows(seed, hot=hot)
    assert _made(spark, rows, shards) == sorted(_brute(rows), key=repr)


def test_many_shards_from_the_number_of_turns(spark):
    rows = _rows(4, convs=120, hot=0.3)
    assert _made(spark, rows, 2, shard_turns=60) == sorted(_brute(rows), key=repr)


def test_small_tables(spark):
    assert _made(spark, [], 3) == []
    assert _made(spark, [(None, 1, "user", "x")], 3) == []
    # Conversation 201 shares 5 turns of a family head that does not exist and has one turn itself: none is left.
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6)
    assert _made(spark, [(c, 0, "user", "x")], 3) == _brute([(c, 0, "user", "x")])
    assert len(_brute([(c, 0, "user", "x")])) == 1


def test_searches_of_the_sparse_table():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 4, 200)
    shared[0] = -1
    table = prefix_trie.SparseTable(shared)
    at, depth = np.arange(200), rng.integers(0, 5, 200)
    up, down = table.reach(at, depth, 1), table.reach(at, depth, -1)
    for i in range(200):
        high = i
        while high + 1 < 200 and shared[high + 1] >= depth[i]:
            high += 1
        low = i
        while low > 0 and shared[low] >= depth[i]:
            low -= 1
        assert (low, high) == (down[i], up[i])
    assert [int(x) for x in table.minima(down, up)] == [shared[a : b + 1].min() for a, b in zip(down, up)]


def test_sequences_of_one_shard_share_turns():
    a, b = bytes(range(60)), bytes(range(45)) + bytes(15)
    assert prefix_trie.common_units(a, b) == 2
    assert prefix_trie.common_units(a, a[:40]) == 2
    assert prefix_trie.common_units(a, b"") == 0
