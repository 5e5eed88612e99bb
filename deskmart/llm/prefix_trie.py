"""Trie of conversation prefixes from sorted sequences and range minima over their common prefixes.

A conversation is the sequence of its turns, each kept as a digest of role and text followed by the length of the text. Once the
sequences are sorted, the members of a prefix stand side by side, and neighbours of one member share the
prefix exactly where the minimum of the common prefix lengths between them reaches its depth. So each prefix finds its
first and last member by two binary searches over a sparse table of these minima, independently of all others; counts and sums over its
subtree are differences of running sums.

Spark sorts the sequences by range into shards, ties by conv_id, so that a third of all conversations with one first turn, or with all turns alike, is cut
like any other stretch. What a shard says of a prefix adds up: every distinct prefix is counted by the shard in which it begins, and only
prefixes that reach over a border between shards are merged afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from deskmart.llm.common import ship, small, stage

UNIT = 20  # bytes a turn: 16 of a digest, 4 of the length
SHARED_TURNS = 6  # hash values, hence shared turns of 0 to 5
FAMILY = 100
SHARD_TURNS = 1_000_000
BORDER_NODES = 400_000  # broadcast at most

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
SHARD_NODE = f"{NODE}, key binary, parent_key binary, part int, ends string"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_code(role: Column, text: Column) -> Column:
    """40 hex digits that tell a turn: 32 of a digest of role and text, 8 of the length of the text in code points."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.char_length(text)), 8, "0"))


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, seq`` of ``turns(conv_id, turn, role, text)``: the codes of a conversation's turns, one after the other.

    Turns follow ``turn``, NULL first, equal ones the code of the turn. Rows without a conv_id belong to no conversation.
    """
    codes = turns.filter(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"),
        F.struct(
            turns["turn"].isNotNull().alias("told"), F.coalesce(turns["turn"], F.lit(0)).alias("turn"), turn_code(turns["role"], turns["text"]).alias("code")
        ).alias("t"),
    )
    ordered = F.array_sort(F.collect_list("t"))
    return codes.groupBy("conv_id").agg(F.unhex(F.array_join(F.transform(ordered, lambda t: t["code"]), "")).alias("seq"))


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Give each conversation c the first h turns of c - c % 100 in place of its own first h; h is crc32(c) % 6."""
    n = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS * UNIT
    heads = sequences.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("head_id"), F.substring("seq", 1, (SHARED_TURNS - 1) * UNIT).alias("head")
    )
    own = sequences.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % FAMILY)
    joined = own.join(heads, "head_id", "left").withColumn("n", n.cast("int"))
    return joined.select("conv_id", F.expr("concat(coalesce(substring(head, 1, n), X''), substring(seq, n + 1))").alias("seq"))


def common_units(a: bytes, b: bytes) -> int:
    """Number of turns that two sequences share at their beginnings."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return int(differ[0] if len(differ) else n) // UNIT


@F.pandas_udf(T.IntegerType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Turns shared by two sequences; -1 where there is only one."""
    return pd.Series([-1 if x is None or y is None else common_units(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


class SparseTable:
    """Minima over all stretches of lengths 1, 2, 4, ... of ``values``."""

    def __init__(self, values: np.ndarray):
        self.rows, size = [values], 1
        while 2 * size <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[: len(last) - size], last[size:]))
            size *= 2

    def minima(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of ``values[first : last + 1]`` for each pair."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        found = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(self.rows[k][first[at]], self.rows[k][last[at] - (1 << int(k)) + 1])
        return found

    def reach(self, start: np.ndarray, depth: np.ndarray, step: int) -> np.ndarray:
        """Farthest place from each ``start``, upwards or downwards, with all of ``values`` on the way at ``depth`` or more.

        ``values[i]`` stands between the places i - 1 and i. Each search halves its step on its own.
        """
        at, n = start.copy(), len(self.rows[0])
        for k in reversed(range(len(self.rows))):
            size, row = 1 << k, self.rows[k]
            if step > 0:
                fits, first = at + size < n, at + 1
            else:
                fits, first = at >= size, at - size + 1
            fits &= row[np.where(fits, first, 0)] >= depth
            at[fits] += step * size
        return at


def _neighbours(units: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Turns that each sequence shares with the one before it; the first shares -1."""
    shared = np.full(len(length), -1, np.int64)
    if len(length) < 2:
        return shared
    width = np.minimum(length[:-1], length[1:])
    begin = np.concatenate([[0], np.cumsum(width)])
    inside = np.arange(begin[-1]) - np.repeat(begin[:-1], width)
    left, right = np.repeat(offset[:-2], width) + inside, np.repeat(offset[1:-1], width) + inside
    differs = (units[left] != units[right]).any(axis=1)
    # The first difference of each pair: differences in order, looked up by where the pair begins.
    places = np.append(np.flatnonzero(differs), begin[-1])
    first = places[np.searchsorted(places, begin[:-1])]
    shared[1:] = np.minimum(first - begin[:-1], width)
    return shared


def _prefix_keys(seq: bytes, depth: int) -> list[bytes]:
    """Digests of the first 0, 1, ... ``depth`` turns."""
    running, keys = hashlib.sha256(), []
    for d in range(depth + 1):
        keys.append(running.copy().digest()[:16])
        running.update(seq[d * UNIT : (d + 1) * UNIT])
    return keys


def shard_nodes(ids: np.ndarray, seqs: list[bytes], part: int, before: int, after: int) -> pa.Table:
    """Prefixes of one shard of sequences in order, with what this shard adds to each.

    ``before`` and ``after`` are the turns that its first and last sequence share with their neighbours in other shards, -1 without one.
    A prefix that such a neighbour has too gets a ``key`` and no ``ends_sha256``; its numbers are this shard's part.
    """
    n = len(ids)
    length = np.array([len(s) // UNIT for s in seqs], np.int64)
    offset = np.concatenate([[0], np.cumsum(length)])
    raw = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, UNIT)
    shared = _neighbours(raw.view(np.uint32).reshape(-1, UNIT // 4), offset, length)
    points = np.concatenate([[0], np.cumsum(np.ascontiguousarray(raw[:, 16:]).view(">u4").ravel().astype(np.int64))])
    total = points[offset[1:]] - points[offset[:-1]]

    # Candidates: the prefixes that a sequence does not share with the one before it in this shard.
    count = length - shared
    base = np.cumsum(count) - count
    at = np.repeat(np.arange(n), count)
    depth = np.arange(len(at)) - np.repeat(base - shared - 1, count)
    minima = SparseTable(shared)
    last = minima.reach(at, depth, 1)
    # The prefix one turn shorter is the candidate at its own first member.
    above = minima.reach(at, depth - 1, -1)
    parent = np.where(depth > 0, base[above] + depth - 1 - (shared[above] + 1), -1)

    begins = ~((at == 0) & (depth <= before))  # else it began in an earlier shard
    spans = ~begins | ((last == n - 1) & (depth <= after))
    children = np.bincount(parent[(depth > 0) & begins], minlength=len(at))
    ends_leaf = np.append(shared[1:], after) < length
    leaves = np.concatenate([[0], np.cumsum(ends_leaf)])
    n_convs = last - at + 1
    # Texts of all members below the parent, less each distinct text once, where it begins.
    known = shared.copy()
    known[0] = before
    words = np.concatenate([[0], np.cumsum(total)])
    new = total - (points[offset[:-1] + np.maximum(shared, 0)] - points[offset[:-1]])
    fresh = np.concatenate([[0], np.cumsum(new)])
    up = np.maximum(depth - 1, 0)
    told = points[offset[at] + up] - points[offset[at]]
    first_new = total[at] - (points[offset[at] + np.maximum(up, known[at])] - points[offset[at]])
    saved = words[last + 1] - words[at] - n_convs * told - (fresh[last + 1] - fresh[at + 1] + first_new)

    keys: list[bytes | None] = [None] * len(at)
    head, tail = _prefix_keys(seqs[0], max(before, 0)), _prefix_keys(seqs[-1], max(after, 0))
    for i in np.flatnonzero(spans):
        keys[i] = tail[depth[i]] if begins[i] else head[depth[i]]
    digest: list[str | None] = [None if s else _NO_ENDS for s in spans]
    ends: list[str | None] = [None] * len(at)
    same = (shared == length) & (np.append(-1, length[:-1]) == length)
    starts = np.append(np.flatnonzero(~same), n)
    for first, beyond in zip(starts[:-1], starts[1:], strict=True):
        node, listed = base[first] + length[first] - shared[first] - 1, ",".join(map(str, ids[first:beyond].tolist()))
        if spans[node]:
            ends[node] = listed
        else:
            digest[node] = hashlib.sha256(listed.encode()).hexdigest()

    smallest = SparseTable(ids).minima(at, last)
    outer = np.where(parent >= 0, spans[parent], True)
    return pa.table(
        {
            "conv_id": smallest,
            "depth": depth,
            "parent_conv_id": pa.array(smallest[parent], pa.int64(), mask=outer),
            "n_convs": n_convs,
            "n_children": children.astype(np.int64),
            "n_leaves": leaves[last + 1] - leaves[at],
            "saved_tokens": saved,
            "ends_sha256": pa.array(digest, pa.string()),
            "key": pa.array(keys, pa.binary()),
            "parent_key": pa.array([keys[p] if p >= 0 else None for p in parent], pa.binary()),
            "part": pa.array(np.full(len(at), part), pa.int32()),
            "ends": pa.array(ends, pa.string()),
        }
    )


def _shard(table: pa.Table) -> pa.Table:
    ids, seqs = table["conv_id"].to_numpy(), table["seq"].to_pylist()
    order = sorted(range(len(seqs)), key=lambda i: (seqs[i], ids[i]))
    part, before, after = (table[c][0].as_py() for c in ("part", "before", "after"))
    return shard_nodes(ids[order], [seqs[i] for i in order], part, before, after)


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of rows sorted by key and part, holding one piece at a time."""
    key, running = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "digest": pa.array([running.hexdigest()])})

    for batch in batches:
        for k, piece in zip(batch["key"].to_pylist(), batch["ends"], strict=True):
            if k != key:
                if running is not None:
                    yield out()
                key, running = k, hashlib.sha256()
            else:
                running.update(b",")
            running.update(piece.as_py().encode())
    if running is not None:
        yield out()


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of ``sequences(conv_id, seq)``, conv_ids distinct.

    Returns ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. The empty prefix is the root, with
    a NULL parent; without any conversation there is no root. A sequence of turns is handled as a whole (20 bytes a turn), the texts stay behind. The
    order of the shards samples 100 sequences a shard.
    """
    spark = sequences.sparkSession
    ship(spark)
    rows = stage(sequences.select("conv_id", "seq"), "trie-sequences")
    turns = (rows.agg(F.sum(F.octet_length("seq"))).first()[0] or 0) // UNIT
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    ordered = rows.repartitionByRange(shards, "seq", "conv_id").withColumn("part", F.spark_partition_id())
    ordered = stage(ordered, "trie-shards")
    edges = ordered.groupBy("part").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    by_part = Window.orderBy("part")  # one row per shard
    edges = edges.select("part", "first", "last", F.lag("last").over(by_part).alias("earlier"), F.lead("first").over(by_part).alias("later"))
    edges = edges.select("part", _common("first", "earlier").alias("before"), _common("last", "later").alias("after"))
    joined = ordered.join(F.broadcast(edges), "part")
    nodes = stage(joined.groupBy("part").applyInArrow(_shard, SHARD_NODE), "trie-nodes")

    pieces = nodes.filter("key is not null")
    listed = pieces.filter("ends is not null").select("key", "part", "ends")
    digests = listed.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_hash_runs, "key binary, digest string")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = pieces.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), *sums)
    merged = stage(merged.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(_NO_ENDS))).drop("digest"), "trie-borders")
    parents = small(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above")), BORDER_NODES)
    whole = nodes.filter("key is null").unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")), allowMissingColumns=True)
    found = whole.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns(conv_id, turn, role, text)``; see :func:`rebuilt` and :func:`prefix_trie`.

    NULL roles and texts count as empty, rows without a conv_id belong to no conversation, repeated rows are turns of their own, an empty
    table gives no rows, and further columns are ignored.
    """
    own = stage(sequences(turns), "trie-turns")
    return prefix_trie(rebuilt(own), shard_turns)
