"""SimHash near-duplicates by segment popcounts.

A fingerprint is embedded as the popcounts of its short segments. Flipping one bit moves one coordinate by one, so the
Manhattan distance of two embeddings is never above the Hamming distance of the fingerprints: a lower bound, by which pairs
are sifted before they are compared exactly.

The range join under that distance runs on a grid. The segments are split into ``axes`` groups. If the distance is at most
``d``, at most ``d`` groups differ, so two embeddings agree in all coordinates of at least ``axes - d`` groups. Every choice
of that many groups spans a subspace; fingerprints meet in its unit cells, which loses no pair. A cell keeps one pair per
link that joins parts not yet joined there, hence fewer links than members, never all pairs. Cells with many members are
cut into blocks, and each pair of blocks is a task of its own.

Fingerprints are made distinct first: copies of a text, however many, are one row from there on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.llm.common import content_hash, stage

BITS = 64
SEGMENT = 2
SHINGLE = 4
DISTANCE = 4
AXES = 7
BLOCK = 4096


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Bit b is set if it is set in over half of the hashes of the shingles, repeats included; 0 without words."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[: len(words) - shingle]])
        view = memoryview(joined)
        grams = [view[a:b] for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, seed) for g in grams], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return sum(1 << int(b) for b in bits)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_column(text, shingle: int = SHINGLE):
    """64-bit fingerprint of a text column, as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([signed(simhash(t, shingle)) for t in batch], dtype="int64")

    return fingerprint(text.cast("string"))


def embed(values: np.ndarray) -> np.ndarray:
    """Popcounts of the segments of each fingerprint, one row each."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(values), BITS // SEGMENT, SEGMENT).sum(2, dtype=np.uint8)


def cells(values: np.ndarray, distance: int, axes: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each subspace of the grid, a 64-bit key of every fingerprint's cell in it."""
    groups = np.array_split(embed(values), axes, axis=1)
    keys = []
    for g, part in enumerate(groups):
        key = np.full(len(values), 0x9E3779B97F4A7C15 * (g + 1) % (1 << 64), np.uint64)
        for column in part.T:  # base SEGMENT + 1 numbers one cell of the group exactly
            key = key * np.uint64(SEGMENT + 1) + column
        keys.append(key)
    for s, chosen in enumerate(combinations(range(axes), axes - distance)):
        cell = np.full(len(values), s, np.uint64)
        for g in chosen:
            cell = (cell ^ keys[g]) * np.uint64(0xD6E8FEB86659FD93)
            cell ^= cell >> np.uint64(32)
        yield s, cell


def _within(values: np.ndarray, points: np.ndarray, i: int, others: slice, distance: int) -> np.ndarray:
    """Which of ``others`` link to ``i``: sifted by the Manhattan distance of the popcounts, then compared bit by bit."""
    near = others.start + np.flatnonzero(np.abs(points[others] - points[i]).sum(1, dtype=np.int16) <= distance)
    return near[np.bitwise_count(values[near] ^ values[i]) <= distance]


def forest(values: np.ndarray, points: np.ndarray, distance: int, split: int = 0) -> list[tuple[int, int]]:
    """Places of links that connect all pairs within ``distance``: those across ``split``, or any if it is 0."""
    n = len(values)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []
    for i in range(split or n - 1):
        for j in _within(values, points, i, slice(split or i + 1, n), distance).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                found.append((i, j))
    return found


def _runs(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by ``keys``, cut so that only whole runs of equal keys are in one; a run may be large."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = (batch[list(keys)] == batch[list(keys)].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut or (rest and (rest[-1][list(keys)].iloc[-1] != batch[list(keys)].iloc[-1]).any()):
            yield pd.concat([*rest, batch.iloc[:cut]], ignore_index=True)
            rest = []
        rest.append(batch.iloc[cut:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    new[:1] = True
    return np.append(np.flatnonzero(new), len(new))


_FOUND = "a long, b long, cell long, block int"


def similar_links(fingerprints: DataFrame, distance: int = DISTANCE, axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` of the distinct fingerprints in column ``fp`` that connect all pairs within ``distance``.

    Every link is such a pair, and the ends of every such pair are joined by a path of links.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64)
            for _, cell in cells(own.view(np.uint64), distance, axes):
                yield pd.DataFrame({"cell": cell.view(np.int64), "fp": own})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links of small cells; the members of cells above ``block`` are dealt to numbered blocks instead."""
        for rows in _runs(batches, ["cell"]):
            cell, own = rows["cell"].to_numpy(np.int64), rows["fp"].to_numpy(np.int64)
            at = _starts(cell)
            size = np.diff(at)
            pairs, big = [], []
            two = at[:-1][size == 2]
            if len(two):  # most cells: compared together
                x, y = own[two].view(np.uint64), own[two + 1].view(np.uint64)
                low = np.abs(embed(x).astype(np.int8) - embed(y)).sum(1, dtype=np.int16) <= distance
                ok = low & (np.bitwise_count(x ^ y) <= distance)
                pairs.append(np.stack([own[two[ok]], own[two[ok] + 1]], 1))
            for start, n in zip(at[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
                part = own[start : start + n]
                if n > block:
                    big.append(pd.DataFrame({"a": part, "b": 0, "cell": cell[start], "block": np.arange(n, dtype=np.int32) // block}))
                else:
                    values = part.view(np.uint64)
                    found = forest(values, embed(values).astype(np.int8), distance)
                    if found:
                        pairs.append(part[np.array(found)])
            if pairs:
                both = np.concatenate(pairs)
                yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1], "cell": 0, "block": np.int32(-1)})
            yield from big

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links within one block of a cell or across two."""
        for rows in _runs(batches, ["cell", "x", "y"]):
            cell, x, y = (rows[c].to_numpy() for c in ("cell", "x", "y"))
            own, mine = rows["a"].to_numpy(np.int64), rows["block"].to_numpy()
            at = _starts(cell, x, y)
            for start, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                side = np.argsort(mine[start:end], kind="stable")
                part = own[start:end][side]
                split = 0 if x[start] == y[start] else int((mine[start:end] == x[start]).sum())
                values = part.view(np.uint64)
                found = forest(values, embed(values).astype(np.int8), distance, split)
                if found:
                    both = part[np.array(found)]
                    yield pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    met = fingerprints.select("fp").mapInPandas(spread, "cell long, fp long").repartition("cell").sortWithinPartitions("cell")
    found = stage(met.mapInPandas(compare, _FOUND), "simhash-cells")
    big = found.filter("block >= 0")
    blocks = big.groupBy("cell").agg((F.max("block") + 1).alias("k"))
    dealt = big.join(blocks, "cell").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.select("cell", "a", "block", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"))
    rest = dealt.repartition("cell", "x", "y").sortWithinPartitions("cell", "x", "y").mapInPandas(across, "a long, b long")
    return found.filter("block < 0").select("a", "b").union(rest).distinct()


def components(links: DataFrame) -> DataFrame:
    """Label of each end of the undirected ``links(a, b)``: ``node, label``, equal where a path exists.

    Each round points every node to its neighbour that comes first in a hashed order, and replaces nodes by what they
    point to. The graph at least halves in a usual round, so the number of rounds follows the logarithm of its size.
    """

    def key(c):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))

    edges, rounds = stage(links.filter("a <> b"), "links"), []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min(key("b")).alias("m"))
        first = F.when(F.col("m") < key("a"), F.col("m.v")).otherwise(F.col("a"))
        step = stage(least.select(F.col("a").alias("node"), first.alias("label")), "round")
        rounds.append(step)
        left = edges.join(step.withColumnsRenamed({"node": "a", "label": "x"}), "a")
        moved = left.join(step.withColumnsRenamed({"node": "b", "label": "y"}), "b")
        edges = stage(moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0)
    out = rounds[0]
    for step in rounds[1:]:
        step = step.select(F.col("node").alias("was"), F.col("label").alias("next"))
        out = out.join(step, F.col("label") == F.col("was"), "left").select("node", F.coalesce("next", "label").alias("label"))
    return out


def label_fingerprints(rows: DataFrame, distance: int = DISTANCE, axes: int = AXES) -> DataFrame:
    """``fp, first, label`` of each distinct fingerprint of ``rows(doc_id, fp)``: its smallest doc_id, and a label that its component shares."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    labels = components(similar_links(distinct, distance, axes)).withColumnRenamed("node", "fp")
    labelled = distinct.join(labels, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    return stage(labelled, "simhash-labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, axes: int = AXES) -> DataFrame:
    """``doc_id, fp, component_id`` of each row of ``docs(doc_id, text)``; ``component_id`` is the smallest doc_id reachable.

    Rows link at ``distance`` or fewer differing bits, and links chain. NULL and empty texts and texts of white space have
    fingerprint zero and link like any other. Repeated rows are copies. A NULL doc_id is never the smallest; a component
    without any other has NULL. An empty table gives no rows; further columns are ignored.
    """
    rows = stage(docs.select(docs["doc_id"].alias("doc_id"), fingerprint_column(docs["text"], shingle).alias("fp")), "simhash")
    labelled = label_fingerprints(rows, distance, axes)
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of = labelled.join(least, "label").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, axes: int = AXES) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each component, all their columns as they are; see :func:`near_duplicates`.

    Of several rows with that doc_id one stays, and so does one row of a component without any doc_id. Which row of several follows
    from a hash of all columns.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # own names cannot clash
    rows = docs.select(*[docs[c].alias(n) for c, n in names.items()])
    key, text = F.col(names["doc_id"]), F.col(names["text"])
    whole = content_hash(rows)
    marks = stage(rows.select(key.alias("doc_id"), whole.alias("h"), text.alias("text")).select("doc_id", "h", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash")
    of = label_fingerprints(marks.select("doc_id", "fp"), distance, axes).select("fp", "label")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    chosen = marks.join(of, "fp").groupBy("label").agg(F.min(order).alias("m")).select("m.doc_id", "m.h")
    # Rows that agree in every column have one hash: one of them stays.
    kept = rows.withColumn("h", whole).join(chosen.withColumnsRenamed({"doc_id": "k", "h": "kh"}), (F.col("h") == F.col("kh")) & key.eqNullSafe(F.col("k")), "left_semi")
    once = kept.dropDuplicates([names["doc_id"], "h"])
    return once.select(*[F.col(n).alias(c) for c, n in names.items()])
