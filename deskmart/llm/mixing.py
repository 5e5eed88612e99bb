"""Mixing sources to target weights by fitting length counts to a word budget.

Documents of one source and length are interchangeable for the budget, so it is fitted on
counts: for each source, how many documents of each exact length to take. Most of the
budget is spent in the proportion of the source's own lengths; a bounded knapsack (a subset-sum
over the counts that are left) spends the rest as exactly as the lengths allow. Which documents of a length
are taken follows from a seeded hash of their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deskmart.llm.common import content_hash, null_safe_join, stage
from deskmart.llm.slot_sharding import number_copies

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_REPEAT = 2
BUCKETS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def fit_counts(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length to take, at most ``counts``, for a sum near to and not above ``budget``.

    Every length first gives its share, rounded down. Longest first, single documents then bring the rest
    below the longest length left, and a subset-sum over bits finds the best sum for what remains.
    """
    total = sum(length * n for length, n in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    taken = [n * budget // total for n in counts]
    rest = budget - sum(length * n for length, n in zip(lengths, taken, strict=True))
    order = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    for i in order:
        k = min(counts[i] - taken[i], max(0, rest - lengths[order[0]]) // lengths[i])
        taken[i] += k
        rest -= k * lengths[i]
    # Bit b of `reach` says that b words can be spent; each step adds a power-of-two lot of one length.
    mask, reach, steps = (1 << (rest + 1)) - 1, 1, []
    for i in reversed(order):
        left, lot = min(counts[i] - taken[i], rest // lengths[i]), 1
        while left > 0 and not reach >> rest & 1:
            lot = min(lot, left)
            wider = (reach | reach << lot * lengths[i]) & mask
            if wider != reach:
                steps.append((i, lot, reach))
                reach = wider
            left, lot = left - lot, lot * 2
        if reach >> rest & 1:
            break
    spent = reach.bit_length() - 1
    for i, lot, before in reversed(steps):
        if not before >> spent & 1:
            taken[i] += lot
            spent -= lot * lengths[i]
    return taken


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """Targets of ``totals(source, source_size)``, one row per source.

    Weights go round in code point order of the sources, NULL last. A target is the smaller of
    ``max_repeat`` times the size and a common level times the weight; the level spends
    the budget. That is where stopping at the limit and resharing the excess by weight ends.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_rank") % len(weights) + 1)
    capped = (
        totals.withColumn("_rank", (rank - 1).cast("int"))
        .withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
        .withColumn("_full", F.col("_cap") / F.col("_w"))  # level at which the source stops
    )
    whole = Window.partitionBy()
    order = Window.orderBy("_full", "_rank")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        capped.withColumn("_left", F.sum("source_size").over(whole) * budget - F.coalesce(F.sum("_cap").over(below), F.lit(0.0)))
        .withColumn("_weights", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(below), F.lit(0.0)))
        # Sources before this one stop; the level that spends the rest must not reach this one's.
        .withColumn("_level", F.when(F.col("_left") <= F.col("_full") * F.col("_weights"), F.col("_left") / F.col("_weights")))
        .withColumn("_level", F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.when(F.col("_level").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_level") * F.col("_w")))
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size").reset_index(drop=True)
    lengths, counts = group["size"].tolist(), group["n"].tolist()
    own, target = int(group["source_size"].iloc[0]), round(float(group["target"].iloc[0]))
    times = min(target // own, 1 << 30) if own else 0
    group["times"] = times
    group["extra"] = fit_counts(lengths, counts, target - times * own)
    return group[["source", "size", "times", "extra"]]


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    max_repeat: int = MAX_REPEAT,
    seed: int = 11,
) -> DataFrame:
    """Words that the mix takes of each document of ``docs(doc_id, source, text)``.

    Returns ``doc_id, size, source_size, target, taken, copies``: ``copies`` (0 to ``max_repeat``) times ``size``
    words of the document are taken. NULL texts have no words; they and documents without words are taken no time.
    A NULL source is a source of its own. Repeated rows are documents of their own, told apart by their number. An empty
    table gives no rows; further columns are ignored.

    Groups of one source and length are ranked by a seeded hash of id, text and number in ``BUCKETS`` parts, so neither a group with a third of all rows nor
    an id or a text that many rows share is ranked by one task. Targets are computed on one row per source; sources are taken to be few.
    """
    words = F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long")
    numbered = number_copies(
        docs.select(docs["doc_id"].alias("doc_id"), docs["source"].cast("string").alias("source"), words.alias("size"), F.xxhash64(docs["text"]).alias("_text"))
    )
    order = F.xxhash64(F.lit(seed), "doc_id", "_text", "copy")
    rows = stage(
        numbered.select(
            "doc_id", "source", "size", order.alias("_order"), F.pmod(F.shiftrightunsigned(order, 40), F.lit(BUCKETS)).cast("int").alias("_bucket")
        ),
        "mix",
    )
    parts = rows.groupBy("source", "size", "_bucket").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stage(source_targets(totals, weights, budget, max_repeat), "mix-targets")
    planned = null_safe_join(sizes, targets, ["source"])
    counts = stage(
        planned.groupBy("source").applyInPandas(_fit, "source string, size long, times long, extra long"), "mix-counts"
    )
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("_bucket")) - F.col("n")
    parts = parts.withColumn("_before", before)
    parts = null_safe_join(parts, counts, ["source", "size"]).select(
        "source", "size", "_bucket", (F.col("extra") - F.col("_before")).alias("_extra"), "times"
    )
    joined = null_safe_join(rows, parts, ["source", "size", "_bucket"])
    rank = F.row_number().over(Window.partitionBy("source", "size", "_bucket").orderBy("_order"))
    chosen = joined.withColumn(
        "copies", (F.col("times") + F.when((F.col("size") > 0) & (rank <= F.col("_extra")), 1).otherwise(0)).cast("long")
    )
    return null_safe_join(chosen, targets, ["source"]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.when(F.col("size") > 0, F.col("copies")).otherwise(0).cast("long").alias("copies"),
    )


def repeat_by_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all their columns as they are, each as often as :func:`mix` takes it.

    Rows with equal doc_id and text are alike to the mix: their copies are counted together and dealt over them.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[docs[c].alias(n) for c, n in names.items()])
    key, whole = F.col(names["doc_id"]), content_hash(rows)
    marked = rows.select(F.struct(key.alias("doc_id"), whole.alias("h")).alias("doc_id"), F.col(names["source"]).alias("source"), F.col(names["text"]).alias("text"))
    taken = mix(marked, **options).filter("copies > 0").select("doc_id.doc_id", "doc_id.h", "copies")
    # Rows that agree in every column are one group here, with the sum of their copies.
    taken = taken.groupBy("doc_id", "h").agg(F.sum("copies").alias("copies")).withColumnsRenamed({"doc_id": "k", "h": "kh"})
    own = rows.withColumn("h", whole)
    joined = own.join(taken, (F.col("h") == F.col("kh")) & key.eqNullSafe(F.col("k"))).dropDuplicates([names["doc_id"], "h"])
    return joined.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col(n).alias(c) for c, n in names.items()])
