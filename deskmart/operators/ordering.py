"""Total order at scale: row numbers, running values, group totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmart.operators.sizing import materialize
from deskmart.operators.skew import HotKeys

_LOCAL_ROW_BITS = 33  # fixed by monotonically_increasing_id: partition above, row below


def _after(fixed: DataFrame, value: Column) -> DataFrame:
    """``fixed`` with ``_before``: the sum of ``value`` over the parts of a sort before the one of ``_id``.

    There is one row per part, so an unpartitioned window and a broadcast are safe.
    """
    part = F.shiftrightunsigned("_id", _LOCAL_ROW_BITS)
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = fixed.groupBy(part.alias("_part")).agg(F.sum(value).alias("_n"))
    sums = sums.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return fixed.join(F.broadcast(sums), part == F.col("_part")).drop("_part")


def number_rows(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Number the rows 1..n in ``order_by`` order without one task seeing them all.

    A global sort range-partitions the rows; what remains is to add, to the place
    of a row in its partition, the sizes of the partitions before. The sorted rows
    are materialised first, so that counting and numbering see the same partitions.
    Rows that ``order_by`` does not tell apart are ordered by a hash of all their columns; only
    exact copies are left to the partition they come from, so a pile of them can be split as well.
    """
    whole = F.xxhash64(*df.columns)
    ordered = df.withColumn("_from", F.spark_partition_id()).orderBy(*order_by, whole, "_from").drop("_from")
    fixed = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()))
    place = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_ROW_BITS) - 1))
    return _after(fixed, F.lit(1)).withColumn(name, F.col("_before") + place + 1).drop("_id", "_before")


def row_key(*columns: str) -> Column:
    """A text that tells the values of ``columns`` apart, NULLs included, and is never NULL itself.

    Ids that may be NULL make a poor join key: equality loses them, and a null-safe join hashes two expressions per
    column, which no window or aggregate shares. A digest of 128 bits serves joins, windows and groups alike.
    """
    told = [F.col(c).cast("string") for c in columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in told]))


def row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of 64 bits of all columns of ``df``; rows that DISTINCT takes as one agree in both.

    Much cheaper than :func:`row_key` for many columns, and meant to tell apart rows that agree in such a key. NULLs, which a hash passes over, are
    counted in as bits; 0 and -0 are one value.
    """
    plain = [F.col(f.name) + F.lit(0).cast(f.dataType) if f.dataType.typeName() in ("float", "double") else F.col(f.name) for f in df.schema.fields]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in plain])
    return [F.xxhash64(F.lit(1), nulls, *plain), F.xxhash64(F.lit(2), *plain[::-1], nulls)]


def number_in_groups(df: DataFrame, key: str, order_by: Sequence[Column], name: str) -> DataFrame:
    """Number the rows 1..n of each ``key`` in ``order_by`` order, also where a key holds more rows than a task should.

    The rows are sorted by key and order, which cuts a large key over several partitions. Each (key, partition) is a
    piece whose rows have consecutive ids, so a row's number is the sizes of the pieces before it and its distance from the first row of its own.
    There are at most as many pieces as keys and partitions together: meant for the few keys that are large.
    Rows that ``order_by`` leaves alike are ordered as by :func:`number_rows`.
    """
    whole = F.xxhash64(*df.columns)
    ordered = df.withColumn("_from", F.spark_partition_id()).orderBy(key, *order_by, whole, "_from").drop("_from")
    fixed = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", _LOCAL_ROW_BITS)
    pieces = fixed.groupBy(F.col(key).alias("_of"), part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_id").alias("_first_id"))
    earlier = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_of", "_part", "_first_id", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = fixed.join(F.broadcast(pieces), (F.col(key) == F.col("_of")) & (part == F.col("_part")))
    return joined.withColumn(name, F.col("_before") + F.col("_id") - F.col("_first_id") + 1).drop("_id", "_of", "_part", "_first_id", "_before")


def rows_before(groups: DataFrame, order_by: Sequence[str], count: str, name: str) -> DataFrame:
    """Attach to each of distinct ``groups`` the sum of ``count`` over the groups before it in ``order_by`` order, NULLs last."""
    by = [F.asc_nulls_last(c) for c in order_by]
    fixed = materialize(groups.orderBy(*by).withColumn("_id", F.monotonically_increasing_id()))
    inside = Window.partitionBy(F.shiftrightunsigned("_id", _LOCAL_ROW_BITS)).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(count).over(inside), F.lit(0))
    return _after(fixed, F.col(count)).withColumn(name, F.col("_before") + here).drop("_id", "_before")


def with_group_total(df: DataFrame, keys: Sequence[str], value: str, name: str, hot: HotKeys) -> DataFrame:
    """Attach the sum of ``value`` over each ``keys`` group; ``hot`` is counted on ``keys``.

    No hot key means that every group fits a task, and one window does. Otherwise
    the rows are materialised and read twice: partial sums shrink the hot group
    before the shuffle, and the totals come back through a salted join.
    """
    if tuple(keys) not in hot.tables:
        return df.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))
    fixed = materialize(df)
    totals = fixed.groupBy(*keys).agg(F.sum(value).alias(name))
    return hot.left_join(fixed, totals, keys, null_safe=True)


def running_over_groups(
    groups: DataFrame, keys: Sequence[str], order: str, running: dict[str, tuple[str, str]], rows_per_task: int | None
) -> DataFrame:
    """Running ``sum`` or ``max`` per key in ``order`` (ascending, NULLS LAST), current row included.

    ``groups`` holds one row per (keys, order) and ``running`` maps a new column to
    (function, input column). A key is normally one window group. When some key has
    more than ``rows_per_task`` rows, the sorted rows are cut at their partition
    borders: each piece is a window group of its own, and the totals of the pieces
    before it (as many as partitions, at most) are carried over.
    """
    functions = {"sum": F.sum, "max": F.max}
    here = Window.unboundedPreceding, Window.currentRow
    by_order = F.asc_nulls_last(order)
    spans = rows_per_task is not None and not (
        groups.groupBy(*keys).count().filter(F.col("count") > rows_per_task).isEmpty()
    )
    if not spans:
        w = Window.partitionBy(*keys).orderBy(by_order).rowsBetween(*here)
        return groups.withColumns({new: functions[f](c).over(w) for new, (f, c) in running.items()})

    fixed = materialize(
        groups.orderBy(*keys, by_order).withColumn(
            "_piece", F.shiftrightunsigned(F.monotonically_increasing_id(), _LOCAL_ROW_BITS)
        )
    )
    w = Window.partitionBy(*keys, "_piece").orderBy(by_order).rowsBetween(*here)
    local = fixed.withColumns({new: functions[f](c).over(w) for new, (f, c) in running.items()})
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        fixed.groupBy(*keys, "_piece")
        .agg(*[functions[f](c).alias(f"_t_{new}") for new, (f, c) in running.items()])
        .select(*keys, "_piece", *[functions[f](f"_t_{new}").over(earlier).alias(f"_b_{new}") for new, (f, _) in running.items()])
        .filter(" or ".join(f"_b_{new} is not null" for new in running))
    )
    joined = HotKeys.none().left_join(local, carried, [*keys, "_piece"], null_safe=True)
    for new, (f, _) in running.items():
        before = F.col(f"_b_{new}")
        total = F.coalesce(F.col(new) + before, F.col(new), before) if f == "sum" else F.greatest(new, before)
        joined = joined.withColumn(new, total)
    return joined.drop("_piece", *[f"_b_{new}" for new in running])
