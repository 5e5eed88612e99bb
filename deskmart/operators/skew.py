"""Joins that survive a key holding a large share of the rows.

Adaptive execution already turns a join whose measured right side is small into a
broadcast join and splits skewed partitions of a single join. It cannot split when
several joins share one partitioning, and it never splits a group before an
aggregate. :class:`HotKeys` covers the joins that may meet such a key: it counts
the join keys of the fact in a sample, and spreads each key above ``rows_per_task``
over just enough salts. Without hot keys the plain join is planned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmart.operators.sizing import BROADCAST_ROWS, materialize

ROWS_PER_TASK = 4_000_000
SAMPLE_HITS = 4_000

Key = tuple[str, ...]


def common_type(df: DataFrame, a: T.DataType, b: T.DataType) -> str:
    """The type in which Spark compares values of two types; texts are compared with texts alone."""
    if isinstance(a, T.StringType) != isinstance(b, T.StringType):
        raise TypeError(f"join key is {a.simpleString()} on one side and {b.simpleString()} on the other")
    sql = f"select coalesce(cast(null as {a.simpleString()}), cast(null as {b.simpleString()})) as x"
    return df.sparkSession.sql(sql).schema["x"].dataType.simpleString()


def agree(left: Sequence[str], right: Sequence[str]) -> Column:
    """True where columns agree pairwise, NULLs included, in a form that a join keeps as a residual.

    Written as equalities, Spark would make them keys of the join and shuffle by all of them; as a residual
    they leave the partitioning by the one key that several steps share. The types must be equal.
    """
    return F.array_contains(F.array(F.struct(*left)), F.struct(*[F.col(r).alias(a) for a, r in zip(left, right, strict=True)]))


class HotKeys:
    """Values of (composite) keys that occur in more than ``rows_per_task`` rows.

    ``tables`` has, for each key with such values, a frame of the key's columns and
    ``_salts``, the number of salts of each value.
    """

    def __init__(self, tables: Mapping[Key, DataFrame]):
        self.tables = {tuple(k): t for k, t in tables.items()}

    @classmethod
    def none(cls) -> HotKeys:
        return cls({})

    @classmethod
    def find(cls, fact: DataFrame, keys: Sequence[Key], rows_per_task: int | None = ROWS_PER_TASK) -> HotKeys:
        """Count all ``keys``, NULL values included, in one pass over their pruned scan.

        The counts only decide how many salts a value gets, never which rows are
        kept, so a sample is enough: a value at the bound is expected
        ``SAMPLE_HITS`` times in it. The hot values stay a frame, written once; the
        driver learns which of ``keys`` have any. ``None`` skips the pass and leaves
        skew to adaptive execution alone.
        """
        if rows_per_task is None:
            return cls.none()
        types = {f.name: f.dataType.simpleString() for f in fact.schema.fields}
        share = min(1.0, SAMPLE_HITS / rows_per_task)
        if share < 1.0:
            fact = fact.sample(fraction=share, seed=7)
        values = [F.struct(F.lit(i).alias("key"), F.array(*[F.col(c).cast("string") for c in k]).alias("at")) for i, k in enumerate(keys)]
        heavy = (
            fact.select(F.explode(F.array(*values)).alias("p"))
            .groupBy("p.key", "p.at")
            .agg(F.count("*").alias("n"))
            .filter(F.col("n") > rows_per_task * share)
            .select("key", "at", F.ceil(F.col("n") / (rows_per_task * share)).cast("int").alias("_salts"))
        )
        heavy = materialize(heavy)
        found = heavy.agg(F.count("*"), F.collect_set("key")).first()  # at most len(keys) numbers
        tables = {}
        for i in found[1]:
            columns = [F.col("at")[j].cast(types[c]).alias(c) for j, c in enumerate(keys[i])]
            table = heavy.filter(F.col("key") == i).select(*columns, "_salts")
            tables[tuple(keys[i])] = F.broadcast(table) if found[0] <= BROADCAST_ROWS else table
        return cls(tables)

    def left_join(
        self,
        left: DataFrame,
        right: DataFrame,
        on: Sequence[str],
        hot: Key | None = None,
        residual: Column | None = None,
        null_safe: bool = False,
    ) -> DataFrame:
        """Left join on the equally named columns ``on``; see :meth:`join`."""
        return self.join(left, right, on, "left", hot, residual, null_safe)

    def join(
        self,
        many: DataFrame,
        few: DataFrame,
        on: Sequence[str],
        how: str,
        hot: Key | None = None,
        residual: Column | None = None,
        null_safe: bool = False,
    ) -> DataFrame:
        """Join on the equally named columns ``on``, keeping one copy of them.

        ``hot`` is the counted key, ``on`` itself or some of its columns. Rows of
        ``many`` with a hot value are spread over salts, and the rows of ``few`` with
        that value are repeated once per salt: fine for ``left`` and ``inner``; a
        ``right`` join then yields an unmatched row of ``few`` once per salt, for the
        caller to fold. ``residual`` may use the other columns of both sides;
        ``null_safe`` lets NULL keys match each other. Key columns of different types
        are compared, and salted, in their common type.
        """
        keys, key = list(on), tuple(hot or on)
        if (table := self.tables.get(key)) is not None:
            many, few = _salted(many, few, key, table)
            keys.append("_salt")
        if residual is None and not null_safe:
            return many.join(few, keys, how).drop("_salt")
        if how == "right":
            many = many.withColumnsRenamed({k: f"_o_{k}" for k in keys})
        else:
            few = few.withColumnsRenamed({k: f"_o_{k}" for k in keys})
        condition = F.lit(True) if residual is None else residual
        for k in keys:
            other = F.col(f"_o_{k}")
            condition = (F.col(k).eqNullSafe(other) if null_safe else F.col(k) == other) & condition
        return many.join(few, condition, how).drop("_salt", *[f"_o_{k}" for k in keys])


def _salted(spread: DataFrame, repeated: DataFrame, key: Key, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Give every row of ``spread`` one salt of its key, every row of ``repeated`` all of them.

    The salt follows from the row and its input partition, so a recomputed task
    deals the same salts and exact copies of a row still part ways.
    """
    types = {k: common_type(spread, spread.schema[k].dataType, repeated.schema[k].dataType) for k in key}
    hot = table.select(*[F.col(k).cast(t).alias(f"_hot_{k}") for k, t in types.items()], "_salts")

    def sized(df: DataFrame) -> DataFrame:
        match = F.lit(True)
        for k, t in types.items():
            match = match & F.col(k).cast(t).eqNullSafe(F.col(f"_hot_{k}"))
        return df.join(hot, match, "left").drop(*[f"_hot_{k}" for k in key])

    number = F.coalesce("_salts", F.lit(1))
    content = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in spread.columns])
    left = sized(spread.withColumn("_content", content)).withColumn("_salt", F.pmod("_content", number).cast("int"))
    right = sized(repeated).withColumn("_salt", F.explode(F.sequence(F.lit(0), number - 1)))
    return left.drop("_content", "_salts"), right.drop("_salts")
