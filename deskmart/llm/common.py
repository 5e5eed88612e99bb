"""Scratch tables on storage that driver and executors share, and a few helpers of several operators."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers of all executors, once per application."""
    context = spark.sparkContext
    if "deskmart.zip" not in context._python_includes:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='deskmart-ship-')}/deskmart", "zip", package.parent, package.name)
        context.addPyFile(archive)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the given folder, for queries whose operators may run Python on the executors."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in ``spark.checkpoint.dir``, deleted when the driver ends.

    A session without that setting gets a folder of its own only if it runs inside one
    process, where no executor could miss the files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="deskmart-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and continue from there: later steps read it, and lost executors lose nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equally named columns of which NULLs match each other; they come from ``left``."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(right, condition, how).drop(*[f"_right_{c}" for c in on])


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which have no hash of their own, count as their JSON."""
    plain = [c if "map<" not in kind else None for c, kind in df.dtypes]
    told = [F.col(f"`{c}`") if c == p else F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c, p in zip(df.columns, plain, strict=True)]
    return F.xxhash64(*told)


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def small(table: DataFrame, max_rows: int) -> DataFrame:
    """A staged table, marked for broadcast if it has at most ``max_rows`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(table) if table.limit(max_rows + 1).count() <= max_rows else table


def frequent_floor(table: DataFrame, count: str, most: int) -> int:
    """A bound that ``count`` reaches in at most ``most`` rows; found on a scale of eighths of powers of two, so few numbers reach the driver."""
    step = F.floor(F.log2(count) * 8).cast("int")
    seen, least = 0, None
    for row in sorted(table.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        seen += row.rows
        if seen > most:
            break
        least = row.step
    return (1 << 62) if least is None else math.ceil(2 ** (least / 8) - 1e-6)


def arrow_schema(spark: SparkSession, layout: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], layout).schema)


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows in the same order, in tables of about ``size`` bytes of text."""
    waiting, held = [], 0
    for batch in batches:
        lengths, start = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(), 0
        for i, length in enumerate(lengths):
            if held and held + length > size:
                yield pa.Table.from_batches([*waiting, batch.slice(start, i - start)])
                waiting, held, start = [], 0, i
                pa.default_memory_pool().release_unused()  # else a worker keeps the most that any chunk took
            held += int(length)
        waiting.append(batch.slice(start))
    if waiting:
        yield pa.Table.from_batches(waiting)
