"""Materialising frames, and broadcasting them once their size is known."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from gc import collect as drop_garbage

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 400_000
GROUPED_ROWS = 400_000
RELEASE_BYTES = 8 << 20


def scratch(spark: SparkSession) -> str:
    """A new path in ``spark.checkpoint.dir``, deleted when the driver ends.

    Only a session inside one process may fall back to a folder of its own; on a
    cluster such a folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="deskmart-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as compressed Parquet to shared scratch storage and continue from there.

    Unlike a checkpoint, the copy is columnar: a reader of some columns reads no others,
    and filters reach it. It holds the rows in no order that a reader may rely on.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    release(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str, least: int = RELEASE_BYTES) -> None:
    """Let go of what the step behind the table at ``path`` leaves behind, if that table is of ``least`` bytes.

    Spark keeps the shuffle files and broadcasts of a finished step until the driver happens to collect its garbage, which
    a driver with little to do may not do before the disks are full. Nothing that is still in use is lost.
    """
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    if written.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(written).getLength() >= least:
        spark.range(1).count()  # the last plan that ran may be held until the next one runs
        drop_garbage()
        spark._jvm.System.gc()


def measured(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a narrow roll-up once, and mark it for broadcast if it is small.

    Spark plans a join with an aggregate from the size of the aggregate's input, so
    it would shuffle the fact before noticing that a few thousand rows come out.
    Here the rows are counted first; above ``max_rows`` nothing is marked and the
    usual shuffle join with its skew handling is planned.
    """
    fixed = materialize(df)
    return F.broadcast(fixed) if fixed.count() <= max_rows else fixed


def plan_plainly(spark: SparkSession) -> None:
    """Keep Spark's optimizer from deriving filters from filters, in this session.

    It rewrites every condition with each alias that a column has had, so what it holds grows exponentially along plans like those of the marts: with
    hot keys, gigabytes of the driver's memory. The marts state their filters where they are needed; no result depends on derived ones.
    """
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def spread(df: DataFrame, counted: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` over so many tasks that each gets about :data:`GROUPED_ROWS` rows; ``counted`` has as many rows as ``df``.

    With a fixed number of shuffle partitions, what a task has to group would grow with the input. Inputs that the session's
    own number of partitions serves are left alone.
    """
    tasks = -(-counted.count() // GROUPED_ROWS)
    return df.repartition(tasks, *keys) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def together(*steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent steps side by side, so that small jobs do not wait for each other.

    At most as many jobs run as there are steps; the scheduler shares the executors among them.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]
