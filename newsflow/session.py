"""Session settings and shared scratch space."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path
from weakref import WeakSet

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F

_SHIPPED: WeakSet[SparkContext] = WeakSet()


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready: timestamps in UTC, Arrow batches and buffers of products of bounded size, and the package on all executors."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    # Beyond so many (packed) rows a product keeps them where Spark can spill them.
    spark.conf.set("spark.sql.cartesianProductExec.buffer.in.memory.threshold", "32")
    context = spark.sparkContext
    if context not in _SHIPPED:
        folder = Path(__file__).resolve().parent
        target = tempfile.mkdtemp(prefix="newsflow-package-")  # Spark sends it on from here
        context.addPyFile(shutil.make_archive(f"{target}/newsflow", "zip", folder.parent, folder.name))
        _SHIPPED.add(context)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own, since
    there the driver and the executors share one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="newsflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/newsflow/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` after counting it; beyond ``max_rows`` Spark picks the join itself.

    Counting stops at the bound. Hand in a stored or materialised frame.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def spread_small(df: DataFrame, bytes_per_task: int = 64 << 20) -> DataFrame:
    """Deal a small stored table out to all cores before work that costs much per row.

    Hand in tables only: Spark's estimate of their size is that of their files,
    but behind a Python step it is that of the step's input.

    A few files make a few splits, so most cores would idle. A large input has
    splits enough and is left where it is, without a shuffle.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= cores * bytes_per_task else df
