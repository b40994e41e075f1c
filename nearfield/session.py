"""Session settings, working folders and size checks shared by the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when a bounded count proves it no larger than this.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 * 1024 * 1024
SPLIT_BYTES = 128 * 1024 * 1024


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (timestamps are compared in UTC) and make this package importable
    in the Python workers of every executor."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        spark.sparkContext.addPyFile(_package_archive())
        _shipped.add(application)
    return spark


def _package_archive() -> str:
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="nearfield-code-"), "nearfield.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("nearfield", os.path.relpath(path, root)))
    return target


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate: file sizes under a scan, an upper guess above joins. Runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def estimated_tasks(df: DataFrame) -> int:
    return estimated_bytes(df) // SPLIT_BYTES + 1


def widen(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores.

    A file with one row group is one task however many cores there are. Inputs of more than a few
    splits per core are left alone: they are wide enough, and moving them would shuffle the data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_tasks(df) <= min(2 * cores, 64) else df


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="nearfield-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/nearfield-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Remove the stage tables of this application; results read from them must be written before."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame that several later jobs read, and read it back.

    The table lies in the shared folder, so a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_count(df: DataFrame, limit: int) -> int:
    """Row count, but never counting further than ``limit + 1`` rows."""
    return df.limit(limit + 1).count()


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, bytes_of: Column | None = None) -> DataFrame:
    """Hint a broadcast only when the frame is proven small.

    Narrow frames of numbers are bounded by ``rows`` alone; with ``bytes_of`` (size of one row) the
    summed size must also stay within the byte bound.
    """
    if bytes_of is None:
        return F.broadcast(df) if bounded_count(df, rows) <= rows else df
    n, volume = df.select(bytes_of.alias("b")).limit(rows + 1).agg(F.count(F.lit(1)), F.sum("b")).first()
    return F.broadcast(df) if n <= rows and (volume or 0) <= BROADCAST_BYTES else df


def salt(*cols: Column, buckets) -> Column:
    """Stable bucket number from the row's own values, independent of partitioning."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def skew_join(big: DataFrame, small: DataFrame, key: str, spread: Column, how: str = "inner", salts: int = 32) -> DataFrame:
    """Equi-join on ``key`` with a frame of one row per key, safe against hot keys of ``big``.

    A ``small`` proven to fit is broadcast. Otherwise every key of ``big`` is split over ``salts``
    tasks by a hash of ``spread``, and ``small`` is replicated that often.
    """
    if bounded_count(small, BROADCAST_ROWS) <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), key, how)
    left = big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"], how).drop("__salt")
