"""Nearest-neighbour benchmark data sets as Parquet: train, test, neighbors, distances and metadata."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from nearfield.operators.tables import number_rows

VECTORS = T.StructType([T.StructField("id", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))])
NEIGHBORS = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("neighbors", T.ArrayType(T.LongType()))])
DISTANCES = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("distances", T.ArrayType(T.FloatType()))])
METADATA = T.StructType([
    T.StructField("dimension", T.LongType()), T.StructField("metric_type", T.StringType()),
    T.StructField("train_size", T.LongType()), T.StructField("test_size", T.LongType()),
    T.StructField("neighbors_k", T.LongType()),
])
NEIGHBOR_ROWS = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("group_id", T.LongType()),
    T.StructField("neighbors", T.ArrayType(T.LongType())), T.StructField("distances", T.ArrayType(T.DoubleType())),
])

RECORDS_AT_ONCE = 4096

# The parts of a data set and their file names.
PARTS = {
    "train": "train.parquet",
    "test": "test.parquet",
    "neighbors": "neighbors.parquet",
    "distances": "distances.parquet",
    "metadata": "metadata.json",
}


@dataclass(frozen=True)
class AnnDataset:
    train: DataFrame
    test: DataFrame
    neighbors: DataFrame
    distances: DataFrame
    metadata: DataFrame


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_vectors(spark: SparkSession, path: str, id: str = "id", vector: str = "vector") -> DataFrame:
    """A Parquet table of vectors as ``(id, vector)``."""
    return spark.read.parquet(path).select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector"))


def dataset_ready(spark: SparkSession, folder: str) -> bool:
    return all(path_exists(spark, f"{folder}/{name}") for name in PARTS.values())


def read_ann_dataset(spark: SparkSession, folder: str) -> AnnDataset:
    """All parts of a data set; every part must be there."""
    missing = [name for name in PARTS.values() if not path_exists(spark, f"{folder}/{name}")]
    if missing:
        raise FileNotFoundError(f"{folder} lacks {', '.join(missing)}")

    def part(name, schema):
        return spark.read.schema(schema).parquet(f"{folder}/{PARTS[name]}")

    metadata = spark.read.schema(METADATA).option("multiLine", True).json(f"{folder}/{PARTS['metadata']}")
    return AnnDataset(part("train", VECTORS), part("test", VECTORS), part("neighbors", NEIGHBORS),
                      part("distances", DISTANCES), metadata)


def dataset_metadata(train: DataFrame, test: DataFrame, neighbors: DataFrame, metric: str) -> DataFrame:
    """One row: dimension, metric, sizes and neighbours per query."""
    sizes = train.agg(F.max(F.size("vector")).cast("long").alias("dimension"), F.count(F.lit(1)).alias("train_size"))
    tests = test.agg(F.count(F.lit(1)).alias("test_size"))
    depth = neighbors.agg(F.max(F.size("neighbors")).cast("long").alias("neighbors_k"))
    return sizes.select(
        "dimension", F.lit(metric).alias("metric_type"), "train_size", tests.scalar().alias("test_size"),
        depth.scalar().alias("neighbors_k"))


def write_ann_dataset(train: DataFrame, test: DataFrame, truth: DataFrame, folder: str, metric: str = "L2") -> None:
    """Write ``(id, vector)`` frames and ranked truth rows ``(qid, rank, id, score)``.

    Frames without ``id`` are numbered from 0 in their own order.
    """
    train = train if "id" in train.columns else number_rows(train, into="id")
    test = test if "id" in test.columns else number_rows(test, into="id")
    rows = truth.groupBy(F.col("qid").cast("long").alias("query_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("hits"))
    neighbors = rows.select("query_id", F.col("hits.id").cast("array<long>").alias("neighbors"))
    distances = rows.select("query_id", F.col("hits.score").cast("array<float>").alias("distances"))
    for name, df in (("train", train), ("test", test)):
        df.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<float>").alias("vector")).write.parquet(
            f"{folder}/{PARTS[name]}")
    neighbors.write.parquet(f"{folder}/{PARTS['neighbors']}")
    distances.write.parquet(f"{folder}/{PARTS['distances']}")
    dataset_metadata(train, test, neighbors, metric).coalesce(1).write.json(f"{folder}/{PARTS['metadata']}")


def _read_records(spark: SparkSession, path: str, dim: int, kind: str, element: T.DataType, column: str) -> DataFrame:
    width = 4 + 4 * dim
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField(column, T.ArrayType(element))])

    def joined(part: int, records: Iterator[bytes]):
        number = 0
        while run := list(itertools.islice(records, RECORDS_AT_ONCE)):
            yield part, number, len(run), bytearray(b"".join(run))
            number += len(run)

    raw = spark.sparkContext.binaryRecords(path, width).mapPartitionsWithIndex(joined).toDF("part int, number long, n int, records binary")
    sizes = raw.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row per file split
    raw = raw.join(F.broadcast(starts), "part").select((F.col("start") + F.col("number")).alias("first"), "records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, records in ((f, r) for batch in batches for f, r in zip(batch.column("first").to_pylist(), batch.column("records").to_pylist())):
            m = np.frombuffer(records, np.uint8).reshape(-1, width)
            head = np.ascontiguousarray(m[:, :4]).view("<i4").ravel()
            if (head != dim).any():
                raise ValueError(f"record of dimension {head[head != dim][0]}, expected {dim}")
            flat = np.ascontiguousarray(m[:, 4:]).view(kind).ravel()
            ends = pa.array(np.arange(0, len(flat) + 1, dim, dtype=np.int32))
            ids = pa.array(np.arange(first, first + len(m), dtype=np.int64))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(ends, pa.array(flat))], names=schema.names)

    return raw.mapInArrow(run, schema)


def read_fvecs(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Fixed-length records of an int32 dimension and ``dim`` float32 values: ``(id, vector)``."""
    return _read_records(spark, path, dim, "<f4", T.FloatType(), "vector")


def read_ivecs(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Fixed-length records of an int32 dimension and ``dim`` int32 values: ``(id, values)``."""
    return _read_records(spark, path, dim, "<i4", T.IntegerType(), "values")


def read_neighbors_json(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Lines of ``{query_id, group_id, neighbors, distances}`` as ranked rows; large files are split.

    A line may also hold an array of them. ``array`` reads files that are one array over several lines; each is one task.
    """
    rows = spark.read.schema(NEIGHBOR_ROWS).option("multiLine", array).option("mode", "FAILFAST").json(path)
    pairs = rows.select(F.col("query_id").alias("qid"), "group_id", F.posexplode(F.arrays_zip("neighbors", "distances")))
    return pairs.select("qid", "group_id", (F.col("pos") + 1).alias("rank"), F.col("col.neighbors").alias("id"),
                        F.col("col.distances").alias("distance"))
