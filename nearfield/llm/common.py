"""Helpers shared by the training-data operators: tables, words, row identity, components."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield import session
from nearfield.session import scratch_path

__all__ = ["add", "components", "discard", "grouped", "input_bytes", "materialize", "parts", "pieces", "prepare", "register",
           "release", "row_key", "star", "table"]

QUERIES: dict = {}
ORACLES: dict = {}

# Nodes (two numbers each, some 16 MB in all) up to which facts about nodes are broadcast; salts per node beyond.
BROADCAST_NODES, NODE_SALTS = 500_000, 8
# Text handled at once in a task, in bytes; a single longer text is a piece of its own.
PIECE_BYTES = 4 << 20


# Sizes from here on are the planner's way to say that it knows none; groups that a table is dealt into at most.
UNKNOWN_BYTES, MOST_PARTS = 1 << 53, 1 << 22
# Bytes of an Arrow batch that goes to a Python worker, so that rows with long texts or blocks come a few at a time.
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The library's session settings, and a bound on the bytes that a worker holds of its input."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return session.prepare(spark)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame that later jobs read to the shared folder, and read it back; a lost executor costs a re-read."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def discard(*stages: DataFrame) -> None:
    """Remove stage tables that nothing reads any more."""
    for stage in stages:
        path = stage.sparkSession._jvm.org.apache.hadoop.fs.Path(stage.stage_path)
        path.getFileSystem(stage.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def register(name: str, fn, sql: str | None = None) -> None:
    """Register ``fn(spark, sf_dir)``; ``sql`` is its DuckDB form where there is one."""
    QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
    if sql is not None:
        ORACLES[name] = sql


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished stages before the next large shuffle.

    Spark removes a shuffle once nothing refers to it, which the driver notices when it collects garbage; a driver with
    little to do may not for the length of a job. The second round takes what the first has made unreachable.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add(df: DataFrame, **new: Column) -> DataFrame:
    """Add columns; an input column of the same name (in any case) is replaced."""
    names = {n.lower() for n in new}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names], *[v.alias(k) for k, v in new.items()])


def input_bytes(df: DataFrame) -> int:
    """Stored size of a frame: that of its files, known without running it, or where the planner knows no size, its texts added up."""
    guess = session.estimated_bytes(df)
    if guess < UNKNOWN_BYTES:
        return max(1, guess)
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = reduce(lambda a, b: a + b, texts, F.lit(8 * len(df.columns)).cast("bigint"))
    return max(1, df.agg(F.sum(size)).first()[0] or 0)


def parts(df: DataFrame, each: int = 32 << 20) -> int:
    """Number of groups so that one group stands for about ``each`` bytes of stored input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_PARTS, max(least, -(-input_bytes(df) // each)))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Identity of a document row: its id together with its text, so that rows that share an id stay apart."""
    return F.sha2(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit(""))), 256)


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch into runs of rows whose texts (null: empty) make up at most ``size`` bytes."""
    if not batch.num_rows:
        return
    lengths = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = lengths[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(lengths, base + size, "right")))
        run = batch.slice(start, stop - start)
        yield run, [b"" if x is None else x for x in run[column].cast(pa.binary()).to_pylist()]
        start = stop


def per_node(rows: DataFrame, facts: DataFrame, key: str, spread: str, nodes: int) -> DataFrame:
    """Join with a frame of one row per node, of which there are at most ``nodes``: broadcast, or salted for hot nodes."""
    if nodes <= BROADCAST_NODES:
        return rows.join(F.broadcast(facts), key)
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(NODE_SALTS)))
    right = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(NODE_SALTS - 1).cast("bigint"))))
    return left.join(right, [key, "__salt"]).drop("__salt")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of an edge list (a, b): rows (node, component), the component being its least node.

    Each round links every node to the least node seen next to it and shortcuts twice as far (large and
    small stars), so a chain of n nodes takes about log n rounds. Each round is written to the shared
    folder; only two numbers per round come to the driver. Hot nodes are pre-aggregated by ``min``, and the
    joins on nodes are broadcasts of a counted size or salted.
    """
    both = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now, before = materialize(both, "components"), None
    size = now.count()
    for _ in range(rounds):
        # large star: every neighbour larger than a node is linked to the least of the neighbourhood
        around = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = per_node(around.where("b > a"), least, "a", "b", 2 * size).select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: every smaller neighbour and the node itself are linked to the least one
        down = large.select(F.col("b").alias("n"), F.col("a").alias("s"))
        low = down.groupBy("n").agg(F.min("s").alias("m"))
        small = per_node(down, low, "n", "s", size).select(F.col("m").alias("a"), F.col("s").alias("b")).union(
            low.select(F.col("m").alias("a"), F.col("n").alias("b")))
        now = materialize(small.where("a <> b").distinct(), "components")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before, size = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    label = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("m"))
    return nodes.join(label, "node", "left").select("node", F.coalesce("m", "node").alias("component"))


def grouped(batches, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows with equal integer keys from batches sorted by them; holds one group and one batch at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = np.column_stack([batch[k].to_numpy(zero_copy_only=False) for k in keys])
        starts = [0, *(np.flatnonzero((now[1:] != now[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        if held and tuple(held[-1][k][0].as_py() for k in keys) != tuple(now[0].tolist()):
            yield tuple(held[-1][k][0].as_py() for k in keys), pa.Table.from_batches(held)
            held = []
        for a, b in zip(starts[:-2], starts[1:-1]):
            yield tuple(now[a].tolist()), pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held.append(batch.slice(starts[-2]))
    if held:
        yield tuple(held[-1][k][0].as_py() for k in keys), pa.Table.from_batches(held)


def star(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Least member of the component of each of n points under the links p-q."""
    label = np.arange(n)
    while len(p):
        low = np.minimum(label[p], label[q])
        before = label.copy()
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        label = label[label]
        if (label == before).all():
            break
    return label
