"""Streams into tables: complete results, append-only deltas, and state carried between batches.

Every write goes to a folder named by the batch id and overwrites only that folder, so a batch
that is run again after a failure leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from nearfield.operators.tables import current_state, latest
from nearfield.session import scratch_path
from nearfield.streaming import stateful
from nearfield.streaming.windows import LATE, Measure


def table_stream(spark: SparkSession, folder: str, file_glob: str = "*.parquet", files_per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream, with the schema of what is there."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def _run(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _at(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def complete_table(result: DataFrame, path: str | None = None, then=None) -> DataFrame:
    """Run a streaming aggregate in complete mode over what has arrived; return the last full result.

    ``then`` transforms each batch result before it is written.
    """
    spark = result.sparkSession
    path = path or scratch_path(spark, "stream-table")
    done: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        (then(batch) if then else batch).write.mode("overwrite").parquet(_at(path, batch_id))
        done.append(batch_id)

    _run(result.writeStream.outputMode("complete").foreachBatch(write), f"{path}-checkpoint")
    if not done:
        empty = _empty(spark, result.schema)
        return then(empty) if then else empty
    return spark.read.parquet(_at(path, max(done)))


def append_table(result: DataFrame, path: str | None = None) -> DataFrame:
    """Run a stream in append mode: closed windows (or plain rows) only."""
    spark = result.sparkSession
    path = path or scratch_path(spark, "stream-append")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_at(path, batch_id))

    _run(result.writeStream.outputMode("append").foreachBatch(write), f"{path}-checkpoint")
    return _read_all(spark, path, result.schema)


def _read_all(spark: SparkSession, path: str, schema) -> DataFrame:
    from nearfield.sources.ann_dataset import path_exists

    if not path_exists(spark, path):
        return _empty(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*")


COMPACT_EVERY = 16  # batches whose deltas are merged into a new base


def _finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the finished folders ``name=<number>`` under a path, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [f.getPath().getName() for f in system.listStatus(root)]
    done = [n for n in names if n.startswith(f"{name}=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_change_state(spark: SparkSession, path: str, schema) -> DataFrame:
    """The last change of each key so far, in several versions at most: the newest finished base and the deltas behind it."""
    bases = _finished(spark, f"{path}/base", "upto")
    upto = bases[-1] if bases else -1
    parts = [f"{path}/base/upto={upto}"] * bool(bases) + [_at(path, b) for b in _finished(spark, path, "batch") if b > upto]
    return spark.read.schema(schema).parquet(*parts) if parts else _empty(spark, schema)


def compact_change_state(spark: SparkSession, path: str, schema, pk: str, seq: str, upto: int) -> None:
    """Merge base and deltas up to a batch into a new base, then remove what only older bases needed.

    A base counts once it is finished, so a compaction that failed changes nothing and is done again. The base before and its deltas stay for
    readers that have opened them. Deletes stay as changes, as an older change may still come.
    """
    before = _finished(spark, f"{path}/base", "upto")
    latest(read_change_state(spark, path, schema), pk, seq).write.mode("overwrite").parquet(f"{path}/base/upto={upto}")
    older = [b for b in before if b < upto]
    for b in older[:-1]:
        _remove(spark, f"{path}/base/upto={b}")
    for b in _finished(spark, path, "batch"):
        if older and b <= older[-1]:
            _remove(spark, _at(path, b))


def stream_current_state(changes: DataFrame, pk: str, seq: str = "seq", op: str = "op", path: str | None = None,
                         compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Live rows of a change-log stream.

    Each batch keeps the last change per key it saw, deletes included, and appends that delta; the
    deltas merge by sequence, so neither order of arrival nor a repeated batch matters. Every ``compact_every`` batches they become
    one base table, so that a read opens one base and fewer than twice that many deltas.
    """
    spark = changes.sparkSession
    path = path or scratch_path(spark, "stream-state")
    schema = changes.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch, pk, seq).write.mode("overwrite").parquet(_at(path, batch_id))
        if batch_id % compact_every == compact_every - 1:
            compact_change_state(spark, path, schema, pk, seq, batch_id)

    _run(changes.writeStream.outputMode("append").foreachBatch(write), f"{path}-checkpoint")
    return current_state(read_change_state(spark, path, schema), pk, seq, op)


def windowed_table(measure: Measure, log: DataFrame, path: str | None = None, late: str = LATE, with_open: bool = True) -> DataFrame:
    """Run a windowed measure in append mode over what has arrived; return its rows.

    The watermark closes windows: each is written once and leaves the state, which holds open windows only, however long the stream runs.
    ``with_open`` adds the open windows as they stand, read from the state beside the stream.
    """
    spark = log.sparkSession
    path = path or scratch_path(spark, "stream-windows")
    partial = measure.partial(log, late)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_at(path, batch_id))

    _run(partial.writeStream.outputMode("append").foreachBatch(write), f"{path}-checkpoint")
    rows = _read_all(spark, path, partial.schema).select(partial.columns)
    return measure.finish(rows.unionByName(open_windows(measure, spark, f"{path}-checkpoint", partial.schema)) if with_open else rows)


def open_windows(measure: Measure, spark: SparkSession, checkpoint: str, schema) -> DataFrame:
    """(start, end, keys, parts) of the windows that a stream's state holds."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    held, kept = state.schema["key"].dataType.names, state.schema["value"].dataType.names
    parts = list(measure.parts)
    if len(held) != 1 + len(measure.keys) or len(kept) != len(parts):
        raise ValueError(f"the state at {checkpoint} is not of this measure")
    keys = [F.col("key").getField(f).alias(n) for f, n in zip(held[1:], measure.keys)]
    window = F.col("key").getField(held[0])
    places = StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(parts, state.schema["value"].dataType.fields)])  # names repeat: two sums
    state = state.withColumn("value", F.col("value").cast(places))
    rows = state.select(window.start.alias("start"), window.end.alias("end"), *keys, *[F.col(f"value.{n}") for n in parts])
    return rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields])


def stream_latency_delta(log: DataFrame, path: str | None = None, slots: str = "10 minutes", late: str = LATE) -> DataFrame:
    """``|x_n - x_(n-1)|`` per user over a stream, in event-time order whatever the order of arrival.

    Rows wait in their user's state until the watermark (``late`` behind the latest row) has passed them, so a row in time finds its place between
    others; what is written is final. Rows that still wait are added as they stand. Rows later than the watermark are dropped.
    """
    spark = log.sparkSession
    path = path or scratch_path(spark, "stream-delta")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_at(path, batch_id))

    _run(stateful.ordered_deltas(log, late).writeStream.outputMode("append").foreachBatch(write), f"{path}-checkpoint")
    rows = _read_all(spark, path, stateful.DELTA).select("vu", "iter", "ts", "delta")
    return rows.unionByName(stateful.open_deltas(spark, f"{path}-checkpoint", slots))
