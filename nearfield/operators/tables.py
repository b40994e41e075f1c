"""Table writes as DataFrame transforms: upsert, delete, change log, snapshots, partitions.

Inputs are never overwritten in place: a transform gives the new content, the caller writes it to
a new folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.session import materialize, salt


def number_rows(df: DataFrame, order: str | None = None, into: str = "row_number") -> DataFrame:
    """Gap-free 0-based numbers, in the order of a column or of the partitions.

    Each partition numbers its own rows; the offsets come from one count per partition.
    """
    rows = df.repartitionByRange(order).sortWithinPartitions(order) if order else df
    marked = materialize(rows.withColumn("__m", F.monotonically_increasing_id()), "numbered")
    marked = marked.withColumn("__part", F.shiftright("__m", 33)).withColumn("__pos", F.col("__m") % F.lit(2**33))
    sizes = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    # one row per partition of the frame, a number Spark itself keeps on the driver
    numbered = marked.join(F.broadcast(offsets), "__part")
    return numbered.select(*df.columns, (F.col("__start") + F.col("__pos")).alias(into))


def insert_batches(rows: DataFrame, size: int, order: str) -> DataFrame:
    """``(batch, inserted)``: batch ``i`` holds ``min(size, total - i * size)`` rows."""
    if size < 1:
        raise ValueError("batch size must be positive")
    numbered = number_rows(rows.select(order), order)
    batch = F.floor(F.col("row_number") / size).alias("batch")
    return numbered.groupBy(batch).agg(F.count(F.lit(1)).alias("inserted"), F.min(order).alias("first_key"),
                                       F.max(order).alias("last_key"))


def insert(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows, matching columns by name; columns the rows lack become null."""
    extra = set(rows.columns) - set(table.columns)
    if extra:
        raise ValueError(f"unknown columns {sorted(extra)}")
    return table.unionByName(rows, allowMissingColumns=True)


def latest(rows: DataFrame, pk: str, seq: str) -> DataFrame:
    """The last row per key by sequence; partial maxima are formed before the shuffle.

    Rows of a key with equal ``seq`` are ordered by a hash of their columns (maps aside), so the choice is stable.
    """
    plain = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    best = F.max_by(F.struct(*rows.columns), F.struct(F.col(seq), F.xxhash64(*plain))).alias("r")
    return rows.groupBy(F.col(pk).alias("__pk")).agg(best).select("r.*")


def upsert(table: DataFrame, rows: DataFrame, pk: str, seq: str | None = None) -> DataFrame:
    """Replace rows by primary key, else add them; within ``rows`` the last by ``seq`` wins.

    Columns the rows lack keep the table's value.
    """
    if seq is None:
        # without an order no row of a repeated key is the last one: the run fails rather than choosing
        repeated = F.raise_error(F.lit("upsert needs seq: a key is repeated"))
        marked = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(pk)))
        last = marked.filter(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(True)).drop("__n")
    else:
        last = latest(rows, pk, seq)
    last = last.drop(seq) if seq and seq not in table.columns else last
    kept = table.join(last.select(pk), pk, "left_anti")
    absent = [c for c in table.columns if c not in last.columns]
    if absent:
        last = last.join(table.select(pk, *absent), pk, "left")
    return kept.unionByName(last.select(*table.columns))


def upsert_counts(table: DataFrame, rows: DataFrame, pk: str) -> DataFrame:
    """One row: distinct keys written, how many replaced and how many added."""
    keys = rows.select(pk).distinct().join(table.select(pk, F.lit(True).alias("__old")), pk, "left")
    return keys.agg(F.count(F.lit(1)).alias("upserted"), F.count_if(F.col("__old")).alias("replaced"),
                    F.count_if(F.col("__old").isNull()).alias("added"))


def _true(predicate: Column | str) -> Column:
    return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))


def delete(table: DataFrame, predicate: Column | str) -> DataFrame:
    """Remaining rows; a row whose predicate is null stays."""
    return table.filter(~_true(predicate))


def delete_count(table: DataFrame, predicate: Column | str) -> DataFrame:
    return table.agg(F.count_if(_true(predicate)).alias("deleted"), F.count_if(~_true(predicate)).alias("remaining"))


def current_state(changes: DataFrame, pk: str, seq: str = "seq", op: str = "op") -> DataFrame:
    """Live rows of an insert / upsert / delete log."""
    return latest(changes, pk, seq).filter(F.col(op) != "delete")


def as_of(changes: DataFrame, pk: str, at, ts: str = "ts", seq: str = "seq", op: str = "op") -> DataFrame:
    """Table content at a point in time."""
    return current_state(changes.filter(F.col(ts) <= F.lit(at)), pk, seq, op)


def create_snapshot(table: DataFrame, root: str, name: str, collection: str, description: str = "", partition: str | None = None) -> DataFrame:
    """Store the rows of a table under a name that is not taken yet; returns the stored table.

    Rows go to ``root/collection/name/rows``, one catalog row beside them, so that an unfinished snapshot is none.
    """
    if not name or not collection or "/" in name or "/" in collection:
        raise ValueError("a snapshot needs a name and a collection without slashes")
    spark, folder = table.sparkSession, f"{root}/{collection}/{name}"
    table.write.mode("error").parquet(f"{folder}/rows")
    counts = table.groupBy((F.col(partition).cast("string") if partition else F.lit("all")).alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"))
    counts.select(F.lit(name).alias("snapshot"), F.lit(description).alias("description"), F.lit(collection).alias("collection"), "partition", "n_rows",
                  F.current_timestamp().alias("ts")).write.mode("error").parquet(f"{folder}/catalog")
    return spark.read.schema(table.schema).parquet(f"{folder}/rows")


def open_snapshot(spark: SparkSession, root: str, name: str, collection: str) -> DataFrame:
    """Rows of a named snapshot; one without its catalog row was not finished and cannot be opened."""
    spark.read.parquet(f"{root}/{collection}/{name}/catalog")
    return spark.read.parquet(f"{root}/{collection}/{name}/rows")


def stored_snapshots(spark: SparkSession, root: str, collection: str = "*") -> DataFrame:
    """Catalog rows of the stored snapshots: name, description, collection, partition, rows and time."""
    return spark.read.parquet(f"{root}/{collection}/*/catalog")


def restore_snapshot(spark: SparkSession, root: str, name: str, collection: str, target: str) -> DataFrame:
    """Write a named snapshot to a new folder and return the restored table."""
    rows = open_snapshot(spark, root, name, collection)
    rows.write.mode("error").parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


def snapshot_catalog(snapshots: DataFrame, collection: str | None = None) -> DataFrame:
    """Describe stored snapshots: ``(snapshot, description, collection, partition)`` rows with ``ts``."""
    rows = snapshots if collection is None else snapshots.filter(F.col("collection") == collection)
    return rows.groupBy("snapshot", "description", "collection").agg(
        F.min("ts").alias("created"), F.array_sort(F.collect_set("partition")).alias("partitions"),
        F.count(F.lit(1)).alias("n_rows"))


def restore(changes: DataFrame, pk: str, at, target: str, **options) -> DataFrame:
    """Write the as-of rows to a new folder and return the restored table."""
    rows = as_of(changes, pk, at, **options)
    rows.write.mode("error").parquet(target)
    return changes.sparkSession.read.schema(rows.schema).parquet(target)


def diff(before: DataFrame, after: DataFrame, pk: str) -> DataFrame:
    """Keys that were added, removed or changed between two versions."""
    columns = [c for c in before.columns if c != pk]
    a = before.select(pk, F.struct(*columns).alias("__a"), F.lit(True).alias("__in_a"))
    b = after.select(pk, F.struct(*columns).alias("__b"), F.lit(True).alias("__in_b"))
    change = (F.when(F.col("__in_a").isNull(), "added").when(F.col("__in_b").isNull(), "removed")
              .when(~F.col("__a").eqNullSafe(F.col("__b")), "changed"))
    return a.join(b, pk, "full_outer").select(pk, change.alias("change")).filter(F.col("change").isNotNull())


def growth(log: DataFrame, ts: str = "ts", rows: str = "rows", every: str = "1 minute") -> DataFrame:
    """Cumulative inserted rows; summed per interval first, so the running sum sees intervals, not rows."""
    parts = log.groupBy(F.window(ts, every).start.alias("start")).agg(F.sum(rows).alias("inserted"))
    running = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return parts.withColumn("total", F.sum("inserted").over(running))


def partition_stats(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def drop_partition(df: DataFrame, column: str, value) -> DataFrame:
    """Everything outside one partition, null partitions included."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def has_partition(df: DataFrame, column: str, value) -> bool:
    return not df.filter(F.col(column).eqNullSafe(F.lit(value))).select(column).limit(1).isEmpty()


def drop_stored_partition(spark: SparkSession, path: str, column: str, value) -> bool:
    """Remove one partition folder of a stored table; no other data is read or rewritten.

    The folder is one of those that the table has, found under the name Spark stores the value by
    (escaped; null has a name of its own), so no value can reach outside the table.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = names.getPartitionPathString(column, None if value is None else str(value))
    for status in files.listStatus(root) if files.exists(root) else ():
        if status.isDirectory() and status.getPath().getName() == name:
            return files.delete(status.getPath(), True)
    return False


def shard_balance(df: DataFrame, pk: str, shards: int) -> DataFrame:
    """Rows per hash shard and the largest share relative to an even split."""
    counts = df.groupBy(salt(F.col(pk), buckets=shards).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))
    whole = Window.partitionBy(F.lit(1))
    return counts.withColumn("skew", F.max("n_rows").over(whole) * F.lit(shards) / F.sum("n_rows").over(whole))
