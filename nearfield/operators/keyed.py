"""Tables kept in buckets of their key, so that a small change set does not move the table.

A keyed table is a Parquet table in ``buckets`` buckets by hash of ``pk``. Joins and aggregates on ``pk`` read it where it lies: an
upsert sends the changed rows to the buckets, ``tables.current_state`` of a keyed change log and ``tables.diff`` of two keyed
versions with the same number of buckets have no exchange at all. Choose ``buckets`` so that a bucket is some hundred megabytes.
Versions are never overwritten: an upsert writes a new table.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.operators.tables import latest
from nearfield.session import scratch_path


class Keyed(NamedTuple):
    """A keyed table in the session's catalog."""

    name: str
    pk: str
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def _write(rows: DataFrame, to: Keyed, path: str | None = None) -> None:
    """Rows must lie in the partitions of the buckets already, so that a task writes one file of one bucket."""
    out = rows.write.format("parquet").bucketBy(to.buckets, to.pk).sortBy(to.pk)
    (out.mode("error").option("path", path) if path else out.mode("append")).saveAsTable(to.name)


def save_keyed(rows: DataFrame, pk: str, buckets: int, name: str | None = None, path: str | None = None) -> Keyed:
    """Write rows as a keyed table, one file per bucket. ``name`` and ``path`` must be new; the path defaults to the shared folder."""
    if buckets < 1:
        raise ValueError("a keyed table needs a bucket")
    to = Keyed(name or f"keyed_{uuid.uuid4().hex}", pk, buckets)
    _write(rows.repartition(buckets, pk), to, path or scratch_path(rows.sparkSession, to.name))
    return to


def append_keyed(table: Keyed, rows: DataFrame) -> None:
    """Add rows (of a change log, say) to the buckets; only the new rows move. Columns are matched by name."""
    columns = table.read(rows.sparkSession).columns
    _write(rows.select(*columns).repartition(table.buckets, table.pk), table)


def upsert_keyed(table: Keyed, rows: DataFrame, seq: str | None = None, name: str | None = None, path: str | None = None) -> Keyed:
    """A new version with rows replaced by key, else added; the semantics are those of ``tables.upsert``.

    Only ``rows`` are shuffled. Columns the rows lack keep the table's value, or are null in new rows. A null key equals none: such rows are added.
    """
    pk, spark = table.pk, rows.sparkSession
    base = table.read(spark)
    if seq is None:
        repeated = F.raise_error(F.lit("upsert needs seq: a key is repeated"))
        counted = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(pk)))
        last = counted.filter(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(True)).drop("__n")
    else:
        last = latest(rows, pk, seq)
    given = [c for c in base.columns if c in last.columns and c != pk]
    # a merge join keeps the table in its buckets; a broadcast of few rows would give up the layout of the result
    new = last.select(pk, F.struct(*given).alias("__r"), F.lit(True).alias("__new")).repartition(table.buckets, pk).hint("merge")
    value = {c: F.when(F.col("__new"), F.col("__r")[c]).otherwise(F.col(f"`{c}`")) if c in given else F.col(f"`{c}`") for c in base.columns}
    replaced = base.join(new, pk, "left").select(*[v.alias(c) for c, v in value.items()])
    fresh = new.join(base.select(pk).hint("merge"), pk, "left_anti")
    types = {f.name: f.dataType for f in base.schema.fields}
    added = fresh.select(*[(F.col(pk) if c == pk else F.col("__r")[c] if c in given else F.lit(None)).cast(types[c]).alias(c) for c in base.columns])
    to = Keyed(name or f"keyed_{uuid.uuid4().hex}", pk, table.buckets)
    _write(replaced, to, path or scratch_path(spark, to.name))
    _write(added, to)
    return to
