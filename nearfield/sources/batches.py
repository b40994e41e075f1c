"""Column-oriented insert batches: one row of equally long arrays per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def columns_to_rows(batches: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Explode batches into rows. Unequal lengths and empty batches are errors, never padded."""
    columns = list(columns or [c for c in batches.columns if c not in keep])
    if not columns:
        raise ValueError("a batch needs at least one column")
    first = F.size(F.coalesce(F.col(columns[0]), F.array()))
    equal = F.lit(True)
    for c in columns[1:]:
        equal = equal & (F.size(F.coalesce(F.col(c), F.array())) == first)
    checked = (F.when(first == 0, F.raise_error(F.lit("empty batch")).cast("boolean"))
               .when(~equal, F.raise_error(F.lit("columns of a batch differ in length")).cast("boolean")).otherwise(F.lit(True)))
    return batches.filter(checked).select(*keep, F.inline(F.arrays_zip(*columns)))


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, one column-oriented batch per line, as rows."""
    return columns_to_rows(spark.read.schema(schema).option("mode", "FAILFAST").json(path))
