"""Data sets with known structure, derived from given tables: tight groups of vectors, and documents with struct elements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_means(rows: DataFrame, group: str, vector: str) -> DataFrame:
    """``(group, mean)``: the mean vector of every group; values are averaged per position, partly before the shuffle."""
    flat = rows.select(group, F.posexplode(vector).alias("__at", "__x"))
    means = flat.groupBy(group, "__at").agg(F.avg(F.col("__x").cast("double")).alias("__m"))
    listed = means.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__at", "__m"))).alias("__l"))  # one entry per dimension
    return listed.select(group, F.col("__l.__m").alias("mean"))


def tight_groups(rows: DataFrame, group: str, vector: str, keep: float = 0.25) -> DataFrame:
    """``rows`` with every vector drawn towards the mean of its group, to ``keep`` of its distance.

    The nearest neighbours of a row then lie in its own group, so recall and purity have known values.
    """
    means = group_means(rows, group, vector)
    drawn = F.zip_with(vector, "mean", lambda x, m: m + keep * (x.cast("double") - m))
    return rows.join(means, group).withColumn(vector, drawn).drop("mean")


def struct_rows(rows: DataFrame, key: str, order: str, fields: list[str], into: str = "elements") -> DataFrame:
    """One document per ``key`` with its rows as an ordered array of structs; as long as the key has rows."""
    part = F.struct(order, *fields)
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(part)).alias(into))
