"""Registered queries: a Spark callable and, where SQL can say the same, the SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its SQL equivalent."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def ranked(hits: DataFrame, *extra: str, qid: str = "qid", id: str = "vec_id") -> DataFrame:
    """Common result shape of a search."""
    return hits.select(F.col(qid), F.col("rank").cast("bigint").alias("rank"), F.col(id), *extra,
                       rounded("score").alias("score"))
