"""Load-test output: metric points as JSON lines, and end-of-run summary lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINT = ("struct<type:string, metric:string, data:struct<time:string, value:double, tags:map<string,string>>>")


def parse_points(lines: DataFrame) -> DataFrame:
    """``(ts, metric, value, tags)`` from text lines; other types and malformed lines are skipped."""
    p = F.from_json("value", POINT)
    rows = lines.select(p.alias("p")).filter(
        (F.col("p.type") == "Point") & F.col("p.metric").isNotNull() & (F.col("p.metric") != "") & F.col("p.data.value").isNotNull())
    return rows.select(F.try_to_timestamp("p.data.time").alias("ts"), F.col("p.metric").alias("metric"),
                       F.col("p.data.value").alias("value"), F.col("p.data.tags").alias("tags"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return parse_points(spark.read.text(path))


def stream_points(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """The same log as a stream of arriving files."""
    return parse_points(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder))


def milliseconds(text: Column) -> Column:
    """A duration with unit in milliseconds; percentages and plain numbers keep their value."""
    number = F.regexp_extract(text, r"^(-?[0-9.]+)", 1).try_cast("double")
    unit = F.regexp_extract(text, r"^-?[0-9.]+(.*)$", 1)
    factor = F.when(unit == "s", 1000.0).when(unit.isin("µs", "us"), 0.001).when(unit == "m", 60000.0).when(unit == "h", 3600000.0)
    return number * F.coalesce(factor, F.lit(1.0))


def parse_summary_lines(lines: DataFrame) -> DataFrame:
    """``(metric, stat, value)`` from lines such as ``search......: avg=23.4ms p(95)=1.2s``."""
    line = F.trim("value")
    wanted = lines.filter(F.col("value").contains("avg=") | F.col("value").contains("p(95)="))
    metric = F.regexp_extract(line, r"^([^\s.:]+(?:\.[^\s.:]+)*)", 1)
    pairs = F.explode(F.regexp_extract_all(line, F.lit(r"(\S+=\S+)"), F.lit(1)))
    rows = wanted.select(metric.alias("metric"), pairs.alias("pair"))
    parsed = rows.select("metric", F.split_part("pair", F.lit("="), F.lit(1)).alias("stat"),
                         milliseconds(F.split_part("pair", F.lit("="), F.lit(2))).alias("value"))
    return parsed.filter(F.col("value").isNotNull())


def read_summary_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_summary_lines(spark.read.text(path))
