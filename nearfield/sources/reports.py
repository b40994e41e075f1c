"""Run results as JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.operators.logs import run_summary

RESULT = ("struct<status:string, scenario:string, duration_seconds:double, metrics:map<string,double>, "
          "thresholds_passed:boolean, error_message:string, matrix_params:map<string,string>>")


def write_report(results: DataFrame, folder: str) -> None:
    """``results`` and the one-row ``summary`` as JSON folders."""
    results.write.json(f"{folder}/results")
    total = run_summary(results)
    rate = F.when(F.col("total") > 0, F.col("success") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
    total.withColumn("success_rate", rate).coalesce(1).write.json(f"{folder}/summary")


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All reports of a folder; a file holds ``{"results": [...]}`` or one result. Unreadable files are skipped."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    many = F.from_json("value", f"struct<results:array<{RESULT}>>").getField("results")
    one = F.from_json("value", RESULT)
    lone = F.when(one.getField("status").isNotNull(), F.array(one))
    # a results folder written by Spark holds one result per line
    lines = F.filter(F.transform(F.split("value", "\n"), lambda line: F.from_json(line, RESULT)),
                     lambda r: r.getField("status").isNotNull())
    picked = F.coalesce(many, F.when(F.size(lines) > 1, lines), lone)
    return files.select(picked.alias("r")).filter(F.col("r").isNotNull()).select(F.inline("r"))
