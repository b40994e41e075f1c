"""Tables in buckets of their key: the results of the plain transforms, without a shuffle of the table."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from nearfield.operators import keyed, tables


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_gives_the_rows_of_the_plain_form(spark, tmp_path):
    table = spark.range(200).select("id", F.concat(F.lit("v"), "id").alias("v"), (F.col("id") * 2).alias("n"))
    rows = spark.createDataFrame([(3, "a", 1), (3, "b", 2), (500, "c", 1), (7, None, 1)], "id bigint, v string, seq int")
    stored = keyed.save_keyed(table, "id", 5, path=str(tmp_path / "one"))
    done = keyed.upsert_keyed(stored, rows, "seq", path=str(tmp_path / "two"))
    assert rows_of(done.read(spark).fillna("-")) == rows_of(tables.upsert(table, rows, "id", "seq").fillna("-"))
    assert len(glob.glob(str(tmp_path / "one" / "*.parquet"))) == 5 and len(glob.glob(str(tmp_path / "two" / "*.parquet"))) <= 10
    assert rows_of(stored.read(spark)) == rows_of(table)
    again = keyed.upsert_keyed(done, rows.filter("id = 500").drop("seq"))
    assert again.read(spark).count() == 201
    with pytest.raises(Exception, match="needs seq"):
        keyed.upsert_keyed(done, rows.drop("seq"))


def test_empty_tables_and_null_keys(spark):
    empty = keyed.save_keyed(spark.createDataFrame([], "id int, v string"), "id", 2)
    done = keyed.upsert_keyed(empty, spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string"))
    assert sorted(r["v"] for r in done.read(spark).collect()) == ["a", "b"]
    assert rows_of(keyed.upsert_keyed(done, spark.createDataFrame([], "id int, v string")).read(spark).na.drop()) == [(1, "a")]


def test_state_and_diff_have_no_exchange(spark, plan):
    log = spark.range(300).select((F.col("id") % 100).alias("id"), F.col("id").alias("seq"), F.when(F.col("id") % 7 == 0, "delete").otherwise("upsert").alias("op"))
    stored = keyed.save_keyed(log.filter("seq < 200"), "id", 6)
    keyed.append_keyed(stored, log.filter("seq >= 200"))
    state = tables.current_state(stored.read(spark), "id")
    assert rows_of(state) == rows_of(tables.current_state(log, "id")) and "Exchange" not in plan(state)
    other = keyed.save_keyed(log.filter("seq < 250 AND seq >= 150"), "id", 6)
    change = tables.diff(keyed.save_keyed(state, "id", 6).read(spark), other.read(spark), "id")
    assert change.count() and "Exchange" not in plan(change)


def test_only_changed_rows_are_shuffled(spark, plan, monkeypatch):
    stored = keyed.save_keyed(spark.range(1000).withColumn("v", F.lit("x")), "id", 6)
    plans, write = [], keyed._write

    def seen(rows, to, path=None):
        plans.append(plan(rows))
        write(rows, to, path)

    monkeypatch.setattr(keyed, "_write", seen)
    keyed.upsert_keyed(stored, spark.createDataFrame([(1, "y"), (-1, "z")], "id bigint, v string"))
    assert len(plans) == 2
    for text in plans:
        below = re.split(r"FileScan", text)
        # the table's scan comes with its buckets, and no exchange stands between it and the join
        assert "Bucketed: true" in text and len(below) == 2
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        lines = text.splitlines()
        at = next(i for i, line in enumerate(lines) if "FileScan" in line)
        above, level = [], depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        assert not any("Exchange" in line for line in above)
