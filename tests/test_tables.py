"""Writes, change log, snapshots and schemas."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nearfield.operators import schema, tables


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_numbering_and_batches(spark, parts):
    df = spark.range(100, 123).repartition(parts)
    got = rows_of(tables.number_rows(df, "id"), "row_number", "id")
    assert got == [(i, 100 + i) for i in range(23)]
    batches = rows_of(tables.insert_batches(df, 10, "id"), "batch", "inserted", "first_key")
    assert batches == [(0, 10, 100), (1, 10, 110), (2, 3, 120)]
    assert sorted(r["row_number"] for r in tables.number_rows(df).collect()) == list(range(23))


def test_insert(spark):
    a = spark.createDataFrame([(1, "x")], "id long, v string")
    assert rows_of(tables.insert(a, spark.createDataFrame([(2,)], "id long")).filter("id = 2"), "id", "v") == [(2, None)]
    with pytest.raises(ValueError):
        tables.insert(a, spark.createDataFrame([(2, 3)], "id long, w long"))


def test_upsert(spark):
    table = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id long, v string, n long")
    rows = spark.createDataFrame([(2, "c", 21, 1), (2, "d", 22, 2), (3, "e", 30, 1)], "id long, v string, n long, seq int")
    assert rows_of(tables.upsert(table, rows, "id", "seq"), "id", "v", "n") == [(1, "a", 10), (2, "d", 22), (3, "e", 30)]
    part = spark.createDataFrame([(1, "z"), (4, "y")], "id long, v string")
    assert set(rows_of(tables.upsert(table, part, "id").filter("id <> 4"), "id", "v", "n")) == {(1, "z", 10), (2, "b", 20)}
    counts = tables.upsert_counts(table, rows, "id").first()
    assert (counts["upserted"], counts["replaced"], counts["added"]) == (2, 1, 1)


def test_delete_keeps_null_predicates(spark):
    table = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id long, price long")
    assert rows_of(tables.delete(table, F.col("price") < 20), "id") == [(2,), (3,)]
    assert tuple(tables.delete_count(table, "price < 20").first()) == (1, 2)


@pytest.fixture(scope="module")
def log(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, "insert", 0, "a", day(1)), (2, "insert", 1, "b", day(1)), (1, "upsert", 2, "a2", day(3)), (2, "delete", 3, None, day(4)),
            (3, "insert", 4, "c", day(5)), (2, "insert", 5, "b2", day(6))]
    return spark.createDataFrame(rows, "id long, op string, seq long, v string, ts timestamp")


def test_states_and_snapshots(spark, log, tmp_path):
    assert rows_of(tables.current_state(log, "id"), "id", "v") == [(1, "a2"), (2, "b2"), (3, "c")]
    at = F.lit("2024-01-04").cast("timestamp")
    assert rows_of(tables.as_of(log, "id", at), "id", "v") == [(1, "a2")]
    before = tables.as_of(log, "id", F.lit("2024-01-02").cast("timestamp")).select("id", "v")
    now = tables.current_state(log, "id").select("id", "v")
    assert rows_of(tables.diff(before, now, "id"), "id", "change") == [(1, "changed"), (2, "changed"), (3, "added")]
    assert rows_of(tables.diff(now, before.filter("id = 1"), "id"), "id", "change") == [(1, "changed"), (2, "removed"), (3, "removed")]
    restored = tables.restore(log, "id", at, str(tmp_path / "r"))
    assert tables.diff(restored, tables.as_of(log, "id", at), "id").count() == 0
    with pytest.raises(Exception):
        tables.restore(log, "id", at, str(tmp_path / "r"))


def test_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, p string")
    assert rows_of(tables.drop_partition(df, "p", "a"), "id") == [(2,), (3,)]
    assert tables.has_partition(df, "p", "b") and not tables.has_partition(df, "p", "z")
    path = str(tmp_path / "t")
    df.filter("p is not null").write.partitionBy("p").parquet(path)
    assert tables.drop_stored_partition(spark, path, "p", "a")
    assert rows_of(spark.read.parquet(path), "id") == [(2,)]
    shards = tables.shard_balance(spark.range(1000), "id", 4).collect()
    assert sum(r["n_rows"] for r in shards) == 1000 and 1 <= shards[0]["skew"] < 1.5


def test_growth_and_catalog(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(ts, 5), (ts, 5), (ts + dt.timedelta(minutes=2), 1)], "ts timestamp, rows long")
    assert [r["total"] for r in tables.growth(df).orderBy("start").collect()] == [10, 11]
    snaps = spark.createDataFrame([("s", "d", "c", "p1", ts), ("s", "d", "c", "p0", ts), ("t", "d", "other", "p", ts)],
                                  "snapshot string, description string, collection string, partition string, ts timestamp")
    row = tables.snapshot_catalog(snaps, "c").collect()
    assert len(row) == 1 and row[0]["partitions"] == ["p0", "p1"] and row[0]["n_rows"] == 2


SPEC = {"name": "c", "fields": [
    {"name": "id", "dataType": "Int64", "isPrimaryKey": True},
    {"name": "title", "dataType": "VarChar", "maxLength": 3, "nullable": True},
    {"name": "vec", "dataType": "FloatVector", "dimension": 2},
    {"name": "tags", "dataType": "Array", "elementType": "VarChar", "maxCapacity": 2, "nullable": True},
    {"name": "parts", "dataType": "Array", "elementType": "Struct", "nullable": True, "structFields": [
        {"name": "n", "dataType": "Int32"}, {"name": "emb", "dataType": "FloatVector", "dimension": 2}]},
]}


def test_spec_errors():
    def spec(**field):
        return schema.CollectionSpec.from_dict({"name": "c", "fields": [{"name": "f", **field}]})

    for bad in ({}, {"dataType": ""}, {"dataType": "Weird"}, {"dataType": "Array"}, {"dataType": "Array", "elementType": "JSON"},
                {"dataType": "Array", "elementType": "Struct"},
                {"dataType": "Array", "elementType": "Struct", "structFields": [{"name": "x", "dataType": "Int8"}]}):
        with pytest.raises(ValueError):
            spec(**bad)
    with pytest.raises(ValueError):
        schema.CollectionSpec.from_dict({"name": "c", "fields": []})
    field = schema.CollectionSpec.from_json('{"name":"c","numShards":2,"fields":[{"name":"v","dataType":"VarChar","maxLength":9,"enableMatch":true}]}').schema()["v"]
    assert field.metadata == {"maxLength": 9, "enableMatch": True} and not field.nullable


def test_conform_validate_profile(spark):
    rows = [(1, "abc", [1.0, 2.0], ["x"], '[{"n":1,"emb":[1,2]},{"n":"bad","emb":[1,2]}]'), (1, "long", [1.0], ["x", "y", "z"], None),
            (None, None, [float("nan"), 0.0], None, '[{"n":2,"emb":[1]}]')]
    raw = spark.createDataFrame(rows, "id long, title string, vec array<double>, tags array<string>, parts string")
    df = schema.conform(raw.withColumn("parts", F.parse_json("parts")).withColumn("id", F.col("id").cast("string")), SPEC)
    first = df.filter("title = 'abc'").first()
    assert first["id"] == 1 and first["vec"] == [1.0, 2.0] and [(p["n"], p["emb"]) for p in first["parts"]] == [(1, [1.0, 2.0]), (None, [1.0, 2.0])]
    spec = schema.CollectionSpec.from_dict(SPEC)
    counts = {(r["field"], r["rule"]): r["violations"] for r in schema.validate(df, spec).collect() if r["violations"]}
    assert counts == {("id", "null"): 1, ("title", "max_length"): 1, ("vec", "dimension"): 1, ("vec", "not_finite"): 1,
                      ("tags", "max_capacity"): 1, ("parts.emb", "dimension"): 1, ("id", "duplicate_key"): 1}
    broken = {r["title"]: r["broken"] for r in schema.bad_rows(df, spec).collect()}
    assert broken["long"] == ["title:max_length", "vec:dimension", "tags:max_capacity"] and "abc" not in broken
    profile = {r["field"]: r for r in schema.profile(df, spec).collect()}
    assert (profile["vec"]["min_size"], profile["vec"]["max_size"], profile["id"]["nulls"], profile["id"]["approx_distinct"]) == (1, 2, 1, 1)
    with pytest.raises(ValueError, match="missing"):
        schema.conform(raw.drop("vec"), SPEC)


def test_auto_id_and_flatten(spark):
    df = spark.createDataFrame([((1, (2, 3)), 4)], "a struct<x:int,b:struct<y:int,z:int>>, c int")
    assert schema.flatten_struct(df).columns == ["a_x", "a_b_y", "a_b_z", "c"]
    assert schema.flatten_struct(df, ".").columns[1] == "a.b.y"
    wide = spark.range(50).repartition(4).select(F.col("id").alias("v"))
    assert schema.with_auto_id(wide).select("id").distinct().count() == 50
    assert sorted(r["id"] for r in schema.with_auto_id(wide, dense=True).collect()) == list(range(50))
    spec = {"name": "c", "fields": [{"name": "id", "dataType": "Int64", "isPrimaryKey": True, "isAutoID": True}, {"name": "v", "dataType": "Int64"}]}
    assert schema.conform(wide, spec).columns == ["id", "v"]


CASES = [
    ("id", ["1", "2"], "Int64"), ("id", ["1", "2.5"], "Float"), ("n", ["1", "2"], "Float"), ("n", ["1", "2.5"], "Float"),
    ("s", ['"a"', '"b"'], "VarChar"), ("b", ["true", "false"], "Bool"), ("o", ['{"a":1}', '{"b":2}'], "JSON"),
    ("sp", ['{"1":0.5}', '{"10":2}'], "SparseFloatVector"), ("mix", ['{"1":0.5}', '{"x":2}'], "JSON"),
    ("v", ["[1,2]", "[3,4]"], "FloatVector"), ("v", ["[0.5]", "[1.5]"], "FloatVector"), ("a", ["[1]", "[2]"], "Array<Int64>"),
    ("a", ["[1,2]", "[3]"], "Array<Int64>"), ("a", ["[1.5,2]", "[3]"], "Array<Float>"), ("a", ['["x"]', '["y","z"]'], "Array<VarChar>"),
    ("a", ["[true]", "[false,true]"], "Array<Bool>"), ("st", ['[{"a":1}]', '[{"a":2},{"a":3}]'], "Array<Struct>"),
    ("odd", ["1", '"a"'], "JSON"), ("none", [None, None], None), ("late", [None, '"a"'], "VarChar"),
]


def test_kind_inference(spark):
    for width in range(0, len(CASES), 7):
        part = CASES[width : width + 7]
        names = [f"c{i}" if n != "id" else "id" for i, (n, _, _) in enumerate(part)]
        seen = {}
        for name, case in zip(names, part):
            seen.setdefault(name, case)
        cols = list(seen)
        df = spark.createDataFrame([tuple(seen[c][1][r] for c in cols) for r in range(2)], ", ".join(f"{c} string" for c in cols))
        got = {r["field"]: r["kind"] for r in schema.infer_column_kinds(df).collect()}
        assert got == {c: seen[c][2] for c in cols}


def test_whole_numbers_named_id(spark):
    df = spark.createDataFrame([("1",), ("2.5",)], "id string")
    assert schema.infer_column_kinds(df).first()["kind"] == "Float"


def test_stored_partitions_are_found_by_value_and_never_outside(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a/b"), (2, None), (3, "c"), (4, "x y")]
    spark.createDataFrame(rows, "id int, p string").write.partitionBy("p").parquet(path)
    victim = tmp_path / "victim"
    victim.mkdir()
    assert not tables.drop_stored_partition(spark, path, "p", "c/../../victim") and victim.exists()
    assert tables.drop_stored_partition(spark, path, "p", "a/b") and tables.drop_stored_partition(spark, path, "p", None)
    assert {r["id"] for r in spark.read.parquet(path).collect()} == {3, 4}
    assert not tables.drop_stored_partition(spark, path, "p", "a/b") and not tables.drop_stored_partition(spark, str(tmp_path / "none"), "p", "c")


def test_upsert_without_order_refuses_repeated_keys(spark):
    table = spark.createDataFrame([(1, "a")], "id int, v string")
    assert tables.upsert(table, spark.createDataFrame([(1, "b")], "id int, v string"), "id").collect() == [(1, "b")]
    with pytest.raises(Exception, match="repeated"):
        tables.upsert(table, spark.createDataFrame([(1, "b"), (1, "c")], "id int, v string"), "id").collect()


def test_named_snapshots(spark, tmp_path):
    root, rows = str(tmp_path / "s"), spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert tables.create_snapshot(rows, root, "first", "items", "before the change", "v").count() == 2
    tables.create_snapshot(rows.filter("id = 1"), root, "second", "items")
    assert tables.open_snapshot(spark, root, "second", "items").count() == 1
    catalog = {(r["snapshot"], r["partition"]): r["n_rows"] for r in tables.stored_snapshots(spark, root, "items").collect()}
    assert catalog == {("first", "a"): 1, ("first", "b"): 1, ("second", "all"): 1}
    assert sorted(tables.restore_snapshot(spark, root, "first", "items", str(tmp_path / "back")).collect()) == sorted(rows.collect())
    with pytest.raises(Exception):
        tables.create_snapshot(rows, root, "first", "items")
    with pytest.raises(ValueError):
        tables.create_snapshot(rows, root, "../x", "items")


def test_declared_functions_are_applied(spark):
    spec = {"name": "c", "fields": [{"name": "id", "dataType": "Int64", "isPrimaryKey": True}, {"name": "t", "dataType": "VarChar"},
                                    {"name": "sparse", "dataType": "SparseFloatVector"}, {"name": "dense", "dataType": "FloatVector", "dimension": 16}],
            "functions": [{"name": "f", "functionType": "BM25", "inputFieldNames": ["t"], "outputFieldNames": ["sparse"]},
                          {"name": "g", "functionType": "TextEmbedding", "inputFieldNames": ["t"], "outputFieldNames": ["dense"]}]}
    df = spark.createDataFrame([(1, "red apple"), (2, "red car"), (3, None)], "id long, t string")
    rows = {r["id"]: r for r in schema.conform(df, spec).collect()}
    assert len(rows[1]["sparse"]) == 2 and rows[3]["sparse"] == {} and len(rows[2]["dense"]) == 16
    spec["functions"][0]["functionType"] = "Rerank"
    with pytest.raises(ValueError, match="unsupported function type"):
        schema.conform(df, spec)
