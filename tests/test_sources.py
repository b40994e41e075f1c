"""Readers, writers and fixtures."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from nearfield.operators import quality, search
from nearfield.sources import ann_dataset, batches, fixtures, points, reports


def test_ann_dataset_round_trip(spark, tmp_path):
    train = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(8)], "id long, vector array<float>")
    test = spark.createDataFrame([(0, [1.1, 0.0]), (1, [6.9, 0.0])], "id long, vector array<float>")
    truth = search.knn(train, test.withColumnRenamed("id", "qid"), 3, "l2")
    folder = str(tmp_path / "set")
    assert not ann_dataset.dataset_ready(spark, folder)
    ann_dataset.write_ann_dataset(train, test, truth, folder)
    assert ann_dataset.dataset_ready(spark, folder)
    data = ann_dataset.read_ann_dataset(spark, folder)
    assert {r["query_id"]: r["neighbors"] for r in data.neighbors.collect()} == {0: [1, 2, 0], 1: [7, 6, 5]}
    assert data.distances.filter("query_id = 0").first()["distances"] == pytest.approx([0.1, 0.9, 1.1], abs=1e-5)
    assert data.metadata.first().asDict() == {"dimension": 2, "metric_type": "L2", "train_size": 8, "test_size": 2, "neighbors_k": 3}
    assert quality.recall_at_k(truth, quality.truth_rows(data.neighbors), 3).agg(F.min("recall")).first()[0] == 1.0
    with pytest.raises(FileNotFoundError):
        ann_dataset.read_ann_dataset(spark, str(tmp_path / "none"))


def test_ids_are_positions_when_absent(spark, tmp_path):
    train = spark.createDataFrame([([float(i)],) for i in range(5)], "vector array<float>")
    truth = spark.createDataFrame([(0, 1, 4, 0.5)], "qid long, rank int, id long, score double")
    ann_dataset.write_ann_dataset(train, train, truth, str(tmp_path / "s"), "IP")
    got = ann_dataset.read_ann_dataset(spark, str(tmp_path / "s")).train
    assert sorted(r["id"] for r in got.collect()) == list(range(5))


def test_fvecs_and_ivecs(spark, tmp_path):
    vectors = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.5]]
    (tmp_path / "a.fvecs").write_bytes(b"".join(struct.pack("<i3f", 3, *v) for v in vectors))
    (tmp_path / "a.ivecs").write_bytes(b"".join(struct.pack("<i2i", 2, *v) for v in ([7, 8], [9, 1 << 20])))
    (tmp_path / "bad.fvecs").write_bytes(struct.pack("<i3f", 2, 1, 2, 3))
    rows = ann_dataset.read_fvecs(spark, str(tmp_path / "a.fvecs"), 3).orderBy("id").collect()
    assert [(r["id"], r["vector"]) for r in rows] == [(0, vectors[0]), (1, vectors[1])]
    rows = ann_dataset.read_ivecs(spark, str(tmp_path / "a.ivecs"), 2).orderBy("id").collect()
    assert [r["values"] for r in rows] == [[7, 8], [9, 1 << 20]]
    with pytest.raises(Exception, match="expected 3"):
        ann_dataset.read_fvecs(spark, str(tmp_path / "bad.fvecs"), 3).collect()


def test_neighbors_json(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps([{"query_id": 0, "group_id": 4, "neighbors": [7, 9], "distances": [0.0, 0.5]}]))
    rows = ann_dataset.read_neighbors_json(spark, str(tmp_path / "n.json"), array=True).orderBy("rank").collect()
    assert [(r["qid"], r["group_id"], r["rank"], r["id"], r["distance"]) for r in rows] == [(0, 4, 1, 7, 0.0), (0, 4, 2, 9, 0.5)]


def test_columns_to_rows(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"name":["a","b"],"score":[1.5,2.5]}\n{"name":["c"],"score":[3.5]}\n')
    schema = "name array<string>, score array<double>"
    assert sorted((r["name"], r["score"]) for r in batches.read_batches(spark, str(tmp_path / "b.json"), schema).collect()) == [
        ("a", 1.5), ("b", 2.5), ("c", 3.5)]
    for bad, message in (([(["a"], [1.0, 2.0])], "differ in length"), ([([], [])], "empty batch"), ([(None, [1.0])], "empty batch")):
        with pytest.raises(Exception, match=message):
            batches.columns_to_rows(spark.createDataFrame(bad, schema)).collect()


def test_points(spark, tmp_path):
    lines = ['{"type":"Point","metric":"m","data":{"time":"2024-01-01T00:00:01.5Z","value":2,"tags":{"op":"x"}}}',
             '{"type":"Metric","metric":"m","data":{"value":3}}', '{"type":"Point","metric":"m","data":{}}', '{"type":"Point","data":{"value":1}}',
             "{broken", "", '{"type":"Point","metric":"z","data":{"value":0}}']
    (tmp_path / "p.json").write_text("\n".join(lines))
    rows = points.read_points(spark, str(tmp_path / "p.json")).orderBy("metric").collect()
    assert [(r["metric"], r["value"], r["tags"]) for r in rows] == [("m", 2.0, {"op": "x"}), ("z", 0.0, None)]
    assert rows[0]["ts"].isoformat() == "2024-01-01T00:00:01.500000"


def test_summary_lines(spark):
    df = spark.createDataFrame([("   search_latency.........: avg=23.45ms min=900µs p(95)=1.2s",), ("checks: 100%",), ("rate..: avg=99.5% max=x",)], "value string")
    rows = {(r["metric"], r["stat"]): r["value"] for r in points.parse_summary_lines(df).collect()}
    assert rows == {("search_latency", "avg"): 23.45, ("search_latency", "min"): pytest.approx(0.9), ("search_latency", "p(95)"): 1200.0, ("rate", "avg"): 99.5}


def test_reports(spark, tmp_path):
    one = {"status": "success", "scenario": "s", "duration_seconds": 1.5, "metrics": {"p95": 3.0}, "thresholds_passed": True, "matrix_params": {"k": "1"}}
    (tmp_path / "a.json").write_text(json.dumps(one, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"results": [one, {**one, "status": "failed", "thresholds_passed": False}]}))
    (tmp_path / "c.json").write_text("not json")
    rows = reports.read_reports(spark, str(tmp_path))
    assert sorted(r["status"] for r in rows.collect()) == ["failed", "success", "success"]
    out = str(tmp_path / "out")
    reports.write_report(rows, out)
    assert spark.read.json(f"{out}/summary").first().asDict() == {
        "failed": 1, "success": 2, "success_rate": pytest.approx(200 / 3), "thresholds_passed": 2, "total": 3}
    assert reports.read_reports(spark, f"{out}/results").count() == 3


def test_groups_are_drawn_to_their_mean(spark):
    rows = spark.createDataFrame([(1, "a", [0.0, 0.0]), (2, "a", [4.0, 2.0]), (3, "b", [9.0, 9.0])], "id int, g string, v array<float>")
    got = {r["id"]: r["v"] for r in fixtures.tight_groups(rows, "g", "v", 0.5).collect()}
    assert got == {1: [1.0, 0.5], 2: [3.0, 1.5], 3: [9.0, 9.0]}
    docs = fixtures.struct_rows(rows, "g", "id", ["v"]).orderBy("g").collect()
    assert [[e["id"] for e in r["elements"]] for r in docs] == [[1, 2], [3]]


def test_neighbour_lines_are_all_read(spark, tmp_path):
    lines = [{"query_id": q, "group_id": 0, "neighbors": [q, 9], "distances": [0.0, 1.0]} for q in range(3)]
    (tmp_path / "l.json").write_text("\n".join(json.dumps(x) for x in lines))
    assert ann_dataset.read_neighbors_json(spark, str(tmp_path / "l.json")).count() == 6
