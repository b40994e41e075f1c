"""Stored cell indexes: what is read, that every way gives the exact rows, and the model after reopening."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfield.functions import vectors as V
from nearfield.operators import blocks, cells, indexes, quality, search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 0.6, (120, 16)) for c in rng.normal(0, 4, (5, 16))] + [np.full((20, 16), 0.25)])
    rows = [(i, v.tolist(), i % 4) for i, v in enumerate(points)] + [(9000, None, 0)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, label int").repartition(5)
    asked = spark.createDataFrame([(i, (points[i * 7] + 0.1).tolist()) for i in range(40)], "qid long, vector array<double>")
    return df, asked


def rows(df):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())


@pytest.fixture(scope="module")
def flat(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "flat")
    indexes.build_index(data[0], path, nlist=8, attributes=["label"])
    return indexes.open_index(spark, path)


def test_search_reads_probed_cells_only_and_does_not_shuffle_the_index(spark, data, flat, plan):
    one = data[1].limit(1)
    text = plan(indexes.search_index(flat, one, 5, 2))
    assert "PartitionFilters: [cell" in text and text.count("Exchange hashpartitioning(qid") == text.count("Exchange") == 1
    assert "ReadSchema: struct<id:bigint,vector:array<double>>" in text


def test_all_cells_are_exact(data, flat):
    want = rows(search.knn(*data, 10, "l2"))
    assert rows(indexes.search_index(flat, data[1], 10, 8)) == want
    assert rows(indexes.search_index(flat, data[1], 10, 8, filter=F.col("label") == 1)) == rows(search.knn(*data, 10, "l2", filter=F.col("label") == 1))


@pytest.mark.parametrize("kind,options,refine", [("flat", {}, 1), ("sq8", {}, 6), ("pq", {"m": 4, "nbits": 5}, 50)])
@pytest.mark.parametrize("metric", ["l2", "cosine", "ip"])
def test_kinds_give_exact_rows_with_a_wide_short_list(spark, data, tmp_path, kind, options, refine, metric):
    indexes.build_index(data[0], str(tmp_path / "i"), kind, nlist=6, metric=metric, **options)
    index = indexes.open_index(spark, str(tmp_path / "i"))
    assert rows(indexes.search_index(index, data[1], 10, 6, refine=refine)) == rows(search.knn(*data, 10, metric))
    narrow = indexes.search_index(index, data[1], 10, 2, refine=-(-refine // 5))
    assert quality.recall_at_k(narrow, search.knn(*data, 10, metric), 10).agg(F.avg("recall")).first()[0] > 0.5


def test_large_query_sides_are_joined_to_the_same_rows(data, flat, monkeypatch):
    few, settings = rows(indexes.search_index(flat, data[1], 10, 3)), indexes.search_settings(flat, data[1], 4, [1, 3]).collect()
    monkeypatch.setattr(indexes, "PROBE_PAIRS", 0)
    assert rows(indexes.search_index(flat, data[1], 10, 3)) == few
    assert sorted(map(tuple, indexes.search_settings(flat, data[1], 4, [1, 3]).collect())) == sorted(map(tuple, settings))


def test_settings_equal_single_searches(data, flat):
    found = indexes.search_settings(flat, data[1], 6, [1, 2, 8])
    for n in (1, 2, 8):
        assert rows(found.filter(F.col("nprobe") == n)) == rows(indexes.search_index(flat, data[1], 6, n))
    truth = search.knn(*data, 6, "l2")
    got = {r["nprobe"]: r for r in indexes.settings_recall(flat, data[1], truth, 6, [1, 2, 8]).collect()}
    assert got[8]["avg_recall"] == 1.0 and got[1]["avg_recall"] <= got[2]["avg_recall"] <= 1.0 and got[1]["n"] == 40


def test_binary_cells(spark, data, tmp_path):
    base = V.binarize_vectors(data[0].filter("vector is not null"), "vector").select("id", "bits")
    asked = V.binarize_vectors(data[1], "vector").select("qid", "bits")
    for metric in ("hamming", "jaccard"):
        index = indexes.build_index(base, str(tmp_path / metric), "binary", nlist=4, metric=metric)
        assert rows(indexes.search_index(index, asked, 7, 4)) == rows(search.knn(base, asked, 7, metric, vector="bits"))


def test_appended_rows_are_found(spark, data, tmp_path):
    df, asked = data
    index = indexes.build_index(df.filter("id % 3 <> 0"), str(tmp_path / "i"), "sq8", nlist=5, attributes=["label"])
    indexes.append_rows(index, df.filter("id % 3 = 0"))
    again = indexes.open_index(spark, str(tmp_path / "i"))
    assert rows(indexes.search_index(again, asked, 5, 5, refine=8)) == rows(search.knn(df, asked, 5, "l2"))
    assert indexes.cell_stats(again).agg(F.sum("n")).first()[0] == df.filter("vector is not null").count()


def test_unfinished_and_wrong_builds(spark, data, tmp_path):
    index = indexes.build_index(data[0], str(tmp_path / "i"), nlist=3)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        indexes.build_index(data[0], str(tmp_path / "i"), nlist=3)
    index.rows.write.parquet(str(tmp_path / "half" / "rows"))
    with pytest.raises(FileNotFoundError):
        indexes.open_index(spark, str(tmp_path / "half"))
    with pytest.raises(ValueError):
        indexes.build_index(data[0], str(tmp_path / "x"), "tree")
    assert rows(indexes.search_index(index, data[1].limit(0), 5, 3)) == []


def test_books_are_fitted_together(spark, data):
    books = cells.pq_books(data[0].filter("vector is not null"), 16, 4, 4, "id")
    assert [b.shape for b in books] == [(16, 4)] * 4
    mat = np.array([r[0] for r in data[0].filter("vector is not null").select("vector").collect()])
    codes = cells.product_codes(mat, books)
    back = np.concatenate([b[codes[:, i]] for i, b in enumerate(books)], 1)
    assert np.square(mat - back).sum() < 0.2 * np.square(mat - mat.mean(0)).sum()


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
def test_large_query_sides_of_codes_are_scored_where_the_cells_pass(spark, data, tmp_path, monkeypatch, metric):
    """A task gives each query its short list once, with exact costs; no hit is joined with vectors."""
    indexes.build_index(data[0], f"{tmp_path}/i", "sq8", nlist=8, metric=metric)
    index = indexes.open_index(spark, f"{tmp_path}/i")
    few, whole = (rows(indexes.search_index(index, data[1], 5, n, refine=3)) for n in (6, 8))
    monkeypatch.setattr(indexes, "PROBE_PAIRS", 0)
    monkeypatch.setattr(blocks, "GRID_TASKS_PER_CORE", 0.5)
    monkeypatch.setattr(blocks, "BASE_ROWS", 16)
    found = indexes.search_index(index, data[1], 5, 6, refine=3)
    assert rows(indexes.search_index(index, data[1], 5, 8, refine=3)) == whole
    assert rows(found) == few and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    hits, _ = indexes._hits(index, data[1], 15, [6], None, "qid", None, True, True)
    own, _ = indexes._hits(index, data[1], 4, [1, 6], None, "qid", None, False)
    n = data[1].count()
    parts = int(np.ceil(np.sqrt(0.5 * spark.sparkContext.defaultParallelism)))
    assert hits.count() <= parts * 15 * n and own.count() <= parts * 2 * 4 * n
