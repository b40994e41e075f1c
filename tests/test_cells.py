"""Approximate search: exact when every cell is probed, good recall at a quarter of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearfield.operators import cells, quality, search


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16)) * 3
    rows = [(i, [float(x) for x in centers[i % 12] + rng.normal(size=16)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, vector array<float>").repartition(4).persist()
    queries = df.filter("id < 80").select(F.col("id").alias("qid"), "vector")
    return df, queries


def recall(hits, truth):
    return quality.recall_at_k(hits, truth, 10).agg(F.avg("recall")).first()[0]


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_ivf(spark, data, metric):
    df, queries = data
    truth = search.knn(df, queries, 10, metric)
    index = cells.build_cells(df, 8, metric)
    assert recall(cells.ivf_search(index, queries, 10, nprobe=8), truth) == 1.0
    assert recall(cells.ivf_search(index, queries, 10, nprobe=2), truth) >= 0.9


def test_quantised_search(spark, data):
    df, queries = data
    truth = search.knn(df, queries, 10, "l2")
    index = cells.build_cells(df, 8, "l2")
    assert recall(cells.sq8_search(index, queries, 10, nprobe=8), truth) >= 0.99
    assert recall(cells.pq_search(index, queries, 10, nprobe=8, m=4, nbits=4), truth) >= 0.9
    with pytest.raises(ValueError):
        cells.pq_search(index, queries, 10, m=5)


def test_auto_search_switches(spark, data):
    df, queries = data
    truth = search.knn(df, queries, 10, "l2")
    assert recall(cells.auto_search(df, queries, 10), truth) == 1.0
    index = cells.build_cells(df, 8)
    assert recall(cells.auto_search(df, queries, 10, index=index, nprobe=8), truth) == 1.0


def test_binary_cells(spark, data):
    from nearfield.functions.vectors import binarize_vectors

    df, _ = data
    bits = binarize_vectors(df, "vector").select("id", "bits")
    queries = bits.filter("id < 40").select(F.col("id").alias("qid"), "bits")
    truth = search.knn(bits, queries, 10, "hamming", vector="bits")
    assert recall(cells.binary_ivf_search(bits, queries, 10, nlist=4, nprobe=4), truth) == 1.0


def test_stored_cells_are_partitioned(spark, data, tmp_path):
    index = cells.build_cells(data[0], 4)
    cells.save_cells(index, str(tmp_path / "ivf"))
    back = spark.read.parquet(str(tmp_path / "ivf"))
    assert back.count() == 600 and "PartitionFilters: [isnotnull(cell" in back.filter("cell = 1")._jdf.queryExecution().executedPlan().toString()


def test_distance_slices():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"x": list(range(10))})
    old, cells.DISTANCES_AT_ONCE = cells.DISTANCES_AT_ONCE, 12
    try:
        parts = [p.column("x").to_pylist() for p in cells._slices(iter([batch, batch.slice(0, 0)]), 4)]
    finally:
        cells.DISTANCES_AT_ONCE = old
    assert parts == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]


def test_arguments(spark, data):
    with pytest.raises(ValueError):
        cells.build_cells(data[0], 0)
    with pytest.raises(ValueError):
        cells.pick_pivots(data[0], "id", 10**6, False)


def test_index_comparison(spark, data):
    df, queries = data
    truth = search.knn(df, queries, 10, "l2")
    index = cells.build_cells(df, 8)
    rows = quality.compare_searches({f"nprobe={p}": cells.ivf_search(index, queries, 10, p) for p in (1, 8)}, truth, 10)
    got = {r["search"]: r["avg_recall"] for r in rows.collect()}
    assert got["nprobe=8"] == 1.0 and got["nprobe=1"] <= 1.0


@pytest.mark.parametrize("strategy", ["broadcast", "cells"])
@pytest.mark.parametrize("origin,spread", [(1e4, 1e-3), (1e9, 1e3), (0.0, 1.0)])
def test_exact_l2_far_from_the_origin(spark, strategy, origin, spread):
    rng = np.random.default_rng(8)
    base = origin + spread * rng.standard_normal((3000, 32))
    asked = origin + spread * rng.standard_normal((40, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "id long, vector array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "qid long, vector array<double>")
    got = {}
    for r in search.knn(df, queries, 10, "l2", strategy=strategy).collect():
        got.setdefault(r["qid"], set()).add(r["id"])
    for i, q in enumerate(asked):
        assert got[i] == set(np.argsort(np.sqrt(np.square(base - q).sum(1)), kind="stable")[:10].tolist())


@pytest.mark.parametrize("metric,radius", [("l2", 3.0), ("cosine", 0.9), ("ip", 20.0)])
def test_range_join_by_cells_visits_few_cells(spark, monkeypatch, metric, radius):
    from nearfield.operators import blocks

    rng = np.random.default_rng(11)
    centers = rng.normal(0, 8, (12, 8))
    points = np.concatenate([rng.normal(c, 0.5, (60, 8)) for c in centers])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "id long, vector array<double>")
    queries = df.filter("id % 9 = 0").select(F.col("id").alias("qid"), "vector")
    seen, plain = {}, blocks.pair_cells
    monkeypatch.setattr(blocks, "pair_cells", lambda base, q, *a: (seen.update(n=q.count(), cells=base.select("cell").distinct().count()), plain(base, q, *a))[1])
    got = search.knn(df, queries, 1000, metric, radius=radius, strategy="cells")
    assert rows_of(got) == rows_of(search.knn(df, queries, 1000, metric, radius=radius, strategy="broadcast"))
    assert got.count() > 1000 and (metric == "ip" or seen["n"] < 0.5 * queries.count() * seen["cells"])


def rows_of(df):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())
