"""Search results against brute force in numpy, under every pairing strategy and partitioning."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearfield.operators import blocks, search


def make(spark, n=120, dim=8, seed=3, partitions=3):
    """A third of the rows are copies of one vector, one row is zero, and one label is hot."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32) * rng.uniform(0.5, 3, size=(n, 1)).astype(np.float32)
    m[: n // 3] = m[0]
    m[n - 1] = 0
    labels = [0 if i % 3 else i % 5 for i in range(n)]
    rows = [(i, [float(x) for x in m[i]], labels[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, vector array<float>, label int").repartition(partitions)
    return df, m.astype(np.float64), labels


def cost_matrix(m, metric):
    ip = np.array([[np.sum(a * b) for b in m] for a in m])
    if metric == "ip":
        return -ip
    if metric == "cosine":
        norms = np.sqrt(np.sum(m * m, axis=1))
        scale = np.outer(norms, norms)
        return -np.where(scale == 0, 0, ip / np.where(scale == 0, 1, scale))
    return np.array([[np.sqrt(np.sum((a - b) ** 2)) for b in m] for a in m])


def brute(m, metric, k, keep=None, offset=0):
    costs = np.round(cost_matrix(m, metric), 9)
    out = {}
    for q in range(len(m)):
        ids = [i for i in range(len(m)) if keep is None or keep(i)]
        ids.sort(key=lambda i: (costs[q, i], i))
        out[q] = ids[offset : offset + k]
    return out, costs


def collected(hits):
    out = {}
    for r in hits.orderBy("qid", "rank").collect():
        out.setdefault(r["qid"], []).append(r)
    return out


def same(hits, expected, costs, sign):
    """Ids must agree except where scores are equal up to rounding of the arithmetic."""
    got = collected(hits)
    assert {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in expected.items() if v}
    for q, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(rows[0]["rank"], rows[0]["rank"] + len(rows)))
        np.testing.assert_allclose([sign * r["score"] for r in rows], [costs[q, i] for i in expected[q]], atol=1e-6)
        assert len({r["id"] for r in rows}) == len(rows)


@pytest.mark.parametrize("metric,sign", [("l2", 1), ("ip", -1), ("cosine", -1)])
@pytest.mark.parametrize("strategy", ["broadcast", "seeded", "shuffle", "cells"])
def test_knn_strategies_agree_with_brute_force(spark, metric, sign, strategy):
    df, m, _ = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    expected, costs = brute(m, metric, 7)
    hits = search.knn(df, queries, 7, metric, strategy=strategy, base_rows=16, query_rows=8)
    same(hits, expected, costs, sign)


def test_l2_ids_exact_with_copies(spark):
    df, m, _ = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    expected, _ = brute(m, "l2", 5)
    for strategy in ("broadcast", "seeded", "shuffle", "cells"):
        got = collected(search.knn(df, queries, 5, "l2", strategy=strategy, base_rows=16, query_rows=8))
        assert {q: [r["id"] for r in rows] for q, rows in got.items()} == expected


@pytest.mark.parametrize("partitions", [1, 8])
def test_partition_independence(spark, partitions):
    df, m, _ = make(spark, partitions=partitions)
    queries = df.select(F.col("id").alias("qid"), "vector")
    expected, _ = brute(m, "l2", 4)
    got = collected(search.knn(df, queries, 4, "l2"))
    assert {q: [r["id"] for r in rows] for q, rows in got.items()} == expected


def test_filter_offset_fields_and_cap(spark):
    df, m, labels = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    expected, costs = brute(m, "l2", 5, keep=lambda i: labels[i] == 3, offset=2)
    hits = search.knn(df, queries, 5, "l2", filter=F.col("label") == 3, offset=2, output_fields=["label"])
    same(hits, expected, costs, 1)
    assert {r["label"] for r in hits.collect()} == {3}
    assert search.knn(df, queries, 1000, "l2").groupBy("qid").count().agg(F.min("count")).first()[0] == 120


def test_radius_is_strict(spark):
    base = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0])], "id long, vector array<float>")
    q = spark.createDataFrame([(9, [0.0, 0.0])], "qid long, vector array<float>")
    assert [r["id"] for r in search.knn(base, q, 5, "l2", radius=2.0).orderBy("rank").collect()] == [0, 1]
    assert [r["id"] for r in search.knn(base, q.withColumn("vector", F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>")), 5, "ip",
                                        radius=1.0).orderBy("rank").collect()] == [2]


def test_string_keys_and_metric_names(spark):
    base = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, vector array<float>")
    q = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, vector array<float>")
    assert [r["id"] for r in search.knn(base, q, 2, "COSINE").orderBy("rank").collect()] == ["a", "b"]
    assert search.metric_name("unheard of") == "l2" and search.metric_name(None) == "l2"
    assert search.metric_name("MAX_SIM") == "maxsim_cosine"


def test_unequal_lengths_fail(spark):
    base = spark.createDataFrame([(0, [1.0, 0.0])], "id long, vector array<float>")
    q = spark.createDataFrame([(0, [1.0])], "qid long, vector array<float>")
    with pytest.raises(Exception, match="differ in length"):
        search.knn(base, q, 1).collect()
    with pytest.raises(ValueError):
        search.knn(base, q, 0)


def grouped_expected(m, labels, k, size, strict):
    costs = np.round(cost_matrix(m, "l2"), 9)
    out = {}
    for q in range(len(m)):
        ids = sorted(range(len(m)), key=lambda i: (costs[q, i], i))
        groups = {}
        for i in ids:
            groups.setdefault(labels[i], []).append(i)
        chosen = [g for g in groups if not strict or len(groups[g]) >= size][:k]
        out[q] = [i for g in chosen for i in groups[g][:size]]
    return out


@pytest.mark.parametrize("size,strict", [(1, False), (3, False), (7, True)])
def test_grouped_search(spark, size, strict):
    df, m, labels = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    got = collected(search.grouped_knn(df, queries, 3, "label", "l2", group_size=size, strict=strict))
    assert {q: [r["id"] for r in rows] for q, rows in got.items()} == grouped_expected(m, labels, 3, size, strict)


def test_grouped_search_keeps_null_groups(spark):
    base = spark.createDataFrame([(0, [0.0], None), (1, [1.0], "x"), (2, [0.1], None)], "id long, vector array<float>, g string")
    q = spark.createDataFrame([(0, [0.0])], "qid long, vector array<float>")
    rows = search.grouped_knn(base, q, 2, "g", group_size=2).orderBy("rank").collect()
    assert [(r["id"], r["group_value"]) for r in rows] == [(0, None), (2, None), (1, "x")]


def test_element_search(spark):
    rows = [(0, [([0.0, 0.0], "a"), ([3.0, 0.0], "b")]), (1, [([1.0, 0.0], "b")]), (2, [])]
    base = spark.createDataFrame(rows, "id long, parts array<struct<v:array<float>,tag:string>>")
    q = spark.createDataFrame([(7, [0.0, 0.0])], "qid long, vector array<float>")

    def ask(**kw):
        return [(r["id"], r["pos"]) for r in search.element_knn(base, q, 5, "l2", array="parts", vector="v", **kw).orderBy("rank").collect()]

    assert ask() == [(0, 0), (1, 0), (0, 1)]
    assert ask(predicate=lambda e: e.tag == "b") == [(1, 0), (0, 1)]
    assert ask(one_per_row=True) == [(0, 0), (1, 0)]


def test_maxsim_by_hand(spark):
    docs = spark.createDataFrame([(0, [[1.0, 0.0], [0.0, 1.0]]), (1, [[1.0, 1.0]]), (2, [])], "id long, vector array<array<float>>")
    q = spark.createDataFrame([(5, [[1.0, 0.0], [0.0, 2.0]])], "qid long, vector array<array<float>>")
    ip = search.knn(docs, q, 5, "MAX_SIM_IP").orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in ip] == [(0, 3.0), (1, 3.0)]
    l2 = search.knn(docs, q, 5, "MAX_SIM_L2", strategy="shuffle").orderBy("rank").collect()
    assert [(r["id"], round(r["score"], 6)) for r in l2] == [(0, 1.0), (1, round(1 + 2**0.5, 6))]


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_maxsim_in_slices(spark, monkeypatch, metric):
    """Long lists are scored slice by slice, a list above the slice size on its own."""
    rng = np.random.default_rng(2)
    lists = [rng.normal(size=(n, 4)).tolist() for n in (1, 7, 2, 3, 1, 5)]
    table = pa.RecordBatch.from_pydict({"vector": lists})
    kernel = blocks.MaxSimKernel(metric)
    whole = kernel.costs(kernel.load(table, True), kernel.load(table, False))
    monkeypatch.setattr(blocks, "MAXSIM_QUERY_ELEMENTS", 4)
    monkeypatch.setattr(blocks, "MAXSIM_BASE_ELEMENTS", 3)
    np.testing.assert_allclose(kernel.costs(kernel.load(table, True), kernel.load(table, False)), whole)
    a, b = np.array(lists[1]), np.array(lists[3])
    pair = -(a @ b.T) if metric == "ip" else np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    assert whole[1, 3] == pytest.approx(pair.min(1).sum())


def test_small_cache_keeps_answers(spark, monkeypatch):
    df, m, _ = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    expected, _ = brute(m, "l2", 5)
    monkeypatch.setattr(blocks, "CACHE_BYTES", 1)
    got = collected(search.knn(df, queries, 5, "l2", base_rows=16, query_rows=8))
    assert {q: [r["id"] for r in rows] for q, rows in got.items()} == expected


def test_binary_metrics_by_hand(spark):
    base = spark.createDataFrame([(0, bytearray([0b11110000])), (1, bytearray([0b00000000])), (2, bytearray([0b11000000]))], "id long, vector binary")
    q = spark.createDataFrame([(0, bytearray([0b11110000])), (1, bytearray([0]))], "qid long, vector binary")
    ham = {(r["qid"], r["id"]): r["score"] for r in search.knn(base, q, 3, "hamming").collect()}
    assert ham == {(0, 0): 0, (0, 1): 4, (0, 2): 2, (1, 0): 4, (1, 1): 0, (1, 2): 2}
    jac = {(r["qid"], r["id"]): r["score"] for r in search.knn(base, q, 3, "jaccard").collect()}
    assert jac == {(0, 0): 0.0, (0, 1): 1.0, (0, 2): 0.5, (1, 0): 1.0, (1, 1): 0.0, (1, 2): 1.0}


def test_variants_rank_apart(spark):
    df, m, labels = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    hits = search.search_variants(df, queries, [("all", None, 3), ("three", F.col("label") == 3, None)], 5)
    for name, k, keep in (("all", 3, None), ("three", 5, lambda i: labels[i] == 3)):
        expected, _ = brute(m, "l2", k, keep)
        got = collected(hits.filter(F.col("variant") == name))
        assert {q: [r["id"] for r in rows] for q, rows in got.items()} == expected


def test_variants_without_an_open_one(spark):
    df, m, labels = make(spark)
    queries = df.select(F.col("id").alias("qid"), "vector")
    hits = search.search_variants(df, queries, [("a", F.col("label") == 3, 2), ("b", F.col("label") == 0, 2)], 5)
    expected, _ = brute(m, "l2", 2, lambda i: labels[i] == 0)
    got = collected(hits.filter("variant = 'b'"))
    assert {q: [r["id"] for r in rows] for q, rows in got.items()} == expected


def test_empty_queries_and_empty_base(spark):
    base = spark.createDataFrame([(0, [1.0, 0.0])], "id long, vector array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0])], "qid long, vector array<float>")
    hits = search.knn(base, q, 3, "cosine", radius=0.5)
    assert {r["qid"]: r["is_empty"] for r in search.empty_queries(q, hits).collect()} == {0: False, 1: True}
    for strategy in ("broadcast", "shuffle", "cells"):
        assert search.knn(base.limit(0), q, 3, strategy=strategy).count() == 0
        assert search.knn(base, q.limit(0), 3, strategy=strategy).count() == 0


def test_search_params():
    p = search.search_params({"filter": "a", "expr": "b", "metricType": "IP", "metric_type": "COSINE", "groupingField": "g",
                              "groupByField": "h", "params": {"nprobe": 8, "ef": 1}, "nprobe": 16, "partitionNames": ["x"], "offset": 3})
    assert (p.filter, p.metric, p.group_by, p.offset) == ("b", "cosine", "h", 3)
    assert p.index == {"nprobe": 16, "ef": 1}


def test_scalar_query_and_get(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(10)], "id long, v long")
    assert [r["id"] for r in search.scalar_query(df, F.col("v") >= 20, ["id"], limit=3, offset=2).collect()] == [4, 5, 6]
    assert sorted(r["id"] for r in search.get_by_ids(df, [0, 3, 99]).collect()) == [0, 3]
    ids = spark.createDataFrame([(0,), (5,)], "id long")
    assert sorted(r["v"] for r in search.get_by_ids(df, ids, output_fields=["v"]).collect()) == [0, 50]


def test_plan_shape(spark, plan, tmp_path):
    df, _, _ = make(spark)
    path = str(tmp_path / "base")
    df.write.parquet(path)
    base = spark.read.parquet(path)
    hits = search.knn(base, base.select(F.col("id").alias("qid"), "vector"), 3, filter=F.col("label") == 3)
    text = plan(hits)
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_seeding_reads_some_partitions(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 20)
    assert not blocks.wide(df)
    monkeypatch.setattr(blocks, "estimated_tasks", lambda _: 20)
    parts = blocks.some_partitions(df, tasks=4).select(F.spark_partition_id().alias("p")).distinct().collect()
    assert sorted(r["p"] for r in parts) == [0, 5, 10, 15]


def test_hot_cell_is_split(spark):
    """One cell holding every row is dealt over several join keys and still gives the exact answer."""
    df, m, _ = make(spark, n=150)
    base = df.select(F.lit(0).alias("cell"), "id", "vector")
    queries = df.select(F.lit(0).alias("cell"), F.col("id").alias("qid"), "vector")
    old = blocks.BLOCKS_PER_TASK
    blocks.BLOCKS_PER_TASK = 2
    try:
        pairs = blocks.pair_cells(base, queries, "id", "qid", base_rows=8, query_rows=8)
        hits = blocks.score_blocks(pairs, blocks.DenseKernel("l2"), 4, [base.schema["id"]], queries.schema["qid"])
        rows = blocks.best_per(hits, ["qid"], 4, ["cost", "id"]).orderBy("qid", "rank").collect()
    finally:
        blocks.BLOCKS_PER_TASK = old
    expected, _ = brute(m, "l2", 4)
    got = {}
    for r in rows:
        got.setdefault(r["qid"], []).append(r["id"])
    assert got == expected
