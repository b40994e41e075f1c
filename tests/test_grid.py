"""Searches whose query side fits no broadcast: the grid of tasks, and when cells give way to it."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearfield.operators import blocks, cells, fusion, indexes, quality, search


def vectors(spark, m, name="id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{name} long, vector array<double>")


def rows_of(df, *names):
    return sorted((r["qid"], r["rank"], *[r[n] for n in names or ["id"]], round(r["score"], 9)) for r in df.collect())


@pytest.fixture
def bounded(monkeypatch):
    """No query side is small."""
    monkeypatch.setattr(search, "BROADCAST_ROWS", 5)


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(21)
    m = rng.normal(size=(300, 16))
    m[150:160] = m[3]  # copies
    return vectors(spark, m), vectors(spark, m[::3], "qid")


def test_forced_broadcast_of_too_many_queries(spark, sides, bounded, monkeypatch):
    base, queries = sides
    got = rows_of(search.knn(base, queries, 7, "l2", strategy="broadcast"))
    seeded = rows_of(search.knn(base, queries, 7, "l2", strategy="seeded"))
    monkeypatch.undo()
    assert got == seeded == rows_of(search.knn(base, queries, 7, "l2")) and len(got) == 700


@pytest.mark.parametrize("strategy", ["auto", "cells"])
@pytest.mark.parametrize("metric,radius", [("l2", None), ("cosine", None), ("ip", None), ("cosine", 0.1), ("l2", 5.0)])
def test_vectors_without_clusters_do_not_visit_every_cell(spark, sides, bounded, monkeypatch, strategy, metric, radius):
    """Their cells prune nothing: the queries move once per part of the grid, not once per cell."""
    base, queries = sides
    visited, plain = [], cells.materialize
    monkeypatch.setattr(blocks, "GRID_TASKS_PER_CORE", 0.5)
    monkeypatch.setattr(cells, "materialize", lambda df, name: (visited.append(df.count()) if name == "visits" else None, plain(df, name))[1])
    got = rows_of(search.knn(base, queries, 7, metric, radius=radius, strategy=strategy, base_rows=32, query_rows=16))
    monkeypatch.undo()
    assert got == rows_of(search.knn(base, queries, 7, metric, radius=radius))
    assert sum(visited) <= (0 if strategy == "auto" or radius is not None else 3 * queries.count())


def test_broken_queries_spoil_no_other(spark, sides, bounded, monkeypatch):
    base, queries = sides
    asked = queries.withColumn("vector", F.when(F.col("qid") == 3, F.transform("vector", lambda x: x * float("nan"))).otherwise(F.col("vector")))
    monkeypatch.setattr(blocks, "GRID_TASKS_PER_CORE", 0.5)
    got = rows_of(search.knn(base, asked, 7, "l2", base_rows=32, query_rows=16))
    monkeypatch.undo()
    assert got == rows_of(search.knn(base, queries.filter("qid <> 3"), 7, "l2"))


def test_grid_parts_are_whole_and_bounded(spark, sides):
    base, queries = sides
    grid = blocks.pair_grid(base, queries, "id", "qid", (3, 2), base_rows=16, query_rows=8)
    parts = grid.packed.select("part", "side", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r["part"] for r in parts}) == len({r["p"] for r in parts}) == 6
    hits = blocks.score_blocks(grid, blocks.DenseKernel("l2"), 4, [base.schema["id"]], queries.schema["qid"])
    got = blocks.best_per(hits, ["qid"], 4, ["cost", "id"]).withColumnRenamed("cost", "score")
    assert rows_of(got) == rows_of(search.knn(base, queries, 4, "l2"))
    assert blocks.grid_shape(600_000, 600_000, 512, 12) == (6, 6)
    assert blocks.grid_shape(6_000_000, 60_000_000, 512, 12) == (6, 229)


@pytest.mark.parametrize("metric", ["l2", "cosine", "ip", "hamming"])
def test_maxsim_of_lists_of_any_length(spark, bounded, monkeypatch, metric):
    rng = np.random.default_rng(5)
    lists = [rng.normal(size=(rng.integers(1, 7), 8)) for _ in range(60)] + [np.full((3, 8), 1e4)]
    lists += lists[:9]
    if metric == "hamming":
        lists = [x > 0 for x in lists]
        values, kind = [[bytearray(np.packbits(v).tobytes()) for v in x] for x in lists], "array<binary>"
        cost = lambda a, b: (a[:, None] != b[None]).sum(2).min(1).sum()
    else:
        values, kind = [x.tolist() for x in lists], "array<array<double>>"
        norm = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
        cost = {"l2": lambda a, b: np.sqrt(np.square(a[:, None] - b[None]).sum(2)).min(1).sum(), "ip": lambda a, b: -(a @ b.T).max(1).sum() * -1,
                "cosine": lambda a, b: (norm(a) @ norm(b).T).max(1).sum()}[metric]
        cost = (lambda a, b: (a @ b.T).max(1).sum()) if metric == "ip" else cost
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, vector {kind}")
    got = search.knn(docs, docs.select(F.col("id").alias("qid"), "vector"), 5, f"maxsim_{metric}", base_rows=16, query_rows=8)
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(r["qid"], []).append(r)
    sign = -1 if metric in ("cosine", "ip") else 1
    for i, a in enumerate(lists):
        all_costs = sorted((round(sign * cost(a, b), 7), j) for j, b in enumerate(lists))[:5]
        assert [r["id"] for r in found[i]] == [j for _, j in all_costs]
        np.testing.assert_allclose([r["score"] for r in found[i]], [sign * c for c, _ in all_costs], atol=1e-6)


def test_sparse_search_of_many_queries(spark, bounded, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, {int(p): float(rng.integers(1, 5)) for p in rng.choice(12, 4, replace=False)}) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, sparse map<int,double>")
    queries = df.select(F.col("id").alias("qid"), "sparse")
    got = rows_of(fusion.sparse_search(df, queries, 6))
    monkeypatch.undo()
    assert got == rows_of(fusion.sparse_search(df, queries, 6))


def test_cache_counts_what_blocks_become(spark, monkeypatch):
    """Bits grow 64 times when unpacked; the cache of query blocks is bounded by that, not by their packed size."""
    rows = np.random.default_rng(3).random((512, 64)) < 0.5
    df = spark.createDataFrame([(i, bytearray(np.packbits(r).tobytes())) for i, r in enumerate(rows)], "id long, vector binary")
    kernel = blocks.BinaryKernel("hamming")
    loaded = kernel.load(df.toArrow().combine_chunks().to_batches()[0], True)
    assert blocks._held(loaded) == 512 * 64 * 8 and blocks._held((loaded, [loaded, 3])) == 2 * 512 * 64 * 8


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_a_part_gives_each_query_its_best_rows_once(spark, sides, metric):
    """However many blocks a part has: else the hits to sort grow with the rows of both sides."""
    base, queries = sides
    pairs = blocks.pair_grid(base, queries, "id", "qid", (2, 3), base_rows=16, query_rows=8)
    hits = blocks.score_blocks(pairs, search.kernel_for(metric), 7, [base.schema["id"]], queries.schema["qid"])
    assert hits.count() == 2 * 7 * queries.count()
    best = blocks.best_per(hits, ["qid"], 7, ["cost", "id"]).withColumn("score", search.score_of(metric))
    assert rows_of(best) == rows_of(search.knn(base, queries, 7, metric))


def test_parts_follow_the_hits_they_keep():
    assert blocks.grid_shape(10**5, 10**5, 512, 12) == blocks.grid_shape(10**5, 10**5, 512, 12, 640) == (6, 6)
    few, many = blocks.grid_shape(6 * 10**5, 6 * 10**5, 512, 12, 5120)
    assert (few, many) == (2, 26)


@pytest.mark.parametrize("many", [4, 120])
def test_a_part_gives_each_query_its_best_groups_once(spark, sides, many):
    """However many blocks and groups a part has, the hits of a grouped search are the best row of the best k groups."""
    base, queries = sides
    base = base.withColumn("g", F.when(F.col("id") % many == 2, None).otherwise(F.concat(F.lit("v"), (F.col("id") % many).cast("string"))))
    pairs = blocks.pair_grid(base, queries, "id", "qid", (2, 3), base_rows=64, query_rows=32)
    hits = blocks.score_blocks(pairs, blocks.DenseKernel("l2"), 3, [base.schema["id"]], queries.schema["qid"], base.schema["g"])
    assert hits.count() == 2 * 3 * queries.count()
    best = blocks.best_per(hits.withColumn("g", F.coalesce("g", F.lit("none"))), ["qid", "g"], 1, ["cost", "id"], "member")
    got = sorted((r["qid"], r["rank"], r["id"], round(r["cost"], 9)) for r in blocks.best_per(best, ["qid"], 3, ["cost", "id"]).collect())
    m = np.array([r["vector"] for r in base.orderBy("id").collect()])
    for i in range(0, 300, 3):
        seen, due = set(), []
        for c, j in sorted((round(float(c), 9), j) for j, c in enumerate(np.sqrt(np.square(m - m[i]).sum(1)))):
            if j % many not in seen and len(due) < 3:
                seen.add(j % many)
                due.append((i // 3, len(due) + 1, j, c))
        assert [r for r in got if r[0] == i // 3] == due


@pytest.mark.parametrize("scale,far", [(1.0, 0.0), (1e-30, 0.0), (1e30, 0.0), (1e100, 0.0), (1.0, 1e6)])
def test_single_precision_loses_no_neighbour(scale, far):
    rng = np.random.default_rng(2)
    m = (rng.normal(size=(500, 8)) + far) * scale
    m[:3] *= 1e-3
    kernel, wide = blocks.DenseKernel("l2"), np.sqrt(np.square((m[:40, None] - m[None]) / scale).sum(2))
    for k, groups in ((5, None), (3, np.arange(500) % 4), (3, np.arange(500) % 90)):
        found = blocks.Kept(k, ["id"], np.full(40, np.inf), None if groups is None else "g")
        for start in range(0, 500, 100):
            names = pa.array([f"v{g}" for g in (groups if groups is not None else np.zeros(500, int))[start : start + 100]])
            base = pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + 100)), names, pa.array(m[start : start + 100].tolist())], names=["id", "g", "vector"])
            qi, bi, cost = blocks.score_pair(kernel, m[:40], kernel.load(base, False), base, k, found.tau, ["id"], found.group, kept=found)
            found.add(qi, pa.RecordBatch.from_arrays([base["id"].take(pa.array(bi)), base["g"].take(pa.array(bi)), pa.array(cost)], names=["id", "g", "cost"]))
        hits = {(q, i) for b in [found._best()] for q, i in zip(b["__q"].to_pylist(), b["id"].to_pylist())}
        due = set()
        for q, row in enumerate(wide):
            seen = set()
            for j in np.lexsort((np.arange(500), row)):
                group = j if groups is None else groups[j]
                if group not in seen and len(seen) < k:
                    seen.add(group)
                    due.add((q, int(j)))
        assert hits == due


def test_sparse_blocks_of_few_keys_are_matrices(spark):
    """Rows without a shared key are no hits, even where all others score below zero; copies cost the same in blocks of other keys."""
    kernel = blocks.SparseKernel()

    def block(rows):
        return pa.RecordBatch.from_arrays([pa.array([sorted(r) for r in rows], pa.list_(pa.int32())), pa.array([[r[p] for p in sorted(r)] for r in rows], pa.list_(pa.float64())),
                                           pa.array(range(len(rows)))], names=["keys", "values", "id"])

    row = {1: 0.1, 3: 0.7, 4: 0.3, 9: 0.123456789}
    q = kernel.load(block([row, {5: 1.0}, {1: 0.0, 7: 2.0}]), True)
    base = block([{3: -1.0}, {5: -2.0}, {7: 1.5}, row, {1: -4.0}])
    other = block([row, {0: 9.0, 2: 1.0, 6: 3.0}])
    assert kernel.factors(q, kernel.load(base, False)) is not None
    qi, bi, cost = blocks.score_pair(kernel, q, kernel.load(base, False), base, 9, np.full(3, np.inf), ["id"])
    assert [(int(a), int(b)) for a, b in zip(qi, bi)] == [(0, 3), (0, 4), (0, 0), (1, 1), (2, 2)]
    again = blocks.score_pair(kernel, q, kernel.load(other, False), other, 9, np.full(3, np.inf), ["id"])
    assert again[2].tolist() == [cost[0]]


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_many_queries_of_cells_meet_on_the_grid(spark, sides, bounded, monkeypatch, metric):
    """Hits are kept per query over all cells; before, each pair of blocks of a cell gave its own."""
    base, queries = sides
    index = cells.build_cells(base, 6, metric)
    asked = dict(plain=lambda p: cells.ivf_search(index, queries, 7, p), codes=lambda p: cells.pq_search(index, queries, 7, p, m=4, nbits=3, refine=3))
    with monkeypatch.context() as m:
        m.setattr(blocks, "pair_cells", None)
        got = {(kind, p): rows_of(f(p)) for kind, f in asked.items() for p in (2, 6)}
    monkeypatch.undo()
    assert got == {(kind, p): rows_of(f(p)) for kind, f in asked.items() for p in (2, 6)}


def test_short_lists_do_not_leave_a_task_that_sees_all_rows(spark, sides, bounded, tmp_path):
    base, queries = sides
    index = indexes.build_index(base, str(tmp_path / "pq"), "pq", nlist=5, metric="cosine", m=4, nbits=3)
    hits = indexes._grid_hits(index, queries, 60, [5], None, "qid", 6)
    assert hits.count() == 6 * queries.count()
    assert blocks.grid_shape(600_000, 600_000, 512, 8, 400 * blocks.HIT_BYTES, whole=True) == (1, 117)
    assert blocks.grid_shape(50_000, 50_000, 512, 8, 80 * blocks.HIT_BYTES, whole=True) == (1, 24)
    assert blocks.grid_shape(6_000_000, 600_000, 512, 8, 80 * blocks.HIT_BYTES, whole=True)[0] == 6


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_products_find_what_code_tables_say(metric):
    rng = np.random.default_rng(4)
    kernel = cells.ProductCodeKernel(metric, [rng.normal(size=(8, 3)) for _ in range(4)])
    q, codes = rng.normal(size=(30, 12)), rng.integers(0, 8, (200, 4)).astype(np.uint16)
    codes[50:80] = codes[0]
    costs, base = kernel.costs(q, codes), pa.RecordBatch.from_arrays([pa.array(np.arange(200))], names=["id"])
    qi, bi, cost = blocks.score_pair(kernel, q, codes, base, 9, np.full(30, np.inf), ["id"])
    due = [(i, j) for i in range(30) for j in np.lexsort((np.arange(200), costs[i]))[:9]]
    assert list(zip(qi, bi)) == due and (cost == costs[qi, bi]).all()


def test_truth_is_searched_once_for_all_searches(spark, monkeypatch):
    read, plain = [], quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, name: (read.append(name), plain(df, name))[1])
    truth = spark.createDataFrame([(q, r, 10 * q + r) for q in range(4) for r in (1, 2)], "qid long, rank int, id long")
    rows = quality.compare_searches({"all": truth, "half": truth.filter("rank = 1")}, truth, 2).collect()
    assert {r["search"]: r["avg_recall"] for r in rows} == {"all": 1.0, "half": 0.5} and read == ["truth"]
