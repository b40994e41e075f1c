"""Exact Hamming and Jaccard joins over bit blocks, against brute force and against the plain block search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearfield.operators import bitcells, blocks, search


def frame(spark, rows, key="id"):
    return spark.createDataFrame([(i, bytes(np.packbits(r))) for i, r in enumerate(rows)], f"{key} long, vector binary")


def near_copies(rng, n, copies, bits, flips, share=0.5):
    centres = rng.random((n, bits)) < share
    rows = np.repeat(centres, copies, axis=0)
    for r in rows:
        r[rng.choice(bits, rng.integers(0, flips + 1), replace=False)] ^= True
    return rows


def truth(base, asked, k, metric):
    a, b = asked.astype(float), base.astype(float)
    cost = blocks.bit_costs(a, b, metric)
    return {(q, r + 1, int(i), round(cost[q, i], 9)) for q in range(len(a)) for r, i in enumerate(np.argsort(cost[q], kind="stable")[:k])}


def rows_of(df):
    rows = [(r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("metric", ["hamming", "jaccard"])
@pytest.mark.parametrize("share", [0.5, 0.1])
def test_top_k_equals_brute_force(spark, metric, share):
    rng = np.random.default_rng(3)
    base = np.concatenate([near_copies(rng, 120, 6, 72, 4, share), np.zeros((3, 72), bool), np.ones((2, 72), bool),
                           np.repeat(rng.random((1, 72)) < share, 300, axis=0)])  # empty and full sets, one hot value
    asked = np.concatenate([base[::11], rng.random((20, 72)) < share, np.zeros((1, 72), bool)])
    got = search.knn(frame(spark, base), frame(spark, asked, "qid"), 7, metric, strategy="cells", base_rows=64, query_rows=16)
    assert rows_of(got) == truth(base, asked, 7, metric)


@pytest.mark.parametrize("metric,radius", [("hamming", 9.0), ("jaccard", 0.25), ("jaccard", 1.5)])
def test_range_equals_block_search(spark, metric, radius):
    rows = near_copies(np.random.default_rng(4), 60, 8, 64, 5)
    base, asked = frame(spark, rows), frame(spark, rows[::7], "qid")
    got = search.knn(base, asked, 600, metric, radius=radius, strategy="cells")
    assert rows_of(got) == rows_of(search.knn(base, asked, 600, metric, radius=radius, strategy="broadcast")) and got.count() > len(rows[::7])


def test_small_tables_and_clashing_columns(spark):
    rows = near_copies(np.random.default_rng(5), 4, 1, 16, 0)
    base = frame(spark, rows).withColumns({"cell": F.lit("x"), "tau": F.lit(1), "reach": F.lit(2), "number": F.lit(3)})
    asked = frame(spark, rows, "qid").withColumns({"cell": F.lit("x"), "number": F.lit(3)})
    assert rows_of(search.knn(base, asked, 9, "hamming", strategy="cells")) == truth(rows, rows, 9, "hamming")
    assert search.knn(base.limit(0), asked, 9, "hamming", strategy="cells").count() == 0
    assert search.knn(base, asked.limit(0), 9, "jaccard", strategy="cells").count() == 0
    nulls = base.withColumn("vector", F.when(F.col("id") > 1, F.col("vector")))
    assert search.knn(nulls, asked, 9, "jaccard", strategy="cells").count() == 8


def test_beyond_the_broadcast_bound_few_pairs_are_compared(spark, monkeypatch):
    """No query side fits a bound of no rows: near copies meet in their cells, far below all pairs."""
    rows = near_copies(np.random.default_rng(6), 500, 8, 128, 3)
    base, asked = frame(spark, rows), frame(spark, rows[::5], "qid")
    compared, plain = [], blocks.pair_cells

    def counted(b, q, *args):
        n = b.groupBy("cell").agg(F.count("*").alias("n"))
        compared.append(q.join(n, "cell").agg(F.sum("n")).first()[0])
        return plain(b, q, *args)

    want = rows_of(search.knn(base, asked, 5, "hamming"))
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(blocks, "pair_cells", counted)
    layout = bitcells.Layout(128, 10)
    monkeypatch.setattr(bitcells, "choose_layout", lambda bits, n: layout)
    assert rows_of(search.knn(base, asked, 5, "hamming")) == want
    assert len(compared) == 2 and sum(compared) < 0.2 * len(rows) * len(rows[::5])


def test_every_pair_in_reach_shares_a_visited_cell():
    rng = np.random.default_rng(7)
    layout = bitcells.Layout(45, 7)
    base, asked = rng.random((400, 45)) < 0.5, rng.random((30, 45)) < 0.5
    cells = layout.cells_of(base.astype(float))
    plan = bitcells.Plan(layout, np.bincount(cells.ravel(), minlength=layout.cells), "hamming")
    distances = plan.distances(layout.values(asked.astype(float)))
    cost = blocks.bit_costs(asked.astype(float), base.astype(float), "hamming")
    for tau in (0, 3, 6, 7, 13, 20, 45, np.inf):
        reach, sizes = plan.within(asked.sum(1), distances, np.full(len(asked), float(tau)))
        visited = [set() for _ in asked]
        for q, c in zip(*plan.visits(distances, reach, sizes)):
            visited[q].add(c)
        assert all(visited[q] & set(cells[b].tolist()) for q, b in zip(*np.nonzero(cost <= tau)))
    with pytest.raises(ValueError):
        layout.matrix(pa.array([b"ab"]))
