"""Recall definitions with values worked out by hand."""

import numpy as np
import pytest

from nearfield.operators import quality


@pytest.fixture(scope="module")
def frames(spark):
    truth = spark.createDataFrame([(0, r + 1, i) for r, i in enumerate([0, 1, 2, 3])] + [(1, 1, 5), (1, 2, 6)] + [(2, 1, 9)], "qid long, rank int, id long")
    hits = spark.createDataFrame([(0, 1, 0), (0, 2, 3), (0, 3, 7), (1, 1, 6), (1, 2, 5)], "qid long, rank int, id long")
    queries = spark.createDataFrame([(0,), (1,), (2,)], "qid long")
    return hits, truth, queries


def by_query(df, value="recall"):
    return {r["qid"]: r[value] for r in df.collect()}


def test_recall_at_k(frames):
    hits, truth, queries = frames
    assert by_query(quality.recall_at_k(hits, truth, 2, queries)) == {0: 0.5, 1: 1.0, 2: 0.0}
    assert by_query(quality.recall_at_k(hits, truth, 4, queries)) == {0: 0.5, 1: 0.5, 2: 0.0}


def test_other_denominators(frames):
    hits, truth, queries = frames
    assert by_query(quality.recall_expected(hits, truth)) == {0: 0.5, 1: 1.0, 2: 0.0}
    rows = {(r["qid"], r["top_k"]): r["recall"] for r in quality.recall_by_topk(hits, truth, [1, 2, 10]).collect()}
    assert rows == {(0, 1): 1.0, (0, 2): 1.0, (0, 10): 0.5, (1, 1): 1.0, (1, 2): 1.0, (1, 10): 1.0, (2, 1): 0.0, (2, 2): 0.0, (2, 10): 0.0}
    multi = {(r["qid"], r["top_k"]): r["recall_pct"] for r in quality.recall_multi_k(hits, truth, [1, 4, 4], queries).collect()}
    assert multi == {(0, 1): 100.0, (0, 4): 50.0, (1, 1): 0.0, (1, 4): 50.0, (2, 1): 0.0, (2, 4): 0.0}


def test_summaries(spark):
    recalls = spark.createDataFrame([(i, x) for i, x in enumerate([1.0, 1.0, 0.8, 0.2])], "qid long, recall double")
    row = quality.recall_summary(recalls).first()
    assert (row["n"], row["avg_recall"], row["min_recall"]) == (4, 0.75, 0.2) and row["p95_recall"] == pytest.approx(1.0)
    assert {r["bucket"]: r["n_queries"] for r in quality.recall_histogram(recalls).collect()} == {9: 2, 8: 1, 2: 1}
    low = quality.low_recall_rate(recalls, 0.8).first()
    assert (low["n_low"], low["low_rate"]) == (1, 0.25)
    gates = {(r["gate"], r["minimum"]): (r["n_passed"], r["passed"]) for r in quality.recall_gates(recalls).collect()}
    assert gates[("query", 0.8)] == (3, False) and gates[("query", 1.0)] == (2, False) and gates[("mean", 0.9)][1] is False


def test_ground_truth_and_purity(spark):
    rng = np.random.default_rng(3)
    middle = rng.random((4, 16)) + np.eye(4, 16)
    rows = [(1 + 6 * g + i, g, (middle[g] + (rng.random(16) - 0.5) * 0.02).tolist()) for g in range(4) for i in range(6)]
    rows += [(100 + i, -1, (5 + rng.random(16)).tolist()) for i in range(10)]
    base = spark.createDataFrame(rows, "id long, group_id long, vector array<float>")
    queries = spark.createDataFrame([(g, g, middle[g].tolist()) for g in range(4)], "qid long, group_id long, vector array<float>")
    truth = quality.ground_truth(base, queries, 6, "L2")
    rows = truth.collect()
    assert all(len(r["neighbors"]) == 6 and r["distances"] == sorted(r["distances"]) for r in rows)
    ranked = quality.truth_rows(truth)
    assert by_query(quality.group_purity(ranked, base, queries), "purity") == {0: 1.0, 1: 1.0, 2: 1.0, 3: 1.0}
    assert set(by_query(quality.recall_at_k(ranked, ranked, 6)).values()) == {1.0}
    cosine = quality.ground_truth(base, queries, 2, "COSINE").collect()
    assert all(-1e-9 <= d < 0.1 for r in cosine for d in r["distances"])
    odd = quality.ground_truth(base, queries, 6, "whatever")
    assert {r["query_id"]: r["neighbors"] for r in odd.collect()} == {r["query_id"]: r["neighbors"] for r in rows}


def test_id_zero_counts(spark):
    one = spark.createDataFrame([(0, 1, 0)], "qid long, rank int, id long")
    assert by_query(quality.recall_at_k(one, one, 1)) == {0: 1.0}


def test_a_repeated_hit_counts_once(spark):
    hits = spark.createDataFrame([(0, 1, 1), (0, 2, 1), (0, 3, 2)], "qid long, rank int, id long")
    truth = spark.createDataFrame([(0, 1, 1), (0, 2, 2), (0, 3, 3)], "qid long, rank int, id long")
    assert by_query(quality.recall_at_k(hits, truth, 3))[0] == pytest.approx(2 / 3)
