"""Ground truth and recall. Hits and truth are ranked rows ``(qid, rank, id, …)``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.operators.search import knn, metric_name
from nearfield.session import materialize


def ground_truth(base: DataFrame, queries: DataFrame, k: int, metric: str = "L2", *, id: str = "id",
                 vector: str = "vector", qid: str = "qid", query_vector: str | None = None) -> DataFrame:
    """Exact neighbours as arrays, nearest first: ``(query_id, neighbors, distances)``.

    Cosine gives ``1 - similarity``; a metric other than cosine means L2.
    """
    name = "cosine" if metric_name(metric) == "cosine" else "l2"
    hits = knn(base, queries, k, name, id=id, vector=vector, qid=qid, query_vector=query_vector)
    distance = F.lit(1.0) - F.col("score") if name == "cosine" else F.col("score")
    rows = hits.groupBy(F.col(qid).alias("query_id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col(id).alias("id"), distance.alias("d")))).alias("h"))
    return rows.select("query_id", F.col("h.id").alias("neighbors"), F.col("h.d").alias("distances"))


def truth_rows(truth: DataFrame) -> DataFrame:
    """Neighbour arrays ``(query_id, neighbors)`` as ranked rows."""
    rows = truth.select(F.col("query_id").alias("qid"), F.posexplode("neighbors").alias("pos", "id"))
    return rows.select("qid", (F.col("pos") + 1).alias("rank"), "id")


def _matched(hits: DataFrame, truth: DataFrame, id: str) -> DataFrame:
    """Distinct hits that are in the truth, with both ranks; a repeated hit counts once, at its best rank."""
    t = truth.select("qid", F.col(id).alias("id"), F.col("rank").alias("truth_rank")).dropDuplicates(["qid", "id"])
    h = hits.groupBy("qid", F.col(id).alias("id")).agg(F.min("rank").alias("hit_rank"))
    return h.join(t, ["qid", "id"])


def _per_query(queries: DataFrame, found: DataFrame) -> DataFrame:
    names = [c for c in found.columns if c != "qid"]
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in names]
    return queries.select("qid").join(found, "qid", "left").select("qid", *filled)


def _query_ids(truth: DataFrame, queries: DataFrame | None) -> DataFrame:
    return truth.select("qid").distinct() if queries is None else queries


def recall_at_k(hits: DataFrame, truth: DataFrame, k: int, queries: DataFrame | None = None, *, id: str = "id") -> DataFrame:
    """``|top-k hits ∩ top-k truth| / k`` per query; a query without hits has recall 0."""
    matched = _matched(hits.filter(F.col("rank") <= k), truth.filter(F.col("rank") <= k), id)
    found = matched.groupBy("qid").agg(F.count(F.lit(1)).alias("found"))
    rows = _per_query(_query_ids(truth, queries), found)
    return rows.withColumn("recall", F.col("found") / F.lit(float(k)))


def recall_expected(hits: DataFrame, truth: DataFrame, *, id: str = "id") -> DataFrame:
    """Share of the full expected list that was found."""
    truth = materialize(truth, "truth")  # read twice
    sizes = truth.groupBy("qid").agg(F.countDistinct(id).alias("expected"))
    found = _matched(hits, truth, id).groupBy("qid").agg(F.count(F.lit(1)).alias("found"))
    rows = sizes.join(found, "qid", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return rows.withColumn("recall", F.col("found") / F.col("expected"))


def _steps(ks: Sequence[int], value: Callable[[int], Column]) -> Column:
    """One struct per depth, to be inlined into rows."""
    return F.array(*[F.struct(F.lit(k).alias("top_k"), value(k).alias("found")) for k in ks])


def recall_by_topk(hits: DataFrame, truth: DataFrame, ks: Sequence[int], *, id: str = "id") -> DataFrame:
    """Recall of the first ``top_k`` hits against the whole expected list, over ``min(top_k, |expected|)``."""
    truth = materialize(truth, "truth")  # read twice
    sizes = truth.groupBy("qid").agg(F.countDistinct(id).alias("expected"))
    counts = [F.count_if(F.col("hit_rank") <= k).alias(f"f{k}") for k in ks]
    found = sizes.join(_matched(hits, truth, id).groupBy("qid").agg(*counts), "qid", "left")
    rows = found.select("qid", "expected", F.inline(_steps(ks, lambda k: F.coalesce(F.col(f"f{k}"), F.lit(0)))))
    return rows.withColumn("recall", F.col("found") / F.least("top_k", "expected"))


def recall_multi_k(hits: DataFrame, truth: DataFrame, ks: Sequence[int], queries: DataFrame | None = None, *,
                   id: str = "id") -> DataFrame:
    """Recall@k in percent for several ``k`` from one join: ``(qid, top_k, found, recall_pct)``."""
    ks = sorted(set(ks))
    counts = [F.count_if(F.greatest("hit_rank", "truth_rank") <= k).alias(f"f{k}") for k in ks]
    found = _per_query(_query_ids(truth, queries), _matched(hits, truth, id).groupBy("qid").agg(*counts))
    rows = found.select("qid", F.inline(_steps(ks, lambda k: F.col(f"f{k}"))))
    return rows.withColumn("recall_pct", F.col("found") * 100.0 / F.col("top_k"))


def recall_summary(recalls: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, minimum and 95th percentile of recall."""
    return recalls.groupBy(*by).agg(
        F.count("recall").alias("n"), F.avg("recall").alias("avg_recall"), F.min("recall").alias("min_recall"),
        F.percentile("recall", F.lit(0.95)).alias("p95_recall"))


def recall_histogram(recalls: DataFrame, buckets: int = 10) -> DataFrame:
    """Queries per recall interval of width ``1 / buckets``; 1.0 falls in the last one."""
    bucket = F.least(F.floor(F.col("recall") * buckets + F.lit(1e-9)), F.lit(buckets - 1)).cast("int")
    return recalls.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n_queries"))


def low_recall_rate(recalls: DataFrame, minimum: float) -> DataFrame:
    """Share of queries whose recall is below ``minimum``."""
    low = F.col("recall") < minimum
    return recalls.agg(F.count(F.lit(1)).alias("n"), F.count_if(low).alias("n_low"),
                       F.avg(low.cast("double")).alias("low_rate"))


def recall_gates(recalls: DataFrame, per_query: Sequence[float] = (0.8, 1.0),
                 overall: Sequence[float] = (0.9, 0.95, 1.0)) -> DataFrame:
    """One row per gate: how many queries pass it, and whether all (or the mean) do."""
    gates = [("query", g) for g in per_query] + [("mean", g) for g in overall]
    n, mean = F.count(F.lit(1)).alias("n"), F.avg("recall").alias("mean")
    passed = [F.count_if(F.col("recall") >= g).alias(f"g{i}") for i, (_, g) in enumerate(gates)]
    row = recalls.agg(n, mean, *passed)
    slack = F.lit(1e-12)
    steps = [F.struct(F.lit(kind).alias("gate"), F.lit(g).alias("minimum"), F.col(f"g{i}").alias("n_passed"),
                      (F.col(f"g{i}") == F.col("n") if kind == "query" else F.col("mean") >= F.lit(g) - slack).alias("passed"))
             for i, (kind, g) in enumerate(gates)]
    return row.select(F.inline(F.array(*steps)))


def group_purity(hits: DataFrame, base: DataFrame, queries: DataFrame, *, id: str = "id", group: str = "group_id") -> DataFrame:
    """Per query, how many of its neighbours come from its own group."""
    own = queries.select("qid", F.col(group).alias("__own"))
    members = base.select(id, F.col(group).alias("__group"))
    rows = hits.select("qid", id).join(members, id).join(own, "qid")
    return rows.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__group").eqNullSafe(F.col("__own"))).alias("own_group"),
    ).withColumn("purity", F.col("own_group") / F.col("n"))


def compare_searches(searches: Mapping[str, DataFrame], truth: DataFrame, k: int, *, id: str = "id") -> DataFrame:
    """Recall summary per named search result, as one table; names stand for parameter combinations."""
    truth = materialize(truth.select("qid", "rank", id), "truth")  # read twice per search
    rows = [recall_at_k(hits, truth, k, id=id).select(F.lit(name).alias("search"), "recall") for name, hits in searches.items()]
    return recall_summary(reduce(DataFrame.unionByName, rows), ["search"])
