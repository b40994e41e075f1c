"""Sparse search and hybrid search: several ranked branches fused into one ranking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.vectors import drop_small
from nearfield.operators import blocks
from nearfield.operators.search import fetch_fields, metric_name, pair, query_volume, run_request, similarity


def sparse_search(base: DataFrame, queries: DataFrame, k: int, *, drop_ratio: float = 0.0, id: str = "id",
                  vector: str = "sparse", qid: str = "qid", query_vector: str | None = None,
                  filter: Column | str | None = None, strategy: str = "auto") -> DataFrame:
    """Top-k by sparse inner product among rows that share a position with the query.

    ``drop_ratio`` leaves out that share of the smallest query entries.
    """
    def sides(df, key, column):
        v = F.col(column)
        return df.select(key, F.map_keys(v).alias("keys"), F.map_values(v).cast("array<double>").alias("values"))

    source = base.filter(filter) if filter is not None else base
    q = queries.withColumn("__v", drop_small(query_vector or vector, drop_ratio) if drop_ratio else F.col(query_vector or vector))
    b = sides(source, id, vector).filter(F.size("keys") > 0)
    q = sides(q, qid, "__v").filter(F.size("keys") > 0)
    size = F.size("keys") * 16
    pairs = pair(b, q, id, qid, size, query_volume(q, size), strategy, query_rows=512)
    hits = blocks.score_blocks(pairs, blocks.SparseKernel(), k, [base.schema[id]], queries.schema[qid])
    return blocks.best_per(hits, [qid], k, ["cost", id]).select(
        qid, "rank", id, (-F.col("cost") + F.lit(0.0)).alias("score"))


def _union(branches: Mapping[str, DataFrame], qid: str, id: str) -> DataFrame:
    if not branches:
        raise ValueError("hybrid search needs at least one branch")
    rows = [h.select(F.col(qid), F.lit(name).alias("branch"), F.col("rank"), F.col(id), F.col("score"))
            for name, h in branches.items()]
    return reduce(DataFrame.unionByName, rows)


def _ranked(scored: DataFrame, qid: str, id: str, limit: int) -> DataFrame:
    cost = scored.withColumn("cost", -F.col("score"))
    return blocks.best_per(cost, [qid], limit, ["cost", id]).select(qid, "rank", id, "score")


def rrf(branches: Mapping[str, DataFrame], limit: int, k: int = 60, *, qid: str = "qid", id: str = "id") -> DataFrame:
    """Reciprocal rank fusion (Cormack et al. 2009): ``sum(1 / (k + rank))``, ranks from 1."""
    rows = _union(branches, qid, id)
    scored = rows.groupBy(qid, id).agg(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("score"))
    # the order of addition differs between runs; rounding keeps equal sums equal
    return _ranked(scored.withColumn("score", F.round("score", 12)), qid, id, limit)


def weighted(branches: Mapping[str, DataFrame], weights: Mapping[str, float], limit: int, *,
             distances: tuple[str, ...] = (), qid: str = "qid", id: str = "id") -> DataFrame:
    """Weighted sum of scores, min-max normalised per query and branch with 1 as the best.

    Branches named in ``distances`` have lower-is-better scores. A branch whose scores are all
    equal counts 1 for each of its hits. Every branch needs a weight.
    """
    missing = set(branches) - set(weights)
    if missing:
        raise ValueError(f"no weight for branch {', '.join(sorted(missing))}")
    rows = _union(branches, qid, id)
    low_better = F.col("branch").isin(list(distances)) if distances else F.lit(False)
    rows = rows.withColumn("s", F.when(low_better, -F.col("score")).otherwise(F.col("score")))
    ends = rows.groupBy(qid, "branch").agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    rows = rows.join(ends, [qid, "branch"])
    unit = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    table = F.create_map(*[x for name in branches for x in (F.lit(name), F.lit(float(weights[name])))])
    scored = rows.groupBy(qid, id).agg(F.sum(F.element_at(table, F.col("branch")) * unit).alias("score"))
    return _ranked(scored.withColumn("score", F.round("score", 12)), qid, id, limit)


def run_hybrid_request(base: DataFrame, requests: Sequence[tuple[DataFrame, Mapping[str, object]]], reranker: Mapping[str, object] | None,
                       limit: int, output_fields: Sequence[str] = (), *, id: str = "id", qid: str = "qid") -> DataFrame:
    """Run several (queries, request) pairs and fuse them as a reranker mapping says.

    A request has ``vectorField``, ``limit`` and ``params`` (filter, metric, offset). The reranker is
    ``{"type": "rrf", "params": {"k": …}}`` or ``{"type": "weighted", "params": {"weights": […]}}`` with one weight
    per request; anything else means rrf. A weighted reranker without weights is rrf as well.
    """
    if not requests:
        raise ValueError("at least one search request required")
    branches, far = {}, []
    for n, (queries, request) in enumerate(requests):
        asked = {**dict(request.get("params") or {}), "vectorField": request.get("vectorField")}
        hits = run_request(base, queries, asked, int(request.get("limit") or limit), id=id, qid=qid)
        branches[f"r{n}"] = hits.select(qid, "rank", id, "score")
        if not similarity(metric_name(asked.get("metric_type") or asked.get("metricType"))):
            far.append(f"r{n}")
    kind, params = (reranker or {}).get("type"), dict((reranker or {}).get("params") or {})
    weights = list(params.get("weights") or ())
    if kind == "weighted" and weights:
        if len(weights) != len(branches):
            raise ValueError("one weight per request is needed")
        found = weighted(branches, dict(zip(branches, weights)), limit, distances=tuple(far), qid=qid, id=id)
    else:
        found = rrf(branches, limit, int(params.get("k") or 60) if kind == "rrf" else 60, qid=qid, id=id)
    return fetch_fields(found, base, id, output_fields)
