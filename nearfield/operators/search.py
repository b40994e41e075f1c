"""Batch search: exact top-k, filtered, paged, grouped, element-wise, range and variant search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.operators import bitcells, blocks, cells
from nearfield.session import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, materialize, skew_join, widen

DENSE = ("l2", "ip", "cosine")
BINARY = ("hamming", "jaccard")
SIMILARITIES = ("ip", "cosine", "sparse_ip", "bm25")

# Metric names accepted on input, in upper case, and the metric they stand for.
METRIC_NAMES = {
    "L2": "l2",
    "IP": "ip",
    "COSINE": "cosine",
    "HAMMING": "hamming",
    "JACCARD": "jaccard",
    "BM25": "bm25",
    "MAX_SIM": "maxsim_cosine",
    "MAX_SIM_COSINE": "maxsim_cosine",
    "MAX_SIM_IP": "maxsim_ip",
    "MAX_SIM_L2": "maxsim_l2",
    "MAX_SIM_HAMMING": "maxsim_hamming",
    "MAX_SIM_JACCARD": "maxsim_jaccard",
}

# Keys of a search request that are not index parameters.
RESERVED_KEYS = frozenset(
    "vectorField outputFields expr filter metricType metric_type params offset groupByField groupingField "
    "groupSize strictGroupSize ignoreGrowing collectionName partitionNames consistencyLevel".split()
)


def metric_name(name: str | None) -> str:
    """Resolve a metric name; an unknown or missing one means L2."""
    if not name:
        return "l2"
    if name in (*DENSE, *BINARY) or name.startswith("maxsim_"):
        return name
    return METRIC_NAMES.get(name.upper(), "l2")


@dataclass(frozen=True)
class SearchParams:
    """Settings of one search after the request's aliases and nesting are resolved."""

    filter: str | None = None
    metric: str = "l2"
    offset: int = 0
    group_by: str | None = None
    group_size: int = 1
    strict: bool = False
    output_fields: tuple[str, ...] = ()
    index: Mapping[str, object] | None = None


def search_params(request: Mapping[str, object]) -> SearchParams:
    """Read a request mapping: ``expr`` beats ``filter``, ``metric_type`` beats ``metricType``,
    ``groupByField`` beats ``groupingField``; top-level index parameters beat nested ``params``."""
    nested = dict(request.get("params") or {})
    index = {**nested, **{k: v for k, v in request.items() if k not in RESERVED_KEYS}}
    return SearchParams(
        filter=request.get("expr") or request.get("filter") or None,
        metric=metric_name(request.get("metric_type") or request.get("metricType")),
        offset=int(request.get("offset") or 0),
        group_by=request.get("groupByField") or request.get("groupingField") or None,
        group_size=int(request.get("groupSize") or 1),
        strict=bool(request.get("strictGroupSize") or False),
        output_fields=tuple(request.get("outputFields") or ()),
        index=index,
    )


def kernel_for(metric: str) -> blocks.Kernel:
    if metric in DENSE:
        return blocks.DenseKernel(metric)
    if metric in BINARY:
        return blocks.BinaryKernel(metric)
    if metric.startswith("maxsim_"):
        return blocks.MaxSimKernel(metric.removeprefix("maxsim_"))
    raise ValueError(f"unknown metric {metric}")


def similarity(metric: str) -> bool:
    """Whether higher scores are better."""
    return metric.removeprefix("maxsim_") in SIMILARITIES


def score_of(metric: str) -> Column:
    return (-F.col("cost") + F.lit(0.0) if similarity(metric) else F.col("cost")).alias("score")


def cost_bytes(vector: str, metric: str) -> Column:
    """Size of one query vector in a block."""
    if metric in BINARY:
        return F.octet_length(vector) * 64
    if metric.startswith("maxsim_"):
        inner = (lambda v: F.octet_length(v) * 64) if metric.split("_")[1] in BINARY else (lambda v: F.size(v) * 8)
        return F.aggregate(F.col(vector), F.lit(0), lambda acc, v: acc + inner(v))
    return F.size(vector) * 8


def query_volume(queries: DataFrame, bytes_of: Column) -> tuple[int, bool]:
    """Number of queries (counted no further than the broadcast bound) and whether they fit it."""
    n, volume = queries.select(bytes_of.alias("b")).limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.sum("b")).first()
    return n, n <= BROADCAST_ROWS and (volume or 0) <= BROADCAST_BYTES


def pair(base: DataFrame, queries: DataFrame, key: str, qid: str, bytes_of: Column, volume: tuple[int, bool], strategy: str = "auto",
         base_rows: int = blocks.BASE_ROWS, query_rows: int = blocks.QUERY_ROWS, hits: int = 0) -> blocks.SmallQueries | blocks.Grid:
    """All base rows with all queries: broadcast when the queries are proven small, else dealt over a grid of tasks."""
    if volume[1] and strategy != "shuffle":
        return blocks.pair_small_queries(base, queries, base_rows, query_rows)
    return blocks.pair_grid(base, queries, key, qid, grid_of(base, queries, bytes_of, hits), base_rows, query_rows)


def grid_of(base: DataFrame, queries: DataFrame, bytes_of: Column, hits: int = 0, whole: bool = False) -> tuple[int, int]:
    """Shape of the grid for the counted rows of both sides; ``hits`` are kept per query of a part (see ``grid_shape``)."""
    n, volume = queries.select(bytes_of.alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    return blocks.grid_shape(base.count(), n, (volume or 0) / max(n, 1), base.sparkSession.sparkContext.defaultParallelism, hits * blocks.HIT_BYTES, whole)


def nearest(base: DataFrame, queries: DataFrame, k: int, kernel: blocks.Kernel, keys: Sequence[str], qid: str,
            bytes_of: Column, group: str | None = None, radius: float | None = None, carry: Sequence[str] = (),
            strategy: str = "auto", prune: str | None = None, base_rows: int = blocks.BASE_ROWS,
            query_rows: int = blocks.QUERY_ROWS) -> DataFrame:
    """``(qid, keys…, cost, rank)``: top-k rows, or the best row of the top-k groups.

    Large query sets on a metric with distance bounds take a pruned cell join where that moves fewer rows (bit blocks
    for Hamming and Jaccard), others meet block by block on a grid of tasks, each of which holds one part of the queries.
    A query side that a forced ``broadcast`` or ``seeded`` finds too large for one task goes to the grid as well. A table of very many partitions is seeded: some of its partitions are searched
    first, and their k-th cost bounds what the others need to emit. ``strategy`` can force
    ``broadcast``, ``seeded``, ``shuffle`` or ``cells``.
    """
    order = ["cost", *keys]
    options = dict(keys=[base.schema[c] for c in keys], qid=queries.schema[qid], group=base.schema[group] if group else None,
                   carry=[base.schema[c] for c in carry], radius=radius)
    volume = query_volume(queries, bytes_of)
    if prune and group is None and (strategy == "cells" or (strategy == "auto" and not volume[1])):
        if prune in BINARY:
            hits = bitcells.exact_bits(base, queries, k, prune, keys[0], qid, options, base_rows, query_rows)
        else:
            hits = cells.exact_cells(base, queries, k, kernel, prune, keys[0], qid, options, base_rows, query_rows,
                                     grid=grid_of(base, queries, bytes_of, k), judge=strategy == "auto")
        return blocks.best_per(hits, [qid], k, order)
    if group is None and (strategy == "seeded" or (strategy == "auto" and volume[1] and blocks.wide(base))):
        some = blocks.score_blocks(pair(blocks.some_partitions(base), queries, keys[0], qid, bytes_of, volume, strategy, base_rows, query_rows),
                                   kernel, k, **options)
        kth = blocks.best_per(some, [qid], k, order).filter(F.col("rank") == k).select(qid, F.col("cost").alias("tau"))
        queries = materialize(queries.join(kth, qid, "left").withColumn("tau", F.coalesce("tau", F.lit(float("inf")))), "seeded")
    wide = widen(base) if volume[1] else base
    pairs = pair(wide, queries, keys[0], qid, bytes_of, volume, strategy, base_rows, query_rows, k)
    hits = blocks.score_blocks(pairs, kernel, k, **options)
    if group:
        hits = blocks.best_per(hits, [qid, group], 1, order, "__best").drop("__best")
    return blocks.best_per(hits, [qid], k, order)


def _sides(base, queries, id, vector, qid, query_vector, metric, extra=()):
    """Narrow both sides to what ranking needs; multi-vector rows without elements cannot be hits."""
    b = base.select(id, *[c for c in extra if c != id], F.col(vector).alias("vector"))
    q = queries.select(qid, F.col(query_vector).alias("vector"))
    if metric.startswith("maxsim_"):
        b, q = b.filter(F.size("vector") > 0), q.filter(F.size("vector") > 0)
    else:
        b, q = b.filter(F.col("vector").isNotNull()), q.filter(F.col("vector").isNotNull())
    return b, q


def fetch_fields(hits: DataFrame, base: DataFrame, id: str, fields: Sequence[str]) -> DataFrame:
    """Join the winners back for other columns, so that wide rows never enter the ranking shuffle."""
    extra = [f for f in fields if f not in hits.columns]
    return hits.join(base.select(id, *extra), id) if extra else hits


def knn(base: DataFrame, queries: DataFrame, k: int, metric: str = "l2", *, id: str = "id", vector: str = "vector",
        qid: str = "qid", query_vector: str | None = None, filter: Column | str | None = None, offset: int = 0,
        output_fields: Sequence[str] = (), radius: float | None = None, strategy: str = "auto",
        base_rows: int = blocks.BASE_ROWS, query_rows: int = blocks.QUERY_ROWS) -> DataFrame:
    """Exact top-k for a batch of queries: ``(qid, rank, id, score, fields…)``.

    ``radius`` keeps only scores above it (similarities) or distances below it. With ``offset`` the
    ranks ``offset+1 … offset+k`` are returned.
    """
    metric = metric_name(metric)
    if k < 1 or offset < 0:
        raise ValueError("k must be positive and offset not negative")
    source = base.filter(filter) if filter is not None else base
    b, q = _sides(source, queries, id, vector, qid, query_vector or vector, metric)
    bound = None if radius is None else (-radius if similarity(metric) else radius)
    hits = nearest(b, q, k + offset, kernel_for(metric), [id], qid, cost_bytes("vector", metric), radius=bound,
                   strategy=strategy, prune=metric if metric in (*DENSE, *BINARY) else None, base_rows=base_rows, query_rows=query_rows)
    hits = hits.filter(F.col("rank") > offset) if offset else hits
    hits = hits.select(qid, "rank", id, score_of(metric))
    return fetch_fields(hits, source, id, output_fields)


def grouped_knn(base: DataFrame, queries: DataFrame, k: int, group_by: str, metric: str = "l2", *, group_size: int = 1,
                strict: bool = False, id: str = "id", vector: str = "vector", qid: str = "qid",
                query_vector: str | None = None, filter: Column | str | None = None, strategy: str = "auto") -> DataFrame:
    """The ``k`` best groups per query with up to ``group_size`` rows each.

    Groups rank by their best row. ``strict`` drops groups that cannot fill ``group_size`` after
    filtering, before the cut to ``k`` groups. Result ``(qid, rank, group_rank, group_value, id, score)``.
    """
    metric = metric_name(metric)
    source = base.filter(filter) if filter is not None else base
    b, q = _sides(source, queries, id, vector, qid, query_vector or vector, metric)
    value = F.col(group_by)
    rows = source.filter(F.col(vector).isNotNull()).select(
        F.col(id), F.concat(F.lit("v"), value.cast("string")).alias("__g"), F.col(vector).alias("vector"),
        value.alias("group_value"))
    rows = rows.withColumn("__g", F.coalesce("__g", F.lit("null")))
    if strict:
        full = rows.groupBy("__g").count().filter(F.col("count") >= group_size).select("__g")
        rows = skew_join(rows, full, "__g", F.col(id), "left_semi").select(id, "__g", "vector", "group_value")
    kernel, size = kernel_for(metric), cost_bytes("vector", metric)
    narrow = rows.select(id, "__g", "group_value", "vector")
    best = nearest(narrow, q, k, kernel, [id], qid, size, group="__g", carry=["group_value"], strategy=strategy)
    best = best.withColumnRenamed("rank", "group_rank")
    if group_size == 1:
        return best.select(qid, F.col("group_rank").alias("rank"), "group_rank", "group_value", id, score_of(metric))
    winners = best.select(qid, F.col("__g").alias("cell"), "group_rank")
    winners = materialize(winners, "groups")
    members = blocks.pair_cells(narrow.withColumnRenamed("__g", "cell"),
                                winners.join(q, qid).select("cell", qid, "group_rank", "vector"), id, qid)
    hits = blocks.score_blocks(members, kernel, group_size, [narrow.schema[id]], q.schema[qid], carry=[narrow.schema["group_value"]])
    hits = hits.withColumn("cell", F.coalesce(F.concat(F.lit("v"), F.col("group_value").cast("string")), F.lit("null")))
    hits = blocks.best_per(hits, [qid, "cell"], group_size, ["cost", id], "__member").join(winners, [qid, "cell"])
    order = Window.partitionBy(qid).orderBy("group_rank", "__member")
    return hits.select(qid, F.row_number().over(order).alias("rank"), "group_rank", "group_value", id, score_of(metric))


def run_request(base: DataFrame, queries: DataFrame, request: Mapping[str, object], k: int, *, id: str = "id", qid: str = "qid",
                query_vector: str | None = None) -> DataFrame:
    """Run a request mapping (see ``search_params``) over a batch of queries; its filter is a SQL expression.

    ``vectorField`` names the searched column. A grouped request gives the columns of ``grouped_knn``, and its
    offset leaves out groups.
    """
    p, vector = search_params(request), request.get("vectorField") or "vector"
    asked = dict(id=id, vector=vector, qid=qid, query_vector=query_vector or ("vector" if "vector" in queries.columns else vector), filter=p.filter)
    if not p.group_by:
        return knn(base, queries, k, p.metric, offset=p.offset, output_fields=p.output_fields, **asked)
    hits = grouped_knn(base, queries, k + p.offset, p.group_by, p.metric, group_size=p.group_size, strict=p.strict, **asked)
    return fetch_fields(hits.filter(F.col("group_rank") > p.offset) if p.offset else hits, base, id, p.output_fields)


def elements(df: DataFrame, id: str, array: str, predicate=None, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (matching) element of a struct array, with its 0-based position in the stored array."""
    rows = df.select(id, *keep, F.posexplode(array).alias("pos", "element"))
    return rows if predicate is None else rows.filter(predicate(F.col("element")))


def element_knn(base: DataFrame, queries: DataFrame, k: int, metric: str = "l2", *, array: str, vector: str,
                id: str = "id", qid: str = "qid", query_vector: str = "vector", predicate=None,
                one_per_row: bool = False, strategy: str = "auto") -> DataFrame:
    """Every (matching) element of a struct array is a candidate: ``(qid, rank, id, pos, score)``.

    ``one_per_row`` keeps the best element of each row and ranks ``k`` rows.
    """
    metric = metric_name(metric)
    rows = elements(base, id, array, predicate).select(id, "pos", F.col(f"element.{vector}").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull())
    q = queries.select(qid, F.col(query_vector).alias("vector"))
    if one_per_row:
        rows = rows.select(id, "pos", F.col(id).alias("__g"), "vector")
    hits = nearest(rows, q, k, kernel_for(metric), [id, "pos"], qid, cost_bytes("vector", metric),
                   group="__g" if one_per_row else None, strategy=strategy)
    return hits.select(qid, "rank", id, "pos", score_of(metric))


def search_variants(base: DataFrame, queries: DataFrame, variants: Sequence[tuple[str, Column | None, int | None]],
                    k: int = 10, metric: str = "l2", *, id: str = "id", vector: str = "vector", qid: str = "qid",
                    query_vector: str | None = None) -> DataFrame:
    """Several (name, filter, top-k) searches over one scan and one scoring pass.

    Blocks carry one membership flag per variant; each pair of blocks is multiplied once and
    ranked once per variant. Result ``(variant, qid, rank, id, score)``.
    """
    metric = metric_name(metric)
    sizes = [(name, top or k) for name, _, top in variants]
    flags = [F.coalesce(cond if cond is not None else F.lit(True), F.lit(False)).alias(f"in_{i}")
             for i, (_, cond, _) in enumerate(variants)]
    q = queries.select(qid, F.col(query_vector or vector).alias("vector"))
    rows = base.select(id, F.col(vector).alias("vector"), *flags)
    rows = rows.filter(" or ".join(f"in_{i}" for i in range(len(flags)))).filter(F.col("vector").isNotNull())
    size = cost_bytes("vector", metric)
    pairs = pair(rows, q, id, qid, size, query_volume(q, size))
    hits = blocks.score_blocks(pairs, kernel_for(metric), k, [base.schema[id]], queries.schema[qid], variants=sizes)
    window = Window.partitionBy("variant", qid).orderBy("cost", id)
    top = F.element_at(F.create_map(*[x for name, size in sizes for x in (F.lit(name), F.lit(size))]), F.col("variant"))
    ranked = hits.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= max(s for _, s in sizes))
    return ranked.filter(F.col("rank") <= top).select("variant", qid, "rank", id, score_of(metric))


def empty_queries(queries: DataFrame, hits: DataFrame, qid: str = "qid") -> DataFrame:
    """Per query the number of hits and whether the answer is empty."""
    found = hits.groupBy(qid).agg(F.count(F.lit(1)).alias("n_hits"))
    n = F.coalesce(F.col("n_hits"), F.lit(0))
    return queries.select(qid).join(found, qid, "left").select(qid, n.alias("n_hits"), (n == 0).alias("is_empty"))


def scalar_query(df: DataFrame, filter: Column | str | None = None, output_fields: Sequence[str] = ("id",),
                 order_by: str = "id", limit: int | None = None, offset: int = 0) -> DataFrame:
    """Filter, project and page, ordered by primary key."""
    rows = df.filter(filter) if filter is not None else df
    fields = list(dict.fromkeys([order_by, *output_fields]))
    rows = rows.select(*fields)
    if limit is None and not offset:
        return rows.select(*output_fields)
    rows = rows.orderBy(order_by)
    rows = rows.offset(offset) if offset else rows
    rows = rows.limit(limit) if limit is not None else rows
    return rows.select(*output_fields)


def get_by_ids(df: DataFrame, ids: DataFrame | Sequence, id: str = "id", output_fields: Sequence[str] | None = None) -> DataFrame:
    """Rows by primary key, from a literal list (pushed to the scan) or a frame of ids (semi join)."""
    if isinstance(ids, DataFrame):
        rows = df.join(broadcast_if_small(ids.select(id)), id, "left_semi")
    else:
        rows = df.filter(F.col(id).isin(list(ids)))
    return rows.select(*output_fields) if output_fields else rows
