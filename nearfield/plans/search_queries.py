"""Queries of the search family. Every row of the table is a query against the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.functions import predicates as P
from nearfield.functions import vectors as V
from nearfield.functions.sqlfuncs import register_functions
from nearfield.operators import cells, fulltext, fusion, search
from nearfield.plans.registry import query, ranked, rounded, table
from nearfield.sources.ann_dataset import read_vectors

K = 10

# ---------------------------------------------------------------- inputs


def scaled(spark, sf_dir):
    """Embeddings with differing lengths, so that L2, inner product and cosine rank differently."""
    df = table(spark, sf_dir, "embeddings")
    v = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    return df.select("vec_id", "label", v.alias("vector"))


def asked(df, *extra):
    return df.select(F.col("vec_id").alias("qid"), "vector", *extra)


def packed_bits(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    return V.binarize_vectors(df, "embedding").select("vec_id", "label", "bits")


def sparse_vectors(spark, sf_dir):
    """Entries above 0.15 in magnitude, keyed by 0-based position."""
    df = table(spark, sf_dir, "embeddings")
    entries = F.transform("embedding", lambda x, i: F.struct(i.alias("p"), x.cast("double").alias("x")))
    kept = F.filter(entries, lambda e: F.abs(e.x) > 0.15)
    return df.select("vec_id", "label", F.map_from_entries(kept).alias("sparse"))


def vector_groups(spark, sf_dir):
    """Five consecutive vectors form the struct array of one row."""
    df = table(spark, sf_dir, "embeddings")
    gid = F.floor(F.col("vec_id") / 5).alias("gid")
    parts = F.array_sort(F.collect_list(F.struct("vec_id", "label", "embedding")))
    return df.groupBy(gid).agg(parts.alias("parts"))


EMB = """emb AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v FROM embeddings)"""

DIST = {"l2": "list_distance({a}, {b})", "ip": "-list_inner_product({a}, {b})", "cosine": "-list_cosine_similarity({a}, {b})"}


def knn_sql(metric: str, base: str = "emb", k: int = K, offset: int = 0, where: str = "true", extra: str = "") -> str:
    """Ranked pairs of all queries with a base relation, as CTE bodies ``s`` and ``r``."""
    cost = DIST[metric].format(a="q.v", b="b.v")
    score = "c" if metric == "l2" else "-c"
    return f"""s AS (SELECT q.vec_id AS qid, b.*, {cost} AS c FROM emb q, {base} b WHERE {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS rank FROM s),
h AS (SELECT qid, rank, vec_id{extra}, round({score}, 6) + 0.0 AS score FROM r WHERE rank > {offset} AND rank <= {offset + k})"""


# ---------------------------------------------------------------- dense search

for _metric in ("l2", "ip", "cosine"):

    @query(f"knn_{_metric}", f"WITH {EMB}, {knn_sql(_metric)} SELECT * FROM h")
    def knn_metric(spark, sf_dir, metric=_metric):
        base = scaled(spark, sf_dir)
        return ranked(search.knn(base, asked(base), K, metric, id="vec_id"))


def shifted(spark, sf_dir):
    """Small differences around a point far from the origin."""
    v = F.transform("embedding", lambda x: x.cast("double") * F.lit(0.001) + F.lit(10_000.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", v.alias("vector"))


_SHIFTED = "emb AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 0.001::DOUBLE + 10000.0::DOUBLE) AS v FROM embeddings)"

for _strategy in ("broadcast", "cells"):

    @query(f"knn_l2_shifted_{_strategy}", f"WITH {_SHIFTED}, {knn_sql('l2')} SELECT qid, rank, vec_id FROM h")
    def knn_l2_shifted(spark, sf_dir, strategy=_strategy):
        base = shifted(spark, sf_dir)
        return ranked(search.knn(base, asked(base), K, "l2", id="vec_id", strategy=strategy)).drop("score")


@query("knn_filtered", f"WITH {EMB}, {knn_sql('l2', where='b.label IN (1, 3, 5)')} SELECT * FROM h")
def knn_filtered(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "l2", id="vec_id", filter=P.one_of("label", [1, 3, 5])))


@query("knn_offset", f"WITH {EMB}, {knn_sql('cosine', offset=5)} SELECT * FROM h")
def knn_offset(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "cosine", id="vec_id", offset=5))


@query("knn_output_fields", f"WITH {EMB}, {knn_sql('l2', extra=', label')} SELECT h.*, round(list_sum(e.v), 6) + 0.0 AS total FROM h JOIN emb e USING (vec_id)")
def knn_output_fields(spark, sf_dir):
    base = scaled(spark, sf_dir)
    wide = base.withColumn("total", F.aggregate("vector", F.lit(0.0), lambda a, x: a + x))
    hits = search.knn(wide, asked(base), K, "l2", id="vec_id", output_fields=["label", "total"])
    return ranked(hits.withColumn("total", rounded("total")), "label", "total")


@query("range_search", f"WITH {EMB}, {knn_sql('cosine', where='list_cosine_similarity(q.v, b.v) > 0.2')} SELECT * FROM h")
def range_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "cosine", id="vec_id", radius=0.2))


@query("range_search_cells", f"WITH {EMB}, {knn_sql('l2', where='list_distance(q.v, b.v) < 6.0')} SELECT * FROM h")
def range_search_cells(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "l2", id="vec_id", radius=6.0, strategy="cells"))


@query("knn_in_partition", f"WITH {EMB}, {knn_sql('ip', where='b.label = 7')} SELECT * FROM h")
def knn_in_partition(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "ip", id="vec_id", filter=F.col("label") == 7))


def grouped_sql(size: int, where: str = "true", groups: int = 3) -> str:
    return f"""WITH {EMB},
s AS (SELECT q.vec_id AS qid, b.vec_id, b.label, list_distance(q.v, b.v) AS c FROM emb q, emb b WHERE {where}),
m AS (SELECT *, row_number() OVER (PARTITION BY qid, label ORDER BY c, vec_id) AS member FROM s),
g AS (SELECT qid, label, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS group_rank FROM m WHERE member = 1)
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY group_rank, member) AS rank, vec_id, group_rank,
       label AS group_value, round(c, 6) + 0.0 AS score
FROM m JOIN g USING (qid, label) WHERE member <= {size} AND group_rank <= {groups}"""


def _grouped(hits):
    return ranked(hits.withColumn("group_rank", F.col("group_rank").cast("bigint")), "group_rank", "group_value")


@query("knn_grouped", grouped_sql(1))
def knn_grouped(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return _grouped(search.grouped_knn(base, asked(base), 3, "label", "l2", id="vec_id"))


@query("knn_grouped_sized", grouped_sql(2))
def knn_grouped_sized(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return _grouped(search.grouped_knn(base, asked(base), 3, "label", "l2", group_size=2, id="vec_id"))


@query("knn_grouped_strict", grouped_sql(3, "b.label IN (SELECT label FROM emb WHERE v[1] > 0.3 GROUP BY label HAVING count(*) >= 3) AND b.v[1] > 0.3"))
def knn_grouped_strict(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return _grouped(search.grouped_knn(base, asked(base), 3, "label", "l2", group_size=3, strict=True, id="vec_id",
                                       filter=F.col("vector")[0] > 0.3))


@query("search_variants", f"""WITH {EMB},
s AS (SELECT q.vec_id AS qid, b.vec_id, b.label, list_distance(q.v, b.v) AS c FROM emb q, emb b),
u AS (SELECT 'plain' AS variant, 10 AS top, * FROM s UNION ALL SELECT 'low', 5, * FROM s WHERE label < 4
      UNION ALL SELECT 'band', 10, * FROM s WHERE label >= 2 AND label < 6),
r AS (SELECT *, row_number() OVER (PARTITION BY variant, qid ORDER BY c, vec_id) AS rank FROM u)
SELECT variant, qid, rank, vec_id, round(c, 6) + 0.0 AS score FROM r WHERE rank <= top""")
def search_variants(spark, sf_dir):
    base = scaled(spark, sf_dir)
    variants = [("plain", None, None), ("low", F.col("label") < 4, 5), ("band", P.between("label", 2, 6), None)]
    return ranked(search.search_variants(base, asked(base), variants, K, "l2", id="vec_id"), "variant")


@query("empty_queries", f"""WITH {EMB}, {knn_sql('cosine', where='list_cosine_similarity(q.v, b.v) > 0.3 AND b.label <> q.label')}
SELECT e.vec_id AS qid, count(h.vec_id) AS n_hits, count(h.vec_id) = 0 AS is_empty FROM emb e LEFT JOIN h ON h.qid = e.vec_id GROUP BY 1""".replace(
    "AND b.label <> q.label", "AND b.label = 3"))
def empty_queries(spark, sf_dir):
    base = scaled(spark, sf_dir)
    hits = search.knn(base, asked(base), K, "cosine", id="vec_id", radius=0.3, filter=F.col("label") == 3)
    return search.empty_queries(asked(base), hits)


# ---------------------------------------------------------------- binary, sparse, multi-vector

_BITS = """emb AS (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS v FROM embeddings)"""
_BOTH = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"
_PAIR_COUNTS = """p AS (SELECT q.vec_id AS qid, b.vec_id, list_sum(q.v) AS nq, list_sum(b.v) AS nb,
      list_inner_product(q.v::DOUBLE[], b.v::DOUBLE[]) AS n FROM emb q, emb b)"""


def binary_sql(cost: str) -> str:
    return f"""WITH {_BITS}, {_PAIR_COUNTS}, s AS (SELECT qid, vec_id, {cost} AS c FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS rank FROM s)
SELECT qid, rank, vec_id, round(c, 6) + 0.0 AS score FROM r WHERE rank <= {K}"""


BIT_COST = {"hamming": "(nq + nb - 2 * n)::DOUBLE",
            "jaccard": "CASE WHEN nq + nb - n = 0 THEN 0.0 ELSE 1.0 - n::DOUBLE / (nq + nb - n) END"}

for _metric in ("hamming", "jaccard"):

    @query(f"knn_{_metric}", binary_sql(BIT_COST[_metric]))
    def knn_bits(spark, sf_dir, metric=_metric):
        base = packed_bits(spark, sf_dir)
        queries = base.select(F.col("vec_id").alias("qid"), "bits")
        return ranked(search.knn(base, queries, K, metric, id="vec_id", vector="bits"))

    @query(f"knn_{_metric}_blocks", binary_sql(BIT_COST[_metric]))
    def knn_bit_blocks(spark, sf_dir, metric=_metric):
        base = packed_bits(spark, sf_dir)
        queries = base.select(F.col("vec_id").alias("qid"), "bits")
        return ranked(search.knn(base, queries, K, metric, id="vec_id", vector="bits", strategy="cells"))


SPARSE = """sp AS (SELECT vec_id, label, i - 1 AS p, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) t(i) WHERE abs(embedding[i]) > 0.15)"""
SPARSE_SCORES = """s AS (SELECT q.vec_id AS qid, b.vec_id, sum(q.x * b.x) AS sc FROM sp q JOIN sp b USING (p) GROUP BY 1, 2)"""


@query("sparse_ip_topk", f"""WITH {SPARSE}, {SPARSE_SCORES},
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 12) DESC, vec_id) AS rank FROM s)
SELECT qid, rank, vec_id, round(sc, 6) + 0.0 AS score FROM r WHERE rank <= {K}""")
def sparse_ip_topk(spark, sf_dir):
    base = sparse_vectors(spark, sf_dir)
    queries = base.select(F.col("vec_id").alias("qid"), "sparse")
    return ranked(fusion.sparse_search(base, queries, K, id="vec_id"))


@query("sparse_ip_dropped", f"""WITH {SPARSE},
o AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(x)) - 1 AS i, count(*) OVER (PARTITION BY vec_id) AS n FROM sp),
f AS (SELECT vec_id, abs(x) AS cut FROM o WHERE i = floor(n * 0.4)),
d AS (SELECT sp.* FROM sp JOIN f USING (vec_id) WHERE abs(x) >= cut),
s AS (SELECT q.vec_id AS qid, b.vec_id, sum(q.x * b.x) AS sc FROM d q JOIN sp b USING (p) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 12) DESC, vec_id) AS rank FROM s)
SELECT qid, rank, vec_id, round(sc, 6) + 0.0 AS score FROM r WHERE rank <= {K}""")
def sparse_ip_dropped(spark, sf_dir):
    base = sparse_vectors(spark, sf_dir)
    queries = base.select(F.col("vec_id").alias("qid"), "sparse")
    return ranked(fusion.sparse_search(base, queries, K, drop_ratio=0.4, id="vec_id"))


def maxsim_sql(element: str, agg: str, cost: str) -> str:
    return f"""WITH el AS (SELECT vec_id // 5 AS gid, vec_id, embedding::DOUBLE[] AS v,
  list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS bits FROM embeddings),
p AS (SELECT q.gid AS qid, q.vec_id AS qe, b.gid, {element} AS e FROM el q, el b),
m AS (SELECT qid, qe, gid, {agg}(e) AS e FROM p GROUP BY ALL),
s AS (SELECT qid, gid, sum(e) AS sc FROM m GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {cost}, gid) AS rank FROM s)
SELECT qid, rank, gid, round(sc, 6) + 0.0 AS score FROM r WHERE rank <= 5"""


_N = "list_inner_product(q.bits, b.bits)"
_T = "(list_sum(q.bits) + list_sum(b.bits))"
MAXSIM = {
    "cosine": maxsim_sql("list_cosine_similarity(q.v, b.v)", "max", "round(-sc, 12)"),
    "ip": maxsim_sql("list_inner_product(q.v, b.v)", "max", "round(-sc, 12)"),
    "l2": maxsim_sql("list_distance(q.v, b.v)", "min", "round(sc, 12)"),
    "hamming": maxsim_sql(f"{_T} - 2 * {_N}", "min", "round(sc, 12)"),
    "jaccard": maxsim_sql(f"CASE WHEN {_T} = {_N} THEN 0.0 ELSE 1.0 - {_N} / ({_T} - {_N}) END", "min", "round(sc, 12)"),
}

for _metric in MAXSIM:

    @query(f"maxsim_{_metric}", MAXSIM[_metric])
    def maxsim(spark, sf_dir, metric=_metric):
        groups = vector_groups(spark, sf_dir)
        if metric in search.BINARY:
            flat = V.binarize_vectors(table(spark, sf_dir, "embeddings"), "embedding")
            gid = F.floor(F.col("vec_id") / 5).alias("gid")
            rows = flat.groupBy(gid).agg(F.array_sort(F.collect_list(F.struct("vec_id", "bits"))).alias("e"))
            docs = rows.select("gid", F.col("e.bits").alias("vectors"))
        else:
            docs = groups.select("gid", F.col("parts.embedding").alias("vectors"))
        queries = docs.select(F.col("gid").alias("qid"), "vectors")
        return ranked(search.knn(docs, queries, 5, f"maxsim_{metric}", id="gid", vector="vectors"), id="gid")


def element_sql(where: str = "true", best: bool = False) -> str:
    dedup = "WHERE e = 1" if best else ""
    return f"""WITH el AS (SELECT vec_id, vec_id // 5 AS gid, row_number() OVER (PARTITION BY vec_id // 5 ORDER BY vec_id) - 1 AS pos,
  label, embedding::DOUBLE[] AS v FROM embeddings),
s AS (SELECT q.vec_id AS qid, b.gid, b.pos, list_distance(q.v, b.v) AS c FROM el q, el b WHERE {where}),
d AS (SELECT *, row_number() OVER (PARTITION BY qid, gid ORDER BY c, pos) AS e FROM s),
r AS (SELECT qid, gid, pos, c, row_number() OVER (PARTITION BY qid ORDER BY c, gid, pos) AS rank FROM d {dedup})
SELECT qid, rank, gid, pos, round(c, 6) + 0.0 AS score FROM r WHERE rank <= {K}"""


def _element_search(spark, sf_dir, **options):
    queries = read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding").select(
        F.col("id").alias("qid"), "vector")
    hits = search.element_knn(vector_groups(spark, sf_dir), queries, K, "l2", array="parts", vector="embedding",
                              id="gid", **options)
    return ranked(hits.withColumn("pos", F.col("pos").cast("bigint")), "pos", id="gid")


@query("element_search", element_sql())
def element_search(spark, sf_dir):
    return _element_search(spark, sf_dir)


@query("element_filter_search", element_sql("b.label >= 3 AND b.label < 7"))
def element_filter_search(spark, sf_dir):
    return _element_search(spark, sf_dir, predicate=lambda e: (e.label >= 3) & (e.label < 7))


@query("element_search_by_pk", element_sql(best=True))
def element_search_by_pk(spark, sf_dir):
    return _element_search(spark, sf_dir, one_per_row=True)


# ---------------------------------------------------------------- text and hybrid search

TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
DOCS = f"""dl AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM dl) GROUP BY ALL),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM dl),
dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term)"""
BM25 = f"""{DOCS},
qt AS (SELECT qid, term, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({TOKENS}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT post.doc_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(toks) / avgdl)) AS w
      FROM post JOIN dfs USING (term) JOIN dl USING (doc_id), st WHERE term IN (SELECT term FROM qt)),
bm AS (SELECT qid, doc_id, sum(qtf * w) AS sc FROM qt JOIN w USING (term) GROUP BY ALL)"""


@query("bm25_topk", f"""WITH {BM25},
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 9) DESC, doc_id) AS rank FROM bm)
SELECT qid, rank, doc_id, round(sc, 6) AS score FROM r WHERE rank <= {K}""")
def bm25_topk(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    return ranked(fulltext.bm25_search(docs, queries, K, id="doc_id"), id="doc_id")


@query("text_match_knn", f"""WITH {EMB}, m AS (SELECT emb.* FROM emb JOIN documents ON doc_id = vec_id WHERE list_has_any({TOKENS}, ['the', 'und'])),
{knn_sql('l2', base='m')} SELECT * FROM h""")
def text_match_knn(spark, sf_dir):
    base = scaled(spark, sf_dir)
    matching = table(spark, sf_dir, "documents").filter(P.text_match("text", "the und")).select(F.col("doc_id").alias("vec_id"))
    return ranked(search.knn(base.join(matching, "vec_id", "left_semi"), asked(base), K, "l2", id="vec_id"))


DENSE_BRANCH = """dn AS (SELECT qid, vec_id, sc, row_number() OVER (PARTITION BY qid ORDER BY {order}, vec_id) AS rank
  FROM (SELECT q.vec_id AS qid, b.vec_id, {sc} AS sc FROM emb q, emb b WHERE {where}))"""
SPARSE_BRANCH = """ss AS (SELECT qid, vec_id, sc, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 12) DESC, vec_id) AS rank FROM s)"""
FUSE_RRF = """f AS (SELECT qid, vec_id, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS sc FROM u GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sc DESC, vec_id) AS rank FROM f)
SELECT qid, rank, vec_id, round(sc, 6) AS score FROM r WHERE rank <= 10"""


def _branches(spark, sf_dir, dense_metric, **dense):
    base, sparse = scaled(spark, sf_dir), sparse_vectors(spark, sf_dir)
    return {
        "dense": search.knn(base, asked(base), 20, dense_metric, id="vec_id", **dense),
        "sparse": fusion.sparse_search(sparse, sparse.select(F.col("vec_id").alias("qid"), "sparse"), 20, id="vec_id"),
    }


@query("hybrid_rrf", f"""WITH {EMB}, {SPARSE}, {SPARSE_SCORES}, {SPARSE_BRANCH},
{DENSE_BRANCH.format(sc='list_cosine_similarity(q.v, b.v)', order='sc DESC', where='true')},
u AS (SELECT qid, vec_id, rank FROM dn WHERE rank <= 20 UNION ALL SELECT qid, vec_id, rank FROM ss WHERE rank <= 20), {FUSE_RRF}""")
def hybrid_rrf(spark, sf_dir):
    return ranked(fusion.rrf(_branches(spark, sf_dir, "cosine"), 10, id="vec_id"))


@query("hybrid_filtered", f"""WITH {EMB}, {SPARSE}, {SPARSE_SCORES}, {SPARSE_BRANCH},
{DENSE_BRANCH.format(sc='list_distance(q.v, b.v)', order='sc', where='b.label < 6')},
u AS (SELECT qid, vec_id, rank - 0 AS rank FROM dn WHERE rank > 3 AND rank <= 23 UNION ALL SELECT qid, vec_id, rank FROM ss WHERE rank <= 20), {FUSE_RRF}""")
def hybrid_filtered(spark, sf_dir):
    return ranked(fusion.rrf(_branches(spark, sf_dir, "l2", filter=F.col("label") < 6, offset=3), 10, id="vec_id"))


@query("hybrid_weighted", f"""WITH {EMB}, {SPARSE}, {SPARSE_SCORES}, {SPARSE_BRANCH},
{DENSE_BRANCH.format(sc='list_distance(q.v, b.v)', order='sc', where='true')},
u AS (SELECT qid, vec_id, 0.7::DOUBLE AS w, -sc AS s FROM dn WHERE rank <= 20 UNION ALL SELECT qid, vec_id, 0.3, sc FROM ss WHERE rank <= 20),
e AS (SELECT qid, w, min(s) AS lo, max(s) AS hi FROM u GROUP BY ALL),
f AS (SELECT qid, vec_id, round(sum(w * CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE (s - lo) / (hi - lo) END), 12) AS sc FROM u JOIN e USING (qid, w) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sc DESC, vec_id) AS rank FROM f)
SELECT qid, rank, vec_id, round(sc, 6) AS score FROM r WHERE rank <= 10""")
def hybrid_weighted(spark, sf_dir):
    return ranked(fusion.weighted(_branches(spark, sf_dir, "l2"), {"dense": 0.7, "sparse": 0.3}, 10,
                                  distances=("dense",), id="vec_id"))


@query("hybrid_dense_text", f"""WITH {EMB}, {BM25},
dn AS (SELECT qid, vec_id, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS rank FROM
  (SELECT item_id AS qid, b.vec_id, list_distance(q.v, b.v) AS c FROM benchmark JOIN emb q ON q.vec_id = item_id, emb b)),
tx AS (SELECT qid, doc_id AS vec_id, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 9) DESC, doc_id) AS rank FROM bm),
u AS (SELECT qid, vec_id, rank FROM dn WHERE rank <= 20 UNION ALL SELECT qid, vec_id, rank FROM tx WHERE rank <= 20), {FUSE_RRF}""")
def hybrid_dense_text(spark, sf_dir):
    base, items = scaled(spark, sf_dir), table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "qid")
    dense = search.knn(base, items.select("qid").join(asked(base), "qid"), 20, "l2", id="vec_id")
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "vec_id")
    words = fulltext.bm25_search(docs, items, 20, id="vec_id")
    return ranked(fusion.rrf({"dense": dense, "text": words}, 10, id="vec_id"))


# ---------------------------------------------------------------- cells

@query("ivf_search")
def ivf_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = cells.build_cells(base, 16, "l2", id="vec_id")
    return ranked(cells.ivf_search(index, asked(base), K, nprobe=4))


@query("ivf_search_all_cells", f"WITH {EMB}, {knn_sql('l2')} SELECT * FROM h")
def ivf_search_all_cells(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = cells.build_cells(base, 16, "l2", id="vec_id")
    return ranked(cells.ivf_search(index, asked(base), K, nprobe=16))


@query("sq8_search")
def sq8_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = cells.build_cells(base, 16, "l2", id="vec_id")
    return ranked(cells.sq8_search(index, asked(base), K, nprobe=4))


@query("pq_search")
def pq_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = cells.build_cells(base, 16, "l2", id="vec_id")
    return ranked(cells.pq_search(index, asked(base), K, nprobe=4, m=4, nbits=4))


@query("binary_ivf_search")
def binary_ivf_search(spark, sf_dir):
    base = packed_bits(spark, sf_dir)
    queries = base.select(F.col("vec_id").alias("qid"), "bits")
    return ranked(cells.binary_ivf_search(base, queries, K, nlist=8, nprobe=3, id="vec_id"))


@query("auto_search", f"WITH {EMB}, {knn_sql('l2')} SELECT * FROM h")
def auto_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(cells.auto_search(base, asked(base), K, "l2", id="vec_id"))


@query("knn_pruned_cells", f"WITH {EMB}, {knn_sql('l2')} SELECT * FROM h")
def knn_pruned_cells(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(search.knn(base, asked(base), K, "l2", id="vec_id", strategy="cells"))


# ---------------------------------------------------------------- vectors and SQL functions

@query("read_embeddings", "SELECT vec_id AS id, len(embedding)::BIGINT AS dim, round(embedding[1]::DOUBLE, 6) + 0.0 AS first_value FROM embeddings")
def read_embeddings(spark, sf_dir):
    df = read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id", "embedding")
    return df.select("id", F.size("vector").cast("bigint").alias("dim"),
                     rounded(F.col("vector")[0].cast("double")).alias("first_value"))


@query("vector_norms", f"""WITH {EMB} SELECT vec_id, round(sqrt(list_inner_product(v, v)), 6) AS norm,
round(CASE WHEN list_inner_product(v, v) = 0 THEN 0 ELSE v[1] / sqrt(list_inner_product(v, v)) END, 6) + 0.0 AS first_unit FROM emb""")
def vector_norms(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return base.select("vec_id", F.round(V.norm("vector"), 6).alias("norm"),
                       rounded(V.normalize("vector")[0]).alias("first_unit"))


@query("sparse_norms", f"WITH {SPARSE} SELECT vec_id, count(*) AS n_entries, round(sqrt(sum(x * x)), 6) AS norm FROM sp GROUP BY vec_id")
def sparse_norms(spark, sf_dir):
    df = sparse_vectors(spark, sf_dir).withColumn("json", F.to_json("sparse"))
    parsed = V.parse_sparse(df.select("vec_id", "json"), "json").filter(F.size("sparse") > 0)
    return parsed.select("vec_id", F.size("sparse").cast("bigint").alias("n_entries"),
                         F.round(V.sparse_norm("sparse"), 6).alias("norm"))


@query("sign_bits", f"""WITH {_BITS} SELECT vec_id, list_sum(v)::BIGINT AS n_set,
string_agg(b, '' ORDER BY i) AS hex FROM (SELECT vec_id, v, i, upper(printf('%02x', list_sum(list_transform(range(1, 9), lambda j: v[8 * i + j] * (1 << (8 - j))))::INTEGER)) AS b
FROM emb, range(0, 8) t(i)) GROUP BY vec_id, v""")
def sign_bits(spark, sf_dir):
    df = packed_bits(spark, sf_dir)
    digits = F.aggregate(F.split(F.hex("bits"), ""), F.lit(0),
                         lambda acc, h: acc + F.when(h == "", 0).otherwise(F.bit_count(F.conv(h, 16, 10).cast("int"))))
    return df.select("vec_id", digits.cast("bigint").alias("n_set"), F.hex("bits").alias("hex"))


@query("sql_vector_functions", f"""WITH {EMB}, {SPARSE} SELECT a.vec_id, round(list_distance(a.v, b.v), 6) AS l2, round(list_inner_product(a.v, b.v), 6) + 0.0 AS ip,
round(list_cosine_similarity(a.v, b.v), 6) + 0.0 AS cosine, round(sqrt(list_inner_product(a.v, a.v)), 6) AS norm,
round(coalesce((SELECT sum(x.x * y.x) FROM sp x JOIN sp y USING (p) WHERE x.vec_id = a.vec_id AND y.vec_id = b.vec_id), 0), 6) + 0.0 AS sparse
FROM emb a JOIN emb b ON b.vec_id = a.vec_id + 1""")
def sql_vector_functions(spark, sf_dir):
    register_functions(spark)
    pairs = scaled(spark, sf_dir).join(sparse_vectors(spark, sf_dir).select("vec_id", "sparse"), "vec_id")
    other = pairs.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vector").alias("other"), F.col("sparse").alias("other_sparse"))
    return pairs.join(other, "vec_id").selectExpr(
        "vec_id", "round(vec_l2(vector, other), 6) AS l2", "round(vec_ip(vector, other), 6) + 0.0D AS ip",
        "round(vec_cosine(vector, other), 6) + 0.0D AS cosine", "round(vec_norm(vector), 6) AS norm",
        "round(sparse_ip(cast(sparse AS map<bigint,double>), cast(other_sparse AS map<bigint,double>)), 6) + 0.0D AS sparse")
