"""Queries for ground truth and recall: hits are a filtered search, truth is the unfiltered one."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.operators import cells, quality, search
from nearfield.plans.registry import query, rounded
from nearfield.plans.search_queries import EMB, asked, scaled

TH = f"""{EMB}, s AS (SELECT q.vec_id AS qid, b.vec_id, b.label, q.label AS qlabel, list_distance(q.v, b.v) AS c FROM emb q, emb b),
t AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS tr FROM s),
h AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS hr FROM s WHERE label <> 3),
truth AS (SELECT * FROM t WHERE tr <= 10), hits AS (SELECT * FROM h WHERE hr <= 10),
m AS (SELECT h.qid, hr, tr FROM hits h JOIN truth USING (qid, vec_id)),
rc AS (SELECT e.vec_id AS qid, count(m.qid) AS found, count(m.qid) / 10.0::DOUBLE AS recall FROM emb e LEFT JOIN m ON m.qid = e.vec_id GROUP BY 1)"""


def hits_and_truth(spark, sf_dir, k=10):
    base = scaled(spark, sf_dir)
    truth = search.knn(base, asked(base), k, "l2", id="vec_id")
    hits = search.knn(base, asked(base), k, "l2", id="vec_id", filter=F.col("label") != 3)
    return base, hits, truth


def recalls(spark, sf_dir):
    base, hits, truth = hits_and_truth(spark, sf_dir)
    return quality.recall_at_k(hits, truth, 10, asked(base), id="vec_id")


for _metric, _dist in (("L2", "list_distance(q.v, b.v)"), ("COSINE", "1 - list_cosine_similarity(q.v, b.v)")):

    @query("ground_truth" if _metric == "L2" else "ground_truth_cosine",
           f"""WITH {EMB}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, b.vec_id, {_dist} AS c FROM emb q, emb b))
SELECT query_id, string_agg(vec_id, ',' ORDER BY rank) AS neighbors, round(max(c), 6) + 0.0 AS farthest, round(sum(c), 6) + 0.0 AS total FROM r WHERE rank <= 10 GROUP BY query_id""")
    def ground_truth(spark, sf_dir, metric=_metric):
        base = scaled(spark, sf_dir)
        rows = quality.ground_truth(base, asked(base), 10, metric, id="vec_id")
        return rows.select("query_id", F.array_join("neighbors", ",").alias("neighbors"), rounded(F.array_max("distances")).alias("farthest"),
                           rounded(F.aggregate("distances", F.lit(0.0), lambda a, x: a + x)).alias("total"))


@query("recall_at_k", f"WITH {TH} SELECT qid, found, round(recall, 6) AS recall FROM rc")
def recall_at_k(spark, sf_dir):
    return recalls(spark, sf_dir).withColumn("recall", F.round("recall", 6))


@query("recall_expected", f"WITH {TH} SELECT qid, found, 10::BIGINT AS expected, round(recall, 6) AS recall FROM rc")
def recall_expected(spark, sf_dir):
    _, hits, truth = hits_and_truth(spark, sf_dir)
    return quality.recall_expected(hits, truth, id="vec_id").withColumn("recall", F.round("recall", 6))


@query("recall_by_topk", f"""WITH {TH} SELECT e.vec_id AS qid, 10::BIGINT AS expected, top_k, count(m.qid) AS found, round(count(m.qid) / least(top_k, 10)::DOUBLE, 6) AS recall
FROM emb e CROSS JOIN (VALUES (1), (5), (10), (50)) k(top_k) LEFT JOIN m ON m.qid = e.vec_id AND hr <= top_k GROUP BY 1, 3""")
def recall_by_topk(spark, sf_dir):
    _, hits, truth = hits_and_truth(spark, sf_dir)
    return quality.recall_by_topk(hits, truth, [1, 5, 10, 50], id="vec_id").withColumn("recall", F.round("recall", 6))


@query("recall_multi_k", f"""WITH {TH} SELECT e.vec_id AS qid, top_k, count(m.qid) AS found, round(count(m.qid) * 100.0 / top_k, 6)::DOUBLE AS recall_pct
FROM emb e CROSS JOIN (VALUES (1), (5), (10)) k(top_k) LEFT JOIN m ON m.qid = e.vec_id AND greatest(hr, tr) <= top_k GROUP BY 1, 2""")
def recall_multi_k(spark, sf_dir):
    base, hits, truth = hits_and_truth(spark, sf_dir)
    rows = quality.recall_multi_k(hits, truth, [1, 5, 10, min(10, 20)], asked(base), id="vec_id")
    return rows.withColumn("recall_pct", F.round("recall_pct", 6))


@query("recall_summary", f"WITH {TH} SELECT count(*) AS n, round(avg(recall), 6) AS avg_recall, min(recall) AS min_recall, round(quantile_cont(recall, 0.95), 6) AS p95_recall FROM rc")
def recall_summary(spark, sf_dir):
    rows = quality.recall_summary(recalls(spark, sf_dir))
    return rows.withColumn("avg_recall", F.round("avg_recall", 6)).withColumn("p95_recall", F.round("p95_recall", 6))


@query("recall_histogram", f"WITH {TH} SELECT least(found, 9)::INTEGER AS bucket, count(*) AS n_queries FROM rc GROUP BY 1")
def recall_histogram(spark, sf_dir):
    return quality.recall_histogram(recalls(spark, sf_dir), 10)


@query("low_recall_rate", f"WITH {TH} SELECT count(*) AS n, count(*) FILTER (WHERE recall < 0.9) AS n_low, round(avg((recall < 0.9)::INTEGER::DOUBLE), 6) AS low_rate FROM rc")
def low_recall_rate(spark, sf_dir):
    return quality.low_recall_rate(recalls(spark, sf_dir), 0.9).withColumn("low_rate", F.round("low_rate", 6))


@query("recall_gates", f"""WITH {TH}, g(gate, minimum) AS (VALUES ('query', 0.8::DOUBLE), ('query', 1.0), ('mean', 0.9), ('mean', 0.95), ('mean', 1.0))
SELECT gate, minimum, count(*) FILTER (WHERE recall >= minimum) AS n_passed, CASE WHEN gate = 'query' THEN bool_and(recall >= minimum) ELSE avg(recall) >= minimum - 1e-12 END AS passed
FROM rc, g GROUP BY gate, minimum""")
def recall_gates(spark, sf_dir):
    return quality.recall_gates(recalls(spark, sf_dir))


@query("group_purity", f"WITH {TH} SELECT qid, count(*) AS n, count(*) FILTER (WHERE label = qlabel) AS own_group, round(avg((label = qlabel)::INTEGER::DOUBLE), 6) AS purity FROM truth GROUP BY qid")
def group_purity(spark, sf_dir):
    base, _, truth = hits_and_truth(spark, sf_dir)
    rows = quality.group_purity(truth, base, asked(base, "label"), id="vec_id", group="label")
    return rows.withColumn("purity", F.round("purity", 6))


@query("index_comparison")
def index_comparison(spark, sf_dir):
    base = scaled(spark, sf_dir)
    truth = search.knn(base, asked(base), 10, "l2", id="vec_id")
    index = cells.build_cells(base, 16, "l2", id="vec_id")
    grid = {f"nlist=16,nprobe={p}": cells.ivf_search(index, asked(base), 10, p) for p in (1, 4, 16)}
    rows = quality.compare_searches(grid, truth, 10, id="vec_id")
    return rows.select("search", "n", *[F.round(c, 6).alias(c) for c in ("avg_recall", "min_recall", "p95_recall")])
