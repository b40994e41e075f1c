"""Queries on stored cell indexes. With fixed centres SQL can say which cells are probed; with all cells probed and a wide short list, codes are exact."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from nearfield.operators import indexes, search
from nearfield.plans.registry import query, ranked
from nearfield.plans.search_queries import EMB, K, asked, knn_sql, packed_bits, scaled
from nearfield.session import scratch_path

CELLS, PROBES = 16, (1, 4, 16)
# The first rows are the centres; a row lies in the cell of its nearest centre, a query probes cells in the order of their centres' distance.
CELL_SQL = f"""{EMB}, cen AS (SELECT vec_id AS cell, v FROM emb WHERE vec_id < {CELLS}),
lies AS (SELECT b.vec_id, arg_min(c.cell, list_distance(b.v, c.v)) AS cell FROM emb b, cen c GROUP BY b.vec_id),
pr AS (SELECT q.vec_id AS qid, c.cell, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, c.v), c.cell) AS probe FROM emb q, cen c),
near AS (SELECT pr.qid, l.vec_id, pr.probe, list_distance(q.v, b.v) AS c FROM pr JOIN lies l USING (cell) JOIN emb b ON b.vec_id = l.vec_id JOIN emb q ON q.vec_id = pr.qid)"""


def fixed_centers(base) -> np.ndarray:
    return np.array([r[0] for r in base.filter(F.col("vec_id") < CELLS).orderBy("vec_id").select("vector").collect()])


def built(spark, base, kind, **options):
    """Build an index in the shared folder and open it, as a later session would."""
    path = scratch_path(spark, f"index-{kind}")
    indexes.build_index(base, path, kind, nlist=CELLS, id="vec_id", **options)
    return indexes.open_index(spark, path)


@query("index_ivf_search", f"""WITH {CELL_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS rank FROM near WHERE probe <= 4)
SELECT qid, rank, vec_id, round(c, 6) + 0.0 AS score FROM r WHERE rank <= {K}""")
def index_ivf_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = built(spark, base, "flat", centers=fixed_centers(base))
    return ranked(indexes.search_index(index, asked(base), K, nprobe=4))


@query("index_settings_recall", f"""WITH {CELL_SQL}, t AS (SELECT q.vec_id AS qid, b.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, b.v), b.vec_id) AS rank FROM emb q, emb b),
s AS (SELECT nprobe, qid, vec_id, row_number() OVER (PARTITION BY nprobe, qid ORDER BY c, vec_id) AS rank FROM near, (VALUES {', '.join(f'({p})' for p in PROBES)}) n(nprobe) WHERE probe <= nprobe),
g AS (SELECT nprobe, qid, count(*) AS good FROM s JOIN t USING (qid, vec_id) WHERE s.rank <= {K} AND t.rank <= {K} GROUP BY ALL),
d AS (SELECT qid, nprobe, count(*) AS due FROM t, (VALUES {', '.join(f'({p})' for p in PROBES)}) n(nprobe) WHERE rank <= {K} GROUP BY ALL)
SELECT nprobe, count(*) AS n, round(avg(coalesce(good, 0) / due::DOUBLE), 6) AS avg_recall, round(min(coalesce(good, 0) / due::DOUBLE), 6) AS min_recall
FROM d LEFT JOIN g USING (nprobe, qid) GROUP BY nprobe""")
def index_settings_recall(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = built(spark, base, "flat", centers=fixed_centers(base))
    truth = search.knn(base, asked(base), K, "l2", id="vec_id")
    rows = indexes.settings_recall(index, asked(base), truth, K, PROBES)
    return rows.select("nprobe", "n", F.round("avg_recall", 6).alias("avg_recall"), F.round("min_recall", 6).alias("min_recall"))


@query("index_sq8_search", f"WITH {EMB}, {knn_sql('l2')} SELECT * FROM h")
def index_sq8_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(indexes.search_index(built(spark, base, "sq8"), asked(base), K, CELLS, refine=8))


@query("index_pq_search", f"WITH {EMB}, {knn_sql('cosine')} SELECT * FROM h")
def index_pq_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    return ranked(indexes.search_index(built(spark, base, "pq", metric="cosine", m=16, nbits=6), asked(base), K, CELLS, refine=40))


@query("index_filtered_search", f"WITH {EMB}, {knn_sql('ip', where='b.label <> 3')} SELECT * FROM h")
def index_filtered_search(spark, sf_dir):
    base = scaled(spark, sf_dir)
    index = built(spark, base, "flat", metric="ip", attributes=["label"])
    return ranked(indexes.search_index(index, asked(base), K, CELLS, filter=F.col("label") != 3))


_BITS = """bit AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings),
s AS (SELECT q.vec_id AS qid, b.vec_id, len(list_filter(list_zip(q.b, b.b), lambda p: p[1] <> p[2])) AS c FROM bit q, bit b),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY c, vec_id) AS rank FROM s)"""


@query("index_binary_search", f"WITH {_BITS} SELECT qid, rank, vec_id, round(c::DOUBLE, 6) + 0.0 AS score FROM r WHERE rank <= {K}")
def index_binary_search(spark, sf_dir):
    base = packed_bits(spark, sf_dir)
    index = built(spark, base, "binary")
    return ranked(indexes.search_index(index, base.select(F.col("vec_id").alias("qid"), "bits"), K, CELLS))
