"""Queries for filter conditions, scalar access and text analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.functions import predicates as P
from nearfield.functions.text import tokenize
from nearfield.operators import fulltext, search
from nearfield.plans.registry import query, rounded, table
from nearfield.plans.search_queries import DOCS, TOKENS


def turns(spark, sf_dir):
    """One row per conversation with its turns as a struct array (no texts), in order."""
    df = table(spark, sf_dir, "conversations")
    part = F.struct("turn", "role", F.length("text").alias("n"))
    return df.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("turns"))


TURN_LISTS = """c AS (SELECT conv_id, list({turn: turn, role: role, n: length(text)} ORDER BY turn) AS t,
  list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id)"""


@query("filter_compare", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size >= 20 AND p_retailprice < 950 AND p_brand > 'Brand#2' AND p_size <= 45 AND p_type = 'ECONOMY'")
def filter_compare(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "part")
    return df.filter((c("p_size") >= 20) & (c("p_retailprice") < 950) & (c("p_brand") > "Brand#2") & (c("p_size") <= 45)
                     & (c("p_type") == "ECONOMY")).select("p_partkey", "p_name", "p_size")


@query("filter_boolean", "SELECT c_custkey, c_acctbal FROM customer WHERE (c_acctbal > 5000 AND c_mktsegment = 'BUILDING') OR NOT (c_nationkey < 20)")
def filter_boolean(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "customer")
    return df.filter(((c("c_acctbal") > 5000) & (c("c_mktsegment") == "BUILDING")) | ~(c("c_nationkey") < 20)).select("c_custkey", "c_acctbal")


@query("filter_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 150000 AND o_custkey > 100 AND o_custkey < 900")
def filter_range(spark, sf_dir):
    cond = P.between("o_totalprice", 100000, 150000) & P.between("o_custkey", 100, 900, low_open=True)
    return table(spark, sf_dir, "orders").filter(cond).select("o_orderkey", "o_totalprice")


@query("filter_in", "SELECT p_partkey, p_size FROM part WHERE p_size IN (3, 14, 15, 49) AND p_brand IN ('Brand#1', 'Brand#12')")
def filter_in(spark, sf_dir):
    cond = P.one_of("p_size", [3, 14, 15, 49]) & P.one_of("p_brand", ["Brand#1", "Brand#12"])
    return table(spark, sf_dir, "part").filter(cond).select("p_partkey", "p_size")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' OR p_name LIKE '%wid_et'")
def filter_like(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    return df.filter(P.like("p_name", "small%") | P.like("p_name", "%wid_et")).select("p_partkey", "p_name")


@query("filter_json", """SELECT event_id, k FROM (SELECT event_id, cast(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events) WHERE k <= 30 AND k <> 7""")
def filter_json(spark, sf_dir):
    k = P.json_field("props", "$.k", "int")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k")).filter((F.col("k") <= 30) & (F.col("k") != 7))


@query("array_contains", f"WITH {TURN_LISTS} SELECT conv_id, len(t) AS n_turns FROM c WHERE list_contains(roles, 'system')")
def array_contains(spark, sf_dir):
    df = turns(spark, sf_dir).filter(P.contains(P.subfield("turns", "role"), "system"))
    return df.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"))


@query("array_contains_any", f"WITH {TURN_LISTS} SELECT conv_id, len(t) AS n_turns FROM c WHERE list_has_any(roles, ['system', 'tool'])")
def array_contains_any(spark, sf_dir):
    df = turns(spark, sf_dir).filter(P.contains_any(P.subfield("turns", "role"), ["system", "tool"]))
    return df.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"))


@query("array_contains_all", f"WITH {TURN_LISTS} SELECT conv_id, len(t) AS n_turns FROM c WHERE list_has_all(roles, ['system', 'assistant'])")
def array_contains_all(spark, sf_dir):
    df = turns(spark, sf_dir).filter(P.contains_all(P.subfield("turns", "role"), ["system", "assistant"]))
    return df.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"))


@query("array_length", f"WITH {TURN_LISTS} SELECT conv_id, len(t) AS n_turns FROM c WHERE len(t) >= 4")
def array_length(spark, sf_dir):
    df = turns(spark, sf_dir).filter(P.length(P.subfield("turns", "role")) >= 4)
    return df.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"))


@query("struct_index_in", f"WITH {TURN_LISTS} SELECT conv_id, roles[1] AS first_role, roles[7] AS seventh_role FROM c WHERE roles[1] IN ('system', 'assistant') OR roles[7] = 'user'")
def struct_index_in(spark, sf_dir):
    first, seventh = P.element("turns", 0, "role"), P.element("turns", 6, "role")
    df = turns(spark, sf_dir).filter(P.one_of(first, ["system", "assistant"]) | (seventh == "user"))
    return df.select("conv_id", first.alias("first_role"), seventh.alias("seventh_role"))


@query("struct_subfield", f"WITH {TURN_LISTS} SELECT conv_id, array_to_string(roles, ',') AS roles FROM c")
def struct_subfield(spark, sf_dir):
    return turns(spark, sf_dir).select("conv_id", F.array_join(P.subfield("turns", "role"), ",").alias("roles"))


_LONG_USER = "role = 'user' AND length(text) > 150"


def long_user(e):
    return (e.role == "user") & (e.n > 150)


@query("element_filter_query", f"""SELECT conv_id, pos, role, n FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, length(text) AS n, text
FROM conversations) WHERE {_LONG_USER}""")
def element_filter_query(spark, sf_dir):
    rows = P.element_rows(turns(spark, sf_dir), "turns", long_user, ["conv_id"])
    return rows.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "element.role", F.col("element.n").cast("bigint").alias("n"))


def _match_sql(having: str) -> str:
    return f"SELECT conv_id FROM conversations GROUP BY conv_id HAVING {having}"


@query("match_any", _match_sql(f"count(*) FILTER (WHERE {_LONG_USER}) >= 1"))
def match_any(spark, sf_dir):
    return turns(spark, sf_dir).filter(P.match_any("turns", long_user)).select("conv_id")


@query("match_least", _match_sql(f"count(*) FILTER (WHERE {_LONG_USER}) >= 2"))
def match_least(spark, sf_dir):
    return turns(spark, sf_dir).filter(P.match_least("turns", long_user, 2)).select("conv_id")


@query("match_all_most_exact", f"""SELECT conv_id, bool_and(length(text) > 30) AS all_long, count(*) FILTER (WHERE {_LONG_USER}) <= 1 AS at_most_one,
count(*) FILTER (WHERE {_LONG_USER}) = 2 AS exactly_two FROM conversations GROUP BY conv_id""")
def match_all_most_exact(spark, sf_dir):
    return turns(spark, sf_dir).select(
        "conv_id", P.match_all("turns", lambda e: e.n > 30).alias("all_long"), P.match_most("turns", long_user, 1).alias("at_most_one"),
        P.match_exact("turns", long_user, 2).alias("exactly_two"))


@query("text_match", f"SELECT doc_id, n_chars FROM documents WHERE list_has_any({TOKENS}, ['the', 'und'])")
def text_match(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(P.text_match("text", "The UND")).select("doc_id", "n_chars")


# ---------------------------------------------------------------- scalar access


@query("scalar_query", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 200000 ORDER BY o_orderkey LIMIT 100 OFFSET 50")
def scalar_query(spark, sf_dir):
    return search.scalar_query(table(spark, sf_dir, "orders"), F.col("o_totalprice") > 200000,
                               ["o_orderkey", "o_totalprice", "o_orderstatus"], "o_orderkey", limit=100, offset=50)


@query("get_by_ids", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)")
def get_by_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").filter("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return search.get_by_ids(table(spark, sf_dir, "customer"), ids, "c_custkey", ["c_custkey", "c_name"])


# ---------------------------------------------------------------- text


@query("tokenize_counts", f"SELECT doc_id, len({TOKENS}) AS n_tokens, len(list_distinct({TOKENS})) AS n_distinct FROM documents")
def tokenize_counts(spark, sf_dir):
    toks = tokenize("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(toks)).cast("bigint").alias("n_distinct"))


@query("term_stats", f"WITH {DOCS} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term")
def term_stats(spark, sf_dir):
    return fulltext.term_stats(table(spark, sf_dir, "documents"), "doc_id")


@query("postings", f"WITH {DOCS} SELECT doc_id, count(*) AS n_terms, sum(tf)::BIGINT AS n_tokens, max(tf) AS top_tf FROM post GROUP BY doc_id")
def postings(spark, sf_dir):
    rows = fulltext.postings(table(spark, sf_dir, "documents"), "doc_id")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_tokens"), F.max("tf").alias("top_tf"))


@query("bm25_encode", f"""WITH {DOCS}, w AS (SELECT post.doc_id, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(toks) / avgdl)) AS w
FROM post JOIN dfs USING (term) JOIN dl USING (doc_id), st)
SELECT d.doc_id, count(w.w) AS n_terms, coalesce(round(sum(w.w), 6), 0) AS total, round(max(w.w), 6) AS top FROM documents d LEFT JOIN w USING (doc_id) GROUP BY 1""")
def bm25_encode(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = fulltext.bm25_encode(docs, id="doc_id").select("doc_id", F.map_values("sparse").alias("w"))
    return rows.select("doc_id", F.size("w").cast("bigint").alias("n_terms"),
                       F.round(F.aggregate("w", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), F.round(F.array_max("w"), 6).alias("top"))


@query("hash_embedding")
def hash_embedding(spark, sf_dir):
    rows = fulltext.text_embedding(table(spark, sf_dir, "documents").select("doc_id", "text"), dim=64)
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return rows.select("doc_id", F.size("vector").alias("dim"), F.round(length, 4).alias("norm"), rounded(F.col("vector")[0].cast("double"), 5).alias("first_value"))
