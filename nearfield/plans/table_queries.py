"""Queries for writes, change log, snapshots, partitions, schemas and fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.functions import vectors as V
from nearfield.operators import keyed, schema, tables
from nearfield.plans.registry import ORACLES, query, rounded, table
from nearfield.sources import fixtures
from nearfield.sources.ann_dataset import dataset_metadata
from nearfield.sources.batches import columns_to_rows

# The change log: every order is inserted, urgent ones are updated the next day at a price up by a
# tenth, and cancelled-looking ones (low priority, open) are deleted the day after.
CHANGES = """ch AS (SELECT o_orderkey, 'insert' AS op, 0::BIGINT AS seq, o_totalprice AS price, o_orderdate AS ts FROM orders
UNION ALL SELECT o_orderkey, 'upsert', 1, o_totalprice * 1.1::DOUBLE, o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_orderkey, 'delete', 2, NULL, o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT') AND o_orderstatus = 'O')"""
LATEST = "SELECT o_orderkey, arg_max(op, seq) AS op, max(seq) AS seq, max_by({price: price}, seq).price AS price FROM ch {where} GROUP BY o_orderkey"


def changes(orders):
    """The change log of an orders frame, batch or streaming."""
    c = F.col
    urgent, low = c("o_orderpriority") == "1-URGENT", c("o_orderpriority") == "5-LOW"
    kinds = F.array(
        F.struct(F.lit("insert").alias("op"), F.lit(0).cast("bigint").alias("seq"), c("o_totalprice").alias("price")),
        F.when(urgent, F.struct(F.lit("upsert").alias("op"), F.lit(1).cast("bigint").alias("seq"), (c("o_totalprice") * 1.1).alias("price"))),
        F.when((low | urgent) & (c("o_orderstatus") == "O"),
               F.struct(F.lit("delete").alias("op"), F.lit(2).cast("bigint").alias("seq"), F.lit(None).cast("double").alias("price"))))
    rows = orders.select("o_orderkey", "o_orderdate", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("e"))
    day = F.make_dt_interval(F.col("seq").cast("int"))
    return rows.select("o_orderkey", "e.op", "e.seq", "e.price", c("o_orderdate").cast("timestamp").alias("ts")).withColumn("ts", F.col("ts") + day)


def _live(rows):
    return rows.select("o_orderkey", "seq", rounded("price", 4).alias("price"))


@query("insert_batches", """SELECT (rn // 1000)::BIGINT AS batch, count(*) AS inserted, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders) GROUP BY 1""")
def insert_batches(spark, sf_dir):
    return tables.insert_batches(table(spark, sf_dir, "orders"), 1000, "o_orderkey")


_PART_UPDATES = """u AS (SELECT p_partkey, p_size * 2 AS p_size, 1 AS seq FROM part WHERE p_retailprice > 1000
UNION ALL SELECT p_partkey, p_size * 3, 2 FROM part WHERE p_retailprice > 1400 UNION ALL SELECT -p_partkey - 1, p_size, 1 FROM part WHERE p_size > 40)"""


def _part_updates(part):
    c = F.col
    once = part.filter("p_retailprice > 1000").select("p_partkey", (c("p_size") * 2).alias("p_size"), F.lit(1).alias("seq"))
    twice = part.filter("p_retailprice > 1400").select("p_partkey", (c("p_size") * 3).alias("p_size"), F.lit(2).alias("seq"))
    added = part.filter("p_size > 40").select((-c("p_partkey") - 1).alias("p_partkey"), "p_size", F.lit(1).alias("seq"))
    return once.unionByName(twice).unionByName(added)


@query("upsert", f"""WITH {_PART_UPDATES}, l AS (SELECT p_partkey, arg_max(p_size, seq) AS p_size FROM u GROUP BY 1)
SELECT coalesce(l.p_partkey, part.p_partkey) AS p_partkey, coalesce(l.p_size, part.p_size) AS p_size, part.p_name FROM part FULL JOIN l USING (p_partkey)""")
def upsert(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name")
    return tables.upsert(part, _part_updates(table(spark, sf_dir, "part")), "p_partkey", "seq")


@query("upsert_counts", f"""WITH {_PART_UPDATES}, l AS (SELECT DISTINCT p_partkey FROM u)
SELECT count(*) AS upserted, count(part.p_partkey) AS replaced, count(*) - count(part.p_partkey) AS added FROM l LEFT JOIN part USING (p_partkey)""")
def upsert_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return tables.upsert_counts(part, _part_updates(part), "p_partkey")


@query("delete_by_filter", "SELECT count(*) FILTER (WHERE c_acctbal < 0) AS deleted, count(*) FILTER (WHERE NOT c_acctbal < 0 OR c_acctbal IS NULL) AS remaining FROM customer")
def delete_by_filter(spark, sf_dir):
    return tables.delete_count(table(spark, sf_dir, "customer"), F.col("c_acctbal") < 0)


@query("delete_remaining", "SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'BUILDING')")
def delete_remaining(spark, sf_dir):
    return tables.delete(table(spark, sf_dir, "customer"), "c_acctbal < 0 AND c_mktsegment = 'BUILDING'").select("c_custkey")


@query("current_state", f"WITH {CHANGES}, l AS ({LATEST.replace('{where}', '')}) SELECT o_orderkey, seq, round(price, 4) AS price FROM l WHERE op <> 'delete'")
def current_state(spark, sf_dir):
    return _live(tables.current_state(changes(table(spark, sf_dir, "orders")), "o_orderkey"))


_AT = "1997-06-30 00:00:00"
_AS_OF = LATEST.replace("{where}", "WHERE ts <= TIMESTAMP '{at}'")


@query("snapshot_as_of", f"WITH {CHANGES}, l AS ({_AS_OF.replace('{at}', _AT)}) SELECT o_orderkey, seq, round(price, 4) AS price FROM l WHERE op <> 'delete'")
def snapshot_as_of(spark, sf_dir):
    at = F.lit(_AT).cast("timestamp")
    return _live(tables.as_of(changes(table(spark, sf_dir, "orders")), "o_orderkey", at))


@query("snapshot_catalog", """SELECT 'y' || year(o_orderdate) AS snapshot, 'orders of ' || year(o_orderdate) AS description, 'orders' AS collection,
strftime(min(o_orderdate), '%Y-%m-%d') AS created, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS partitions, count(*) AS n_rows FROM orders GROUP BY year(o_orderdate)""")
def snapshot_catalog(spark, sf_dir):
    year = F.year("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("y"), year).alias("snapshot"), F.concat(F.lit("orders of "), year).alias("description"),
        F.lit("orders").alias("collection"), F.col("o_orderpriority").alias("partition"), F.col("o_orderdate").alias("ts"))
    listed = tables.snapshot_catalog(rows, "orders")
    return listed.withColumn("created", F.date_format("created", "yyyy-MM-dd")).withColumn("partitions", F.array_join("partitions", ","))


@query("snapshot_diff", f"""WITH {CHANGES}, a AS ({_AS_OF.replace('{at}', '1996-01-01 00:00:00')}), b AS ({_AS_OF.replace('{at}', _AT)}),
x AS (SELECT * FROM a WHERE op <> 'delete'), y AS (SELECT * FROM b WHERE op <> 'delete')
SELECT o_orderkey, CASE WHEN x.seq IS NULL THEN 'added' WHEN y.seq IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM x FULL JOIN y USING (o_orderkey) WHERE x.seq IS DISTINCT FROM y.seq""")
def snapshot_diff(spark, sf_dir):
    log = changes(table(spark, sf_dir, "orders"))
    before, after = (_live(tables.as_of(log, "o_orderkey", F.lit(t).cast("timestamp"))) for t in ("1996-01-01 00:00:00", _AT))
    return tables.diff(before, after, "o_orderkey")


@query("collection_growth", """WITH h AS (SELECT date_trunc('hour', ts) AS start, sum(CASE WHEN value < 33 THEN 10 WHEN value < 66 THEN 100 ELSE 1000 END)::BIGINT AS inserted FROM events GROUP BY 1)
SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, inserted, sum(inserted) OVER (ORDER BY start)::BIGINT AS total FROM h""")
def collection_growth(spark, sf_dir):
    size = F.when(F.col("value") < 33, 10).when(F.col("value") < 66, 100).otherwise(1000)
    log = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), size.alias("rows"))
    return tables.growth(log, every="1 hour").withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query("partition_stats", "SELECT label, count(*) AS n_rows FROM embeddings GROUP BY label")
def partition_stats(spark, sf_dir):
    return tables.partition_stats(table(spark, sf_dir, "embeddings"), "label")


@query("drop_partition", "SELECT label, count(*) AS n_rows FROM embeddings WHERE label <> 4 GROUP BY label")
def drop_partition(spark, sf_dir):
    return tables.partition_stats(tables.drop_partition(table(spark, sf_dir, "embeddings"), "label", 4), "label")


@query("shard_balance")
def shard_balance(spark, sf_dir):
    return tables.shard_balance(table(spark, sf_dir, "orders"), "o_orderkey", 8)


# ---------------------------------------------------------------- schemas

PART_SPEC = {"name": "part", "fields": [
    {"name": "p_partkey", "dataType": "Int64", "isPrimaryKey": True},
    {"name": "p_name", "dataType": "VarChar", "maxLength": 11},
    {"name": "p_brand", "dataType": "VarChar", "maxLength": 7},
    {"name": "p_size", "dataType": "Int8"},
    {"name": "p_retailprice", "dataType": "Double"},
]}
EMB_SPEC = {"name": "embeddings", "fields": [
    {"name": "vec_id", "dataType": "Int64", "isPrimaryKey": True},
    {"name": "label", "dataType": "Int32"},
    {"name": "embedding", "dataType": "FloatVector", "dimension": 64},
]}


@query("conform_part", "SELECT p_partkey, p_name, p_brand, p_size::BIGINT AS p_size, p_retailprice FROM part")
def conform_part(spark, sf_dir):
    rows = schema.conform(table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("string")), PART_SPEC)
    return rows.withColumn("p_size", F.col("p_size").cast("bigint"))


@query("validate_rows", """SELECT field, rule, violations::BIGINT AS violations FROM (
SELECT 'p_partkey' AS field, 'null' AS rule, count(*) FILTER (WHERE p_partkey IS NULL) AS violations FROM part
UNION ALL SELECT 'p_name', 'null', count(*) FILTER (WHERE p_name IS NULL) FROM part
UNION ALL SELECT 'p_name', 'max_length', count(*) FILTER (WHERE strlen(p_name) > 11) FROM part
UNION ALL SELECT 'p_brand', 'null', count(*) FILTER (WHERE p_brand IS NULL) FROM part
UNION ALL SELECT 'p_brand', 'max_length', count(*) FILTER (WHERE strlen(p_brand) > 7) FROM part
UNION ALL SELECT 'p_size', 'null', count(*) FILTER (WHERE p_size IS NULL) FROM part
UNION ALL SELECT 'p_retailprice', 'null', count(*) FILTER (WHERE p_retailprice IS NULL) FROM part
UNION ALL SELECT 'p_partkey', 'duplicate_key', count(*) - count(DISTINCT p_partkey) FROM part)""")
def validate_rows(spark, sf_dir):
    return schema.validate(table(spark, sf_dir, "part"), schema.CollectionSpec.from_dict(PART_SPEC))


@query("validate_vectors", """SELECT field, rule, violations::BIGINT AS violations FROM (
SELECT 'vec_id' AS field, 'null' AS rule, count(*) FILTER (WHERE vec_id IS NULL) AS violations FROM embeddings
UNION ALL SELECT 'label', 'null', count(*) FILTER (WHERE label IS NULL) FROM embeddings
UNION ALL SELECT 'embedding', 'null', count(*) FILTER (WHERE embedding IS NULL) FROM embeddings
UNION ALL SELECT 'embedding', 'dimension', count(*) FILTER (WHERE len(embedding) <> 64) FROM embeddings
UNION ALL SELECT 'embedding', 'not_finite', count(*) FILTER (WHERE len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0) FROM embeddings
UNION ALL SELECT 'vec_id', 'duplicate_key', count(*) - count(DISTINCT vec_id) FROM embeddings)""")
def validate_vectors(spark, sf_dir):
    return schema.validate(table(spark, sf_dir, "embeddings"), schema.CollectionSpec.from_dict(EMB_SPEC))


@query("table_profile", """SELECT count(*) AS n_rows, 'embedding' AS field, count(*) FILTER (WHERE embedding IS NULL) AS nulls, min(len(embedding))::INTEGER AS min_size,
max(len(embedding))::INTEGER AS max_size FROM embeddings UNION ALL SELECT count(*), 'label', count(*) FILTER (WHERE label IS NULL), NULL, NULL FROM embeddings
UNION ALL SELECT count(*), 'vec_id', count(*) FILTER (WHERE vec_id IS NULL), NULL, NULL FROM embeddings""")
def table_profile(spark, sf_dir):
    rows = schema.profile(table(spark, sf_dir, "embeddings"), schema.CollectionSpec.from_dict(EMB_SPEC))
    return rows.drop("approx_distinct")


@query("infer_kinds", """SELECT 'id' AS field, CASE WHEN bool_and(vec_id = floor(vec_id)) THEN 'Int64' ELSE 'Float' END AS kind FROM embeddings
UNION ALL SELECT 'label', CASE WHEN bool_and(label = floor(label)) THEN 'Float' END FROM embeddings
UNION ALL SELECT 'vector', CASE WHEN min(len(embedding)) = max(len(embedding)) THEN 'FloatVector' ELSE 'Array<Float>' END FROM embeddings
UNION ALL SELECT 'positions', CASE WHEN min(n) = max(n) THEN 'FloatVector' ELSE 'Array<Int64>' END FROM (SELECT len(list_filter(embedding, lambda x: abs(x) > 0.15)) AS n FROM embeddings)
UNION ALL SELECT 'sparse', CASE WHEN bool_and(len(list_filter(embedding, lambda x: abs(x) > 0.15)) > 0) THEN 'SparseFloatVector' ELSE 'JSON' END FROM embeddings
UNION ALL SELECT 'name', CASE WHEN count(*) > 0 THEN 'VarChar' END FROM embeddings UNION ALL SELECT 'flag', CASE WHEN count(*) > 0 THEN 'Bool' END FROM embeddings
UNION ALL SELECT 'parts', CASE WHEN count(*) > 0 THEN 'Array<Struct>' END FROM embeddings UNION ALL SELECT 'info', CASE WHEN count(*) > 0 THEN 'JSON' END FROM embeddings""")
def infer_kinds(spark, sf_dir):
    c = F.col
    df = table(spark, sf_dir, "embeddings")
    big = F.filter(F.transform("embedding", lambda x, i: F.struct(i.alias("p"), x.alias("x"))), lambda e: F.abs(e.x) > 0.15)
    raw = df.select(
        c("vec_id").cast("string").alias("id"), c("label").cast("string").alias("label"), F.to_json("embedding").alias("vector"),
        F.to_json(big.getField("p")).alias("positions"), F.to_json(F.map_from_entries(big)).alias("sparse"),
        F.concat(F.lit('"n'), c("vec_id"), F.lit('"')).alias("name"), (c("label") > 4).cast("string").alias("flag"),
        F.to_json(F.array(F.struct("label"))).alias("parts"), F.to_json(F.struct("label")).alias("info"))
    return schema.infer_column_kinds(raw)


@query("columns_to_rows", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def columns_to_rows_query(spark, sf_dir):
    """Orders packed into batches of a thousand and taken apart again."""
    numbered = tables.number_rows(table(spark, sf_dir, "orders"), "o_orderkey")
    part = F.struct("o_orderkey", "o_custkey", "o_totalprice")
    packed = numbered.groupBy(F.floor(F.col("row_number") / 1000).alias("batch")).agg(F.array_sort(F.collect_list(part)).alias("e"))
    names = ["o_custkey", "o_orderkey", "o_totalprice"]
    return columns_to_rows(packed.select(*[F.col(f"e.{c}").alias(c) for c in names]), names)


# ---------------------------------------------------------------- data sets and fixtures


@query("dataset_metadata", "SELECT max(len(embedding)) AS dimension, 'L2' AS metric_type, count(*) AS train_size, count(*) FILTER (WHERE label < 3) AS test_size, 5::BIGINT AS neighbors_k FROM embeddings")
def dataset_metadata_query(spark, sf_dir):
    from nearfield.operators.quality import ground_truth

    base = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    test = base.filter("label < 3").select(F.col("id").alias("qid"), "vector")
    return dataset_metadata(base, test, ground_truth(base, test, 5), "L2")


@query("fixture_clustered", """WITH x AS (SELECT vec_id, label, unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
m AS (SELECT label, i, avg(v) AS m FROM x GROUP BY label, i)
SELECT vec_id AS id, x.label::BIGINT AS group_id, round(sqrt(sum((m + 0.25 * (v - m)) ^ 2)), 4) AS norm, round(sqrt(sum((0.25 * (v - m)) ^ 2)), 4) AS spread
FROM x JOIN m USING (label, i) GROUP BY ALL""")
def fixture_clustered(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("group_id"), "embedding")
    drawn = fixtures.tight_groups(rows, "group_id", "embedding")
    far = F.zip_with("embedding", "mean", lambda x, m: x - m)
    return drawn.join(fixtures.group_means(rows, "group_id", "embedding"), "group_id").select(
        "id", "group_id", F.round(V.norm("embedding"), 4).alias("norm"), F.round(V.norm(far), 4).alias("spread"))


@query("fixture_struct_array", """SELECT conv_id AS id, count(*) AS n_elements, sum(turn * length(text))::BIGINT AS weighted, string_agg(role, ',' ORDER BY turn) AS roles,
max(length(text)) AS longest FROM conversations GROUP BY conv_id""")
def fixture_struct_array(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.char_length("text").cast("bigint").alias("n"))
    df = fixtures.struct_rows(rows, "conv_id", "turn", ["role", "n"])
    weighted = F.aggregate("elements", F.lit(0).cast("bigint"), lambda a, e: a + e.turn * e.n)
    return df.select(F.col("conv_id").alias("id"), F.size("elements").cast("bigint").alias("n_elements"), weighted.alias("weighted"),
                     F.array_join("elements.role", ",").alias("roles"), F.array_max("elements.n").alias("longest"))


@query("keyed_upsert", ORACLES["upsert"])
def keyed_upsert(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    stored = keyed.save_keyed(part.select("p_partkey", "p_size", "p_name"), "p_partkey", 8)
    return keyed.upsert_keyed(stored, _part_updates(part), "seq").read(spark)


@query("keyed_current_state", ORACLES["current_state"])
def keyed_current_state(spark, sf_dir):
    log = changes(table(spark, sf_dir, "orders"))
    stored = keyed.save_keyed(log.filter("seq < 2"), "o_orderkey", 8)
    keyed.append_keyed(stored, log.filter("seq = 2"))
    return _live(tables.current_state(stored.read(spark), "o_orderkey"))


@query("keyed_diff", ORACLES["snapshot_diff"])
def keyed_diff(spark, sf_dir):
    log = changes(table(spark, sf_dir, "orders"))
    before, after = (keyed.save_keyed(_live(tables.as_of(log, "o_orderkey", F.lit(t).cast("timestamp"))), "o_orderkey", 8) for t in ("1996-01-01 00:00:00", _AT))
    return tables.diff(before.read(spark), after.read(spark), "o_orderkey")
