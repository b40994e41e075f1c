"""Queries over an operation log made of the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.operators import logs
from nearfield.plans.registry import query, rounded, table
from nearfield.sources.points import parse_points


def op_log(events):
    """Events as operations; works on batch and streaming frames. ``k`` is the number in ``props``."""
    c = F.col
    k = F.get_json_object("props", "$.k").cast("int")
    rows = events.select("event_id", "user_id", "event_type", "value", c("ts").cast("timestamp").alias("ts"), k.alias("k"))
    cause = F.when(c("k") == 1, "connection lost").when(c("k") == 2, "not loaded").otherwise("timeout")
    error = F.when(c("k") == 4, "cancelled").when(c("k") < 4, F.concat(F.lit("failed to "), "event_type", F.lit(": "), cause))
    tags = F.create_map(
        F.lit("plane"), F.when(c("user_id") < 75, "data").otherwise("control"),
        F.lit("protocol"), F.when(c("k") < 50, "grpc").otherwise("rest"))
    empty = (c("k") >= 5) & (c("k") < 9)
    return rows.select(
        "ts", c("user_id").alias("vu"), c("event_id").alias("iter"), c("event_type").alias("op"), tags.alias("tags"),
        (c("k") >= 5).alias("success"), empty.alias("empty"), F.floor("value").alias("response_time_ms"),
        F.when(empty, 0.0).otherwise(1 - c("k") / 333.0).alias("recall"),
        F.when(c("k") < 33, 10).when(c("k") < 66, 100).otherwise(1000).cast("bigint").alias("rows"), error.alias("error"), "k")


LOG = """ev AS (SELECT *, cast(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM events),
log AS (SELECT ts, user_id AS vu, event_id AS iter, event_type AS op, CASE WHEN user_id < 75 THEN 'data' ELSE 'control' END AS plane,
  CASE WHEN k < 50 THEN 'grpc' ELSE 'rest' END AS protocol, k >= 5 AS success, k >= 5 AND k < 9 AS empty, floor(value)::BIGINT AS ms,
  CASE WHEN k >= 5 AND k < 9 THEN 0.0::DOUBLE ELSE 1 - k / 333.0::DOUBLE END AS recall, CASE WHEN k < 33 THEN 10 WHEN k < 66 THEN 100 ELSE 1000 END AS n_rows, k,
  CASE WHEN k = 4 THEN 'cancelled' WHEN k < 4 THEN 'failed to ' || event_type || ': ' || CASE k WHEN 1 THEN 'connection lost' WHEN 2 THEN 'not loaded' ELSE 'timeout' END END AS error FROM ev)"""
HOUR = "strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M')"


def log_of(spark, sf_dir):
    return op_log(table(spark, sf_dir, "events"))


def hour(df, column="start"):
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm"))


def rank_sql(source: str, by: str, value: str = "ms") -> str:
    """0-based positions of the sorted values per group."""
    part = f"PARTITION BY {by}" if by else ""
    return f"o AS (SELECT {by + ',' if by else ''} {value} AS v, row_number() OVER ({part} ORDER BY {value}) - 1 AS i, count(*) OVER ({part}) AS n FROM {source})"


STATS = """count(*) AS n, min(v)::DOUBLE AS min, max(v)::DOUBLE AS max, round(avg(v), 6) AS avg, max(v) FILTER (WHERE i = floor(n * 0.5::DOUBLE))::DOUBLE AS p50,
max(v) FILTER (WHERE i = CASE WHEN n <= 20 THEN n - 1 ELSE floor(n * 0.95::DOUBLE) END)::DOUBLE AS p95,
max(v) FILTER (WHERE i = CASE WHEN n <= 100 THEN n - 1 ELSE floor(n * 0.99::DOUBLE) END)::DOUBLE AS p99"""


@query("latency_stats", f"WITH {LOG}, {rank_sql('log', 'op')} SELECT op, {STATS} FROM o GROUP BY op")
def latency_stats(spark, sf_dir):
    return logs.latency_stats(log_of(spark, sf_dir), ["op"]).withColumn("avg", F.round("avg", 6))


@query("latency_stats_all", f"WITH {LOG}, {rank_sql('log', '')} SELECT {STATS} FROM o")
def latency_stats_all(spark, sf_dir):
    return logs.latency_stats(log_of(spark, sf_dir)).withColumn("avg", F.round("avg", 6))


@query("latency_stats_by_user", f"WITH {LOG}, {rank_sql('log', 'vu')} SELECT vu, {STATS} FROM o GROUP BY vu")
def latency_stats_by_user(spark, sf_dir):
    return logs.latency_stats(log_of(spark, sf_dir), ["vu"]).withColumn("avg", F.round("avg", 6))


@query("percentile_nearest", f"WITH {LOG}, {rank_sql('log', 'op')} SELECT op, max(n) AS n, max(v) FILTER (WHERE i = least(floor(n * 90.0::DOUBLE / 100), n - 1))::DOUBLE AS percentile FROM o GROUP BY op")
def percentile_nearest(spark, sf_dir):
    return logs.percentile_nearest(log_of(spark, sf_dir), 90, ["op"])


POINTS = f"""{LOG}, pts AS (SELECT ts, op || '_latency' AS metric, ms::DOUBLE AS value, op, plane, protocol FROM log
UNION ALL SELECT ts, op || '_recall', recall, op, plane, protocol FROM log UNION ALL SELECT ts, op || '_error_rate', CASE WHEN success THEN 0.0 ELSE 1.0 END, op, plane, protocol FROM log)"""
CLASS = """CASE WHEN metric LIKE '%latency%' OR metric LIKE '%duration%' THEN 'latency' WHEN metric LIKE '%ops%' OR metric LIKE '%qps%' OR metric LIKE '%rate%' THEN 'throughput'
WHEN metric LIKE '%recall%' OR metric LIKE '%error%' THEN 'quality' ELSE 'other' END"""


@query("metric_summary", f"WITH {POINTS}, {rank_sql('pts', 'metric', 'value')} SELECT metric, {CLASS} AS class, count(*) AS n, round(avg(v), 6) AS avg, round(max(v) FILTER (WHERE i = least(floor(n * 0.95::DOUBLE), n - 1)), 6) AS p95 FROM o GROUP BY metric")
def metric_summary(spark, sf_dir):
    rows = logs.metric_summary(logs.to_points(log_of(spark, sf_dir)))
    return rows.withColumn("avg", F.round("avg", 6)).withColumn("p95", F.round("p95", 6))


@query("metric_classes", f"WITH {POINTS} SELECT {CLASS} AS class, count(DISTINCT metric) AS metrics, count(*) AS points FROM pts GROUP BY 1")
def metric_classes(spark, sf_dir):
    per_metric = logs.to_points(log_of(spark, sf_dir)).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    return per_metric.groupBy(logs.metric_class("metric").alias("class")).agg(F.count(F.lit(1)).alias("metrics"), F.sum("n").alias("points"))


@query("op_points", f"WITH {LOG} SELECT op || '_latency' AS metric, count(*) AS n, sum(ms)::DOUBLE AS total, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last FROM log WHERE k >= 3 GROUP BY 1")
def op_points(spark, sf_dir):
    """Events written as metric lines (some of another type, some cut short), then read back."""
    log = log_of(spark, sf_dir)
    data = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"), F.col("response_time_ms").alias("value"), F.col("tags"))
    kind = F.when(F.col("k") == 0, "Metric").otherwise("Point")
    line = F.to_json(F.struct(kind.alias("type"), F.concat("op", F.lit("_latency")).alias("metric"), data.alias("data")))
    broken = F.when(F.col("k").isin(1, 2), F.substring(line, 1, 40)).otherwise(line)
    points = parse_points(log.select(broken.alias("value")))
    return points.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last"))


@query("op_counts", f"WITH {LOG} SELECT op, count(*) AS n FROM log GROUP BY op")
def op_counts(spark, sf_dir):
    return logs.op_counts(log_of(spark, sf_dir))


@query("op_rates", f"""WITH {LOG} SELECT op, count(*) AS n, round(avg((NOT success)::INTEGER::DOUBLE), 6) AS error_rate, round(avg(empty::INTEGER::DOUBLE), 6) AS empty_rate,
round(avg((ms > 200)::INTEGER::DOUBLE), 6) AS timeout_rate FROM log GROUP BY ROLLUP (op)""")
def op_rates(spark, sf_dir):
    rows = logs.op_rates(log_of(spark, sf_dir), timeout_ms=200)
    return rows.select("op", "n", *[F.round(c, 6).alias(c) for c in ("error_rate", "empty_rate", "timeout_rate")])


@query("throughput", f"""WITH {LOG}, t AS (SELECT op, count(*) AS n, sum(n_rows)::BIGINT AS n_rows, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS seconds FROM log GROUP BY op)
SELECT op, n, n_rows, round(seconds, 3) AS seconds, round(n / seconds, 6) AS ops_per_s, round(n_rows / seconds, 6) AS rows_per_s FROM t""")
def throughput(spark, sf_dir):
    rows = logs.throughput(log_of(spark, sf_dir), ["op"])
    return rows.withColumn("seconds", F.round("seconds", 3)).withColumn("ops_per_s", F.round("ops_per_s", 6)).withColumn("rows_per_s", F.round("rows_per_s", 6))


@query("tag_breakdown", f"""WITH {LOG} SELECT plane, protocol, grouping(plane, protocol) AS level, count(*) AS n, round(avg((NOT success)::INTEGER::DOUBLE), 6) AS error_rate,
round(avg(ms), 6) AS avg_ms FROM log GROUP BY CUBE (plane, protocol)""")
def tag_breakdown(spark, sf_dir):
    rows = logs.tag_breakdown(log_of(spark, sf_dir), ["plane", "protocol"])
    return rows.withColumn("error_rate", F.round("error_rate", 6)).withColumn("avg_ms", F.round("avg_ms", 6))


RULES = [("view_latency", "p(95)<200"), ("click_latency", "p(99)<150", {"plane": "data"}), ("view_recall", "avg>=0.8"),
         ("error_latency", "min>=1"), ("purchase_error_rate", "rate<0.04", {"protocol": "grpc"}), ("absent_metric", "avg<1")]


@query("thresholds", f"""WITH {POINTS},
t AS (SELECT 0 AS rule, 'view_latency' AS metric, '' AS tags, 'p(95)' AS aggregate, '<' AS comparator, 200.0::DOUBLE AS lim, (SELECT quantile_cont(value, 0.95) FROM pts WHERE metric = 'view_latency') AS observed
UNION ALL SELECT 1, 'click_latency', 'plane:data', 'p(99)', '<', 150, (SELECT quantile_cont(value, 0.99) FROM pts WHERE metric = 'click_latency' AND plane = 'data')
UNION ALL SELECT 2, 'view_recall', '', 'avg', '>=', 0.8, (SELECT avg(value) FROM pts WHERE metric = 'view_recall')
UNION ALL SELECT 3, 'error_latency', '', 'min', '>=', 1, (SELECT min(value) FROM pts WHERE metric = 'error_latency')
UNION ALL SELECT 4, 'purchase_error_rate', 'protocol:grpc', 'rate', '<', 0.04, (SELECT avg(value) FROM pts WHERE metric = 'purchase_error_rate' AND protocol = 'grpc')
UNION ALL SELECT 5, 'absent_metric', '', 'avg', '<', 1, NULL)
SELECT rule, metric, tags, aggregate, comparator, lim AS "limit", round(observed, 6) AS observed, coalesce(CASE WHEN comparator = '<' THEN observed < lim ELSE observed >= lim END, true) AS passed FROM t""")
def thresholds(spark, sf_dir):
    rows = logs.evaluate_thresholds(logs.to_points(log_of(spark, sf_dir)), RULES)
    return rows.withColumn("observed", F.round("observed", 6))


@query("check_rates", f"""WITH {LOG} SELECT 'succeeds' AS "check", count(*) AS n, count(*) FILTER (WHERE success) AS passed, round(avg(success::INTEGER::DOUBLE), 6) AS pass_rate FROM log
UNION ALL SELECT 'not empty', count(*), count(*) FILTER (WHERE NOT empty), round(avg((NOT empty)::INTEGER::DOUBLE), 6) FROM log
UNION ALL SELECT 'fast', count(*), count(*) FILTER (WHERE ms < 100), round(avg((ms < 100)::INTEGER::DOUBLE), 6) FROM log""")
def check_rates(spark, sf_dir):
    c = F.col
    rows = logs.check_rates(log_of(spark, sf_dir), {"succeeds": c("success"), "not empty": ~c("empty"), "fast": c("response_time_ms") < 100})
    return rows.withColumn("pass_rate", F.round("pass_rate", 6))


@query("batch_class_latency", f"""WITH {LOG}, b AS (SELECT *, CASE WHEN n_rows <= 10 THEN 'small' WHEN n_rows <= 100 THEN 'medium' ELSE 'large' END AS batch_class FROM log),
{rank_sql('b', 'batch_class')} SELECT batch_class, {STATS} FROM o GROUP BY batch_class""")
def batch_class_latency(spark, sf_dir):
    return logs.batch_class_latency(log_of(spark, sf_dir)).withColumn("avg", F.round("avg", 6))


@query("ab_compare", f"""WITH {LOG}, s AS (SELECT op, count(*) FILTER (WHERE protocol = 'grpc') AS n_a, avg(ms) FILTER (WHERE protocol = 'grpc') AS a,
count(*) FILTER (WHERE protocol = 'rest') AS n_b, avg(ms) FILTER (WHERE protocol = 'rest') AS b FROM log GROUP BY op)
SELECT op, n_a, round(a, 6) AS avg_a, n_b, round(b, 6) AS avg_b, round(b - a, 6) + 0.0 AS delta, round(b / a, 6) AS ratio FROM s""")
def ab_compare(spark, sf_dir):
    log = log_of(spark, sf_dir).withColumn("protocol", F.col("tags")["protocol"])
    rows = logs.ab_compare(log, "protocol", "grpc", "rest")
    return rows.select("op", "n_a", "n_b", *[rounded(c).alias(c) for c in ("avg_a", "avg_b", "delta", "ratio")])


@query("mix_audit", f"""WITH {LOG}, s AS (SELECT op, count(*) AS n, count(*) / (SELECT count(*) FROM log)::DOUBLE AS share FROM log GROUP BY op),
p(op, expected) AS (VALUES ('view', 0.5::DOUBLE), ('click', 0.3), ('refund', 0.2))
SELECT op, coalesce(n, 0) AS n, round(coalesce(share, 0), 6) AS share, round(coalesce(expected, 0), 6) AS expected, round(coalesce(share, 0) - coalesce(expected, 0), 6) + 0.0 AS deviation
FROM s FULL JOIN p USING (op)""")
def mix_audit(spark, sf_dir):
    rows = logs.mix_audit(log_of(spark, sf_dir), {"view": 50, "click": 30, "refund": 20})
    return rows.select("op", "n", *[rounded(c).alias(c) for c in ("share", "expected", "deviation")])


CHECKPOINTS = f"WITH {LOG} SELECT {HOUR} AS start, op, count(*) AS n, round(avg(ms), 6) AS avg_ms FROM log GROUP BY ALL"


@query("checkpoints", CHECKPOINTS)
def checkpoints(spark, sf_dir):
    return hour(logs.checkpoints(log_of(spark, sf_dir), "1 hour")).withColumn("avg_ms", F.round("avg_ms", 6))


DELTA = f"WITH {LOG} SELECT vu, iter, abs(ms - lag(ms) OVER (PARTITION BY vu ORDER BY ts, iter)) AS delta FROM log"


@query("latency_delta", DELTA)
def latency_delta(spark, sf_dir):
    return logs.latency_delta(log_of(spark, sf_dir)).select("vu", "iter", "delta")


@query("p99_trend", f"""WITH {LOG}, hl AS (SELECT date_trunc('hour', ts) AS h, ms FROM log), {rank_sql('hl', 'h')},
w AS (SELECT h, max(v) FILTER (WHERE i = CASE WHEN n <= 100 THEN n - 1 ELSE floor(n * 0.99::DOUBLE) END) AS p99 FROM o GROUP BY h)
SELECT count(*) AS windows, round(regr_slope(p99, epoch(h) / 60.0), 6) + 0.0 AS slope FROM w""")
def p99_trend(spark, sf_dir):
    return logs.p99_trend(log_of(spark, sf_dir), "1 hour").withColumn("slope", rounded("slope"))


@query("stage_metrics", f"""WITH {LOG}, b AS (SELECT min(ts) AS t0 FROM log), st(stage, lo, hi, target) AS (VALUES (0, 0, 432000, 10), (1, 432000, 1296000, 20), (2, 1296000, 2376000, 0)),
x AS (SELECT log.*, (epoch_us(ts) - epoch_us(t0)) / 1e6::DOUBLE AS sec FROM log, b)
SELECT stage, target, count(*) AS n, round(avg((NOT success)::INTEGER::DOUBLE), 6) AS error_rate, round(avg(ms), 6) AS avg_ms FROM x JOIN st ON sec >= lo AND sec < hi GROUP BY ALL""")
def stage_metrics(spark, sf_dir):
    rows = logs.stage_metrics(log_of(spark, sf_dir), [("120h", 10), ("240h", 20), ("300h", 0)])
    return rows.withColumn("error_rate", F.round("error_rate", 6)).withColumn("avg_ms", F.round("avg_ms", 6))


@query("error_breakdown", f"""WITH {LOG} SELECT CASE WHEN error LIKE '%:%' THEN split_part(error, ': ', 1) ELSE error END AS prefix,
CASE WHEN error LIKE '%:%' THEN split_part(error, ': ', 2) ELSE '' END AS cause, count(*) AS n FROM log WHERE error IS NOT NULL GROUP BY ALL""")
def error_breakdown(spark, sf_dir):
    return logs.error_breakdown(log_of(spark, sf_dir))


@query("active_users", f"WITH {LOG} SELECT {HOUR} AS start, count(DISTINCT vu) AS users FROM log GROUP BY ALL")
def active_users(spark, sf_dir):
    return hour(logs.active_users(log_of(spark, sf_dir), "1 hour"))


# ---------------------------------------------------------------- runs


@query("expand_matrix", """SELECT vec_id, combination, k, nprobe FROM embeddings, (VALUES (0, '5', '4'), (1, '5', '16'), (2, '10', '4'), (3, '10', '16')) c(combination, k, nprobe)""")
def expand_matrix(spark, sf_dir):
    grid = logs.expand_matrix(table(spark, sf_dir, "embeddings").select("vec_id"), {"k": [5, 10], "nprobe": [4, 16]})
    return grid.select("vec_id", "combination", F.col("params")["k"].alias("k"), F.col("params")["nprobe"].alias("nprobe"))


RUNS = f"""{LOG}, rl AS (SELECT op || '-' || (k // 25) AS params, ms, success FROM log), {rank_sql('rl', 'params')},
pp AS (SELECT params, max(v) FILTER (WHERE i = CASE WHEN n <= 20 THEN n - 1 ELSE floor(n * 0.95::DOUBLE) END)::DOUBLE AS p95 FROM o GROUP BY params),
er AS (SELECT params, avg((NOT success)::INTEGER::DOUBLE) AS error_rate FROM rl GROUP BY params),
rn AS (SELECT params, p95, error_rate < 0.06 AS good, p95 < 145 AS thr FROM pp JOIN er USING (params))"""


def runs(spark, sf_dir):
    """One run per event type and quarter of ``k``; failed with an error rate of 6 % or more."""
    log = log_of(spark, sf_dir).withColumn("params", F.concat_ws("-", "op", F.floor(F.col("k") / 25).cast("string")))
    stats = logs.latency_stats(log, ["params"]).select("params", "p95")
    errors = log.groupBy("params").agg(F.avg((~F.col("success")).cast("double")).alias("error_rate"))
    rows = stats.join(errors, "params")
    bad = F.col("error_rate") >= 0.06
    over = F.col("p95") >= 145
    rows = rows.withColumn("exit_code", F.when(bad | over, 99).otherwise(0)).withColumn("thresholds_failed", over & ~bad).withColumn("timed_out", F.lit(False))
    return logs.run_results(rows)


@query("run_summary", f"""WITH {RUNS} SELECT count(*) AS total, count(*) FILTER (WHERE good) AS success, count(*) FILTER (WHERE NOT good) AS failed,
count(*) FILTER (WHERE good AND thr) AS thresholds_passed FROM rn""")
def run_summary(spark, sf_dir):
    return logs.run_summary(runs(spark, sf_dir))


@query("best_config", f"""WITH {RUNS} SELECT count(*) AS total, count(*) FILTER (WHERE good) AS success, count(*) FILTER (WHERE good AND thr) AS thresholds_passed,
(SELECT params FROM rn WHERE good ORDER BY p95, params LIMIT 1) AS best_params, (SELECT min(p95) FROM rn WHERE good) AS best_p95 FROM rn""")
def best_config(spark, sf_dir):
    return logs.best_config(runs(spark, sf_dir))
