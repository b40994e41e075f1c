"""Streaming queries: the events and orders files arrive as a stream and are read to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from nearfield.plans.log_queries import CHECKPOINTS, DELTA, HOUR, LOG, hour, op_log
from nearfield.plans.registry import query, rounded
from nearfield.plans.table_queries import CHANGES, LATEST, _live, changes
from nearfield.streaming import sinks, windows

EVERY = "1 hour"


def log_stream(spark, sf_dir):
    return op_log(sinks.table_stream(spark, sf_dir, "events.parquet"))


@query("stream_rate", f"WITH {LOG} SELECT {HOUR} AS start, op, count(*) AS n, round(count(*) / 3600.0, 6)::DOUBLE AS per_s FROM log GROUP BY ALL")
def stream_rate(spark, sf_dir):
    rows = sinks.windowed_table(windows.op_rate_measure(EVERY), log_stream(spark, sf_dir))
    return hour(rows).withColumn("per_s", F.round("per_s", 6))


@query("stream_rate_sliding", f"""WITH {LOG}, w AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) - s * INTERVAL 30 MINUTE AS start, op FROM log, range(0, 2) r(s))
SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, op, count(*) AS n, round(count(*) / 3600.0, 6)::DOUBLE AS per_s FROM w GROUP BY ALL""")
def stream_rate_sliding(spark, sf_dir):
    rows = sinks.windowed_table(windows.op_rate_measure(EVERY, "30 minutes"), log_stream(spark, sf_dir))
    return hour(rows).withColumn("per_s", F.round("per_s", 6))


_LE = "CASE " + " ".join(f"WHEN ms <= {b:g} THEN {b:g}" for b in windows.BUCKETS_MS) + " ELSE 'Infinity'::DOUBLE END"
_LOW = "CASE " + " ".join(
    f"WHEN le = {h} THEN {l:g}::DOUBLE" for l, h in zip(windows.BUCKETS_MS, [*[f"{b:g}" for b in windows.BUCKETS_MS[1:]], "'Infinity'::DOUBLE"])) + " ELSE 0.0 END"


def _quantile_sql(share: float) -> str:
    return (f"round(min(CASE WHEN le = 'Infinity'::DOUBLE THEN low ELSE low + (le - low) * (total * {share}::DOUBLE - (cum - n)) / n END) "
            f"FILTER (WHERE cum >= total * {share}::DOUBLE AND cum - n < total * {share}::DOUBLE), 6)")


@query("stream_histogram_quantile", f"""WITH {LOG}, b AS (SELECT {HOUR} AS start, op, {_LE} AS le, count(*) AS n FROM log GROUP BY ALL),
c AS (SELECT *, {_LOW} AS low, sum(n) OVER (PARTITION BY start, op) AS total, sum(n) OVER (PARTITION BY start, op ORDER BY le) AS cum FROM b)
SELECT start, op, sum(n)::BIGINT AS n, {_quantile_sql(0.5)} AS p50, {_quantile_sql(0.95)} AS p95, {_quantile_sql(0.99)} AS p99 FROM c GROUP BY start, op""")
def stream_histogram_quantile(spark, sf_dir):
    rows = windows.histogram_quantiles(sinks.windowed_table(windows.bucket_measure(EVERY), log_stream(spark, sf_dir)))
    return hour(rows).select("start", "op", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query("stream_recall", f"WITH {LOG} SELECT {HOUR} AS start, count(*) AS n, round(avg(recall), 6) AS avg_recall FROM log GROUP BY ALL")
def stream_recall(spark, sf_dir):
    rows = sinks.windowed_table(windows.recall_measure(EVERY), log_stream(spark, sf_dir))
    return hour(rows).withColumn("avg_recall", F.round("avg_recall", 6))


@query("stream_ratios", f"""WITH {LOG}, r AS (SELECT {HOUR} AS start, count(*) FILTER (WHERE op IN ('view', 'click')) AS searches, count(*) FILTER (WHERE NOT success) AS e,
count(*) FILTER (WHERE empty) AS m FROM log GROUP BY ALL) SELECT start, searches, round(e / nullif(searches, 0)::DOUBLE, 6) AS error_ratio, round(m / nullif(searches, 0)::DOUBLE, 6) AS empty_ratio FROM r""")
def stream_ratios(spark, sf_dir):
    rows = sinks.windowed_table(windows.ratios_measure(["view", "click"], EVERY), log_stream(spark, sf_dir))
    return hour(rows).withColumn("error_ratio", F.round("error_ratio", 6)).withColumn("empty_ratio", F.round("empty_ratio", 6))


@query("stream_checkpoints", CHECKPOINTS)
def stream_checkpoints(spark, sf_dir):
    rows = sinks.windowed_table(windows.checkpoint_measure(EVERY), log_stream(spark, sf_dir))
    return hour(rows).withColumn("avg_ms", F.round("avg_ms", 6))


@query("stream_current_state", f"WITH {CHANGES}, l AS ({LATEST.replace('{where}', '')}) SELECT o_orderkey, seq, round(price, 4) AS price FROM l WHERE op <> 'delete'")
def stream_current_state(spark, sf_dir):
    orders = sinks.table_stream(spark, sf_dir, "orders.parquet")
    return _live(sinks.stream_current_state(changes(orders), "o_orderkey"))


@query("stream_latency_delta", DELTA)
def stream_latency_delta(spark, sf_dir):
    return sinks.stream_latency_delta(log_stream(spark, sf_dir)).select("vu", "iter", "delta")


@query("stream_alerts", f"""WITH {LOG}, w AS (SELECT {HOUR} AS start, op, avg(ms) AS a, avg((NOT success)::INTEGER::DOUBLE) AS e, max(ms)::DOUBLE AS x FROM log GROUP BY ALL)
SELECT start, op, 'avg_ms' AS measure, round(a, 6) AS observed, '<' AS comparator, 90.0::DOUBLE AS "limit" FROM w WHERE NOT a < 90
UNION ALL SELECT start, op, 'error_rate', round(e, 6), '<=', 0.25, FROM w WHERE NOT e <= 0.25
UNION ALL SELECT start, op, 'max_ms', round(x, 6), '<', 250, FROM w WHERE NOT x < 250""")
def stream_alerts(spark, sf_dir):
    measures = sinks.windowed_table(windows.long_measure(EVERY), log_stream(spark, sf_dir))
    rules = [("avg_ms", "avg<90"), ("error_rate", "rate<=0.25"), ("max_ms", "max<250")]
    return hour(windows.alerts(measures, rules)).withColumn("observed", rounded("observed"))
