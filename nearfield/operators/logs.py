"""Operation-log analytics on a log of ``(ts, vu, iter, op, tags, success, empty, response_time_ms,
recall, rows, error)`` rows, or on long-form metric points ``(ts, metric, value, tags)``."""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# A search slower than this many milliseconds counts as timed out.
TIMEOUT_MS = 5000
# Parts in which a value range that holds a wanted rank is counted again.
SUBRANGES = 4096


def measured_recall(log: DataFrame, zero_is_unset: bool = True) -> DataFrame:
    """Logs write recall 0 when it was not measured; read that as null."""
    unset = F.when(F.col("recall") != 0, F.col("recall")) if zero_is_unset else F.col("recall")
    return log.withColumn("recall", unset)


# ---------------------------------------------------------------- exact quantiles


def _null_safe(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on ``by`` in which null equals null."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in by else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    return left.join(renamed, cond).drop(*[f"__{c}" for c in by])


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, ranks: Mapping[str, Column]) -> DataFrame:
    """Values at given 0-based ranks per group: ``(by…, n, total, name…)``.

    ``ranks`` are expressions over the group's row count ``n``. Rows are first counted per distinct
    value, wherever they lie. Counts per value range (about 1 % wide) then tell which range holds a
    rank, and just that range is ordered, so no task ever orders a whole group.
    """
    by = list(by)
    v = F.col(value).cast("double")
    counted = df.filter(F.col(value).isNotNull() & ~F.isnan(v)).groupBy(*by, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    size = F.log(F.abs(F.col("__v")) + 1) * 64
    place = F.when(F.col("__v") < 0, -size).otherwise(size)
    counted = counted.withColumn("__range", F.floor(place))
    ranges = counted.groupBy(*by, "__range").agg(
        F.sum("__c").alias("__rc"), F.sum(F.col("__v") * F.col("__c")).alias("__rs"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.select(*by, "__range", F.sum("__rc").over(group).alias("n"), F.sum("__rs").over(group).alias("total"),
                           F.sum("__rc").over(running).alias("__hi"), "__rc")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("at")) for name, rank in ranks.items()]))
    targets = ranges.withColumn("__t", wanted).filter(
        (F.col("__t.at") < F.col("__hi")) & (F.col("__t.at") >= F.col("__hi") - F.col("__rc")))
    targets = targets.select(*by, "__range", "n", "total", (F.col("__hi") - F.col("__rc")).alias("__lo"), "__t")
    inside = _null_safe(counted, targets, [*by, "__range"]).withColumn("__sub", F.floor((place - F.col("__range")) * SUBRANGES))
    # the range is counted again in parts, and only the part that holds the rank is ordered
    parts = inside.groupBy(*by, "__t", "__lo", "__sub").agg(F.sum("__c").alias("__sc"))
    upto = Window.partitionBy(*by, "__t.name").orderBy("__sub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("__end", F.col("__lo") + F.sum("__sc").over(upto)).filter(
        (F.col("__t.at") < F.col("__end")) & (F.col("__t.at") >= F.col("__end") - F.col("__sc")))
    parts = parts.select(*by, F.col("__t.name").alias("__name"), "__sub", (F.col("__end") - F.col("__sc")).alias("__from"))
    held = _null_safe(inside.withColumn("__name", F.col("__t.name")), parts, [*by, "__name", "__sub"])
    order = Window.partitionBy(*by, "__name").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = held.withColumn("__cum", F.col("__from") + F.sum("__c").over(order)).filter(F.col("__cum") > F.col("__t.at"))
    return reached.groupBy(*by, "n", "total").agg(
        *[F.min(F.when(F.col("__t.name") == name, F.col("__v"))).alias(name) for name in ranks])


def interpolated(df: DataFrame, by: Sequence[str], value: str, percents: Sequence[float]) -> DataFrame:
    """Percentiles interpolated between the two nearest ranks: ``(by…, "p(95)", …)``."""
    ranks = {}
    for p in percents:
        at = (F.col("n") - 1) * F.lit(p / 100)
        ranks[f"lo{p:g}"], ranks[f"hi{p:g}"] = F.floor(at), F.ceil(at)
    found = exact_quantiles(df, by, value, ranks)
    out = []
    for p in percents:
        at = (F.col("n") - 1) * F.lit(p / 100)
        low, high = F.col(f"`lo{p:g}`"), F.col(f"`hi{p:g}`")
        out.append((low + (high - low) * (at - F.floor(at))).alias(f"p({p:g})"))
    return found.select(*by, *out)


def _nth(share: float) -> Column:
    return F.floor(F.col("n") * F.lit(float(share)))


# ---------------------------------------------------------------- latency


def _one_row(stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """The ungrouped result, or zeros when there is none: a global aggregate always has one row."""
    return stats.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in names])


def latency_stats(log: DataFrame, by: Sequence[str] = (), value: str = "response_time_ms") -> DataFrame:
    """Per group: n, min, max, avg, p50, p95 and p99 by 0-based nearest rank.

    p95 is the maximum up to 20 rows, p99 up to 100. Without groups an empty log gives zeros.
    """
    last = F.col("n") - 1
    ranks = {"min": F.lit(0), "max": last, "p50": _nth(0.5), "p95": F.when(F.col("n") <= 20, last).otherwise(_nth(0.95)),
             "p99": F.when(F.col("n") <= 100, last).otherwise(_nth(0.99))}
    stats = exact_quantiles(log, by, value, ranks).withColumn("avg", F.col("total") / F.col("n"))
    names = ["min", "max", "avg", "p50", "p95", "p99"]
    if by:
        return stats.select(*by, "n", *names)
    return _one_row(stats, names)


def percentile_nearest(log: DataFrame, p: float, by: Sequence[str] = (), value: str = "response_time_ms") -> DataFrame:
    """``sorted[min(floor(n * p / 100), n - 1)]`` per group; 0 for an empty ungrouped log."""
    at = F.least(F.floor(F.col("n") * F.lit(float(p)) / F.lit(100.0)), F.col("n") - 1)
    stats = exact_quantiles(log, by, value, {"percentile": at})
    if by:
        return stats.select(*by, "n", "percentile")
    return _one_row(stats, ["percentile"])


def metric_class(metric: Column | str) -> Column:
    """latency, throughput, quality or other; the first matching class wins."""
    name = F.lower(F.col(metric) if isinstance(metric, str) else metric)
    return (F.when(name.rlike("latency|duration"), "latency").when(name.rlike("ops|qps|rate"), "throughput")
            .when(name.rlike("recall|error"), "quality").otherwise("other"))


def metric_summary(points: DataFrame) -> DataFrame:
    """Per metric: class, count, average and p95 (nearest rank, else the last value)."""
    at = F.least(_nth(0.95), F.col("n") - 1)
    stats = exact_quantiles(points, ["metric"], "value", {"p95": at})
    return stats.select("metric", metric_class("metric").alias("class"), "n", (F.col("total") / F.col("n")).alias("avg"), "p95")


def to_points(log: DataFrame) -> DataFrame:
    """The log as long-form metric points."""
    metrics = F.array(
        F.struct(F.concat("op", F.lit("_latency")).alias("metric"), F.col("response_time_ms").cast("double").alias("value")),
        F.struct(F.concat("op", F.lit("_recall")).alias("metric"), F.col("recall").cast("double").alias("value")),
        F.struct(F.concat("op", F.lit("_error_rate")).alias("metric"), (~F.col("success")).cast("double").alias("value")))
    return log.select("ts", "tags", F.inline(metrics)).filter(F.col("value").isNotNull())


# ---------------------------------------------------------------- counts and rates


def op_counts(log: DataFrame, op: str = "op") -> DataFrame:
    return log.groupBy(op).agg(F.count(F.lit(1)).alias("n"))


def _share(condition: Column) -> Column:
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def op_rates(log: DataFrame, timeout_ms: int = TIMEOUT_MS) -> DataFrame:
    """Error, empty and timeout rate per operation, and over all in the row without an operation."""
    return log.rollup("op").agg(
        F.count(F.lit(1)).alias("n"), _share(~F.col("success")).alias("error_rate"), _share(F.col("empty")).alias("empty_rate"),
        _share(F.col("response_time_ms") > timeout_ms).alias("timeout_rate"))


def throughput(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Operations and rows per second over the observed span; null when the span is zero."""
    span = (F.max("ts").cast("double") - F.min("ts").cast("double")).alias("seconds")
    rows = log.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("n_rows"), span)
    guarded = F.when(F.col("seconds") > 0, F.col("seconds"))
    return rows.withColumn("ops_per_s", F.col("n") / guarded).withColumn("rows_per_s", F.col("n_rows") / guarded)


def tag_breakdown(log: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Count, error rate and mean latency for every combination and margin of the given tags."""
    cols = [F.col("tags")[t].alias(t) for t in tags]
    rows = log.select("success", "response_time_ms", *cols)
    level = F.grouping_id().cast("bigint").alias("level")
    return rows.cube(*tags).agg(level, F.count(F.lit(1)).alias("n"), _share(~F.col("success")).alias("error_rate"),
                                F.avg("response_time_ms").alias("avg_ms"))


def check_rates(log: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Share of rows passing each named check; null counts as failed."""
    row = log.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}")
                                                  for i, c in enumerate(checks.values())])
    steps = [F.struct(F.lit(name).alias("check"), F.col("n"), F.col(f"c{i}").alias("passed")) for i, name in enumerate(checks)]
    return row.select(F.inline(F.array(*steps))).withColumn("pass_rate", F.col("passed") / F.col("n"))


def error_breakdown(log: DataFrame) -> DataFrame:
    """Failed rows by operation prefix and cause of the message ``prefix: cause``."""
    pattern = r"^([^:]+):\s*(.*)$"
    message = F.col("error")
    split = message.rlike(pattern)
    failed = log.filter(message.isNotNull() & (message != ""))
    return failed.groupBy(
        F.when(split, F.regexp_extract(message, pattern, 1)).otherwise(message).alias("prefix"),
        F.when(split, F.regexp_extract(message, pattern, 2)).otherwise("").alias("cause"),
    ).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- thresholds

_RULE = re.compile(r"^(p\((\d+(?:\.\d+)?)\)|avg|min|max|rate|count)\s*(<=|>=|<|>)\s*(-?\d+(?:\.\d+)?)$")


def threshold_rules(rules: Sequence[tuple]) -> list[dict]:
    """Rules ``(metric, "p(95)<200")`` or ``(metric, "rate<0.01", {tag: value})`` as plain values."""
    out = []
    for rule in rules:
        metric, text, tags = (*rule, {})[:3]
        found = _RULE.match(text.replace(" ", ""))
        if not found:
            raise ValueError(f"cannot read threshold {text}")
        out.append({"metric": metric, "tags": dict(tags), "aggregate": found[1],
                    "percent": float(found[2]) if found[2] else None, "comparator": found[3], "limit": float(found[4])})
    return out


def evaluate_thresholds(points: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """One row per rule: observed value and whether it passed. Percentiles interpolate between ranks.

    Each point meets its rules through a map lookup on the metric, all rules are aggregated in one pass.
    """
    parsed = threshold_rules(rules)
    wanted = {}
    for i, r in enumerate(parsed):
        wanted.setdefault(r["metric"], []).append(i)
    by_metric = F.create_map(*[x for m, ids in wanted.items() for x in (F.lit(m), F.array(*[F.lit(i) for i in ids]))])
    rows = points.select("value", "tags", F.explode(F.element_at(by_metric, F.col("metric"))).alias("rule"))
    for i, r in enumerate(parsed):
        for tag, value in r["tags"].items():
            rows = rows.filter((F.col("rule") != i) | F.coalesce(F.col("tags")[tag] == value, F.lit(False)))
    percents = sorted({r["percent"] for r in parsed if r["percent"] is not None})
    simple = {"avg": F.avg("value"), "rate": F.avg("value"), "min": F.min("value"), "max": F.max("value"),
              "count": F.count("value").cast("double")}
    seen = rows.groupBy("rule").agg(*[expr.alias(name) for name, expr in simple.items()])
    if percents:
        seen = seen.join(interpolated(rows, ["rule"], "value", percents), "rule")
    names = [*simple, *[f"p({p:g})" for p in percents]]
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`"))])
    # the rule list is a literal of the caller's: a handful of rows
    frame = points.sparkSession.createDataFrame(
        [(i, r["metric"], ",".join(f"{k}:{v}" for k, v in sorted(r["tags"].items())),
          r["aggregate"] if r["percent"] is None else f"p({r['percent']:g})", r["comparator"], r["limit"])
         for i, r in enumerate(parsed)],
        "rule int, metric string, tags string, aggregate string, comparator string, limit double")
    joined = frame.join(seen.select("rule", values.alias("__seen")), "rule", "left")
    observed = F.element_at("__seen", F.col("aggregate"))
    out = joined.withColumn("observed", observed)
    return out.select("rule", "metric", "tags", "aggregate", "comparator", "limit", "observed", passes("observed").alias("passed"))


def passes(observed: Column | str) -> Column:
    """Compare with ``comparator`` and ``limit`` of the row; nothing observed means passed."""
    o = F.col(observed) if isinstance(observed, str) else observed
    c = F.col("comparator")
    met = (F.when(c == "<", o < F.col("limit")).when(c == "<=", o <= F.col("limit"))
           .when(c == ">", o > F.col("limit")).otherwise(o >= F.col("limit")))
    return F.coalesce(met, F.lit(True))


# ---------------------------------------------------------------- runs and parameter grids


def expand_matrix(queries: DataFrame, params: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the parameter lists with every query row; no lists give one empty combination."""
    combos = [dict(zip(params, values)) for values in itertools.product(*params.values())]
    text = [F.struct(F.lit(i).alias("combination"),
                     (F.create_map(*[F.lit(str(x)) for pair in c.items() for x in pair]) if c
                      else F.create_map().cast("map<string,string>")).alias("params")) for i, c in enumerate(combos)]
    if not text:
        return queries.limit(0).select("*", F.lit(0).alias("combination"), F.create_map().cast("map<string,string>").alias("params"))
    return queries.select("*", F.inline(F.array(*text)))


def run_status(exit_code: Column, only_thresholds_failed: Column, timed_out: Column) -> Column:
    """Status of a run: a non-zero exit that came from thresholds alone is still a success."""
    return F.when(timed_out, "error").when((exit_code == 0) | only_thresholds_failed, "success").otherwise("failed")


def run_results(runs: DataFrame) -> DataFrame:
    """Add ``status`` and ``thresholds_passed`` to ``(exit_code, thresholds_failed, timed_out)`` rows."""
    code, failed, late = F.col("exit_code"), F.coalesce("thresholds_failed", F.lit(False)), F.coalesce("timed_out", F.lit(False))
    return runs.withColumn("status", run_status(code, failed, late)).withColumn(
        "thresholds_passed", (F.col("status") == "success") & ~failed)


def run_summary(results: DataFrame) -> DataFrame:
    """One row: total, successful, failed and threshold-passing runs, and the success rate."""
    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") != "success").alias("failed"),
        F.count_if(F.col("thresholds_passed")).alias("thresholds_passed"))


def best_config(results: DataFrame, params: str = "params", p95: str = "p95") -> DataFrame:
    """Run summary with the parameters of the fastest successful run by p95; ties go to the smaller parameters."""
    ok = F.col("status") == "success"
    key = F.when(ok & F.col(p95).isNotNull(), F.struct(F.col(p95).alias("p95"), F.col(params).alias("params")))
    summary = results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("success"), F.count_if(F.col("thresholds_passed")).alias("thresholds_passed"),
        F.min(key).alias("best"))
    return summary.select("total", "success", "thresholds_passed", F.col("best.params").alias("best_params"), F.col("best.p95").alias("best_p95"))


def ab_compare(log: DataFrame, side: str, a: str, b: str, by: str = "op") -> DataFrame:
    """Mean latency and count per side with difference and ratio."""
    rows = log.groupBy(by).pivot(side, [a, b]).agg(F.count(F.lit(1)).alias("n"), F.avg("response_time_ms").alias("avg"))
    rows = rows.select(by, *[F.col(f"`{s}_{m}`").alias(f"{m}_{t}") for s, t in ((a, "a"), (b, "b")) for m in ("n", "avg")])
    base = F.when(F.col("avg_a") != 0, F.col("avg_a"))
    return rows.withColumn("delta", F.col("avg_b") - F.col("avg_a")).withColumn("ratio", F.col("avg_b") / base)


def mix_audit(log: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Observed against expected share per operation; operations on one side only appear too."""
    total = float(sum(weights.values()))
    seen = op_counts(log)
    whole = Window.partitionBy(F.lit(0))
    # one row per operation name
    seen = seen.withColumn("share", F.col("n") / F.sum("n").over(whole))
    plan = log.sparkSession.createDataFrame([(k, v / total) for k, v in weights.items()], "op string, expected double")
    rows = seen.join(plan, "op", "full_outer")
    share, expected = F.coalesce("share", F.lit(0.0)), F.coalesce("expected", F.lit(0.0))
    return rows.select("op", F.coalesce("n", F.lit(0)).alias("n"), share.alias("share"), expected.alias("expected"),
                       (share - expected).alias("deviation"))


def batch_class(rows: Column | str = "rows") -> Column:
    """Insert batches by size: small up to 10 rows, medium up to 100, large beyond."""
    r = F.col(rows) if isinstance(rows, str) else rows
    return F.when(r <= 10, "small").when(r <= 100, "medium").otherwise("large")


def batch_class_latency(log: DataFrame) -> DataFrame:
    return latency_stats(log.withColumn("batch_class", batch_class()), ["batch_class"])


# ---------------------------------------------------------------- over time


def checkpoints(log: DataFrame, every: str = "1 minute") -> DataFrame:
    """Mean latency and samples per interval and operation."""
    return log.groupBy(F.window("ts", every).start.alias("start"), "op").agg(
        F.count(F.lit(1)).alias("n"), F.avg("response_time_ms").alias("avg_ms"))


def latency_delta(log: DataFrame, slots: str = "10 minutes") -> DataFrame:
    """``|x_n - x_(n-1)|`` per virtual user in event order; a user's first row has none.

    A user's log is cut into time slots that are ordered in parallel; the last row of a slot is
    handed to the user's next slot, so that a busy user is never one task.
    """
    value = F.col("response_time_ms")
    rows = log.select("vu", "iter", "ts", value.alias("x"), F.window("ts", slots).start.alias("slot"))
    inside = Window.partitionBy("vu", "slot").orderBy("ts", "iter")
    last = rows.groupBy("vu", "slot").agg(F.max_by("x", F.struct("ts", "iter")).alias("last"))
    before = last.select("vu", "slot", F.lag("last").over(Window.partitionBy("vu").orderBy("slot")).alias("carried"))
    joined = rows.withColumn("prev", F.lag("x").over(inside)).withColumn("first", F.row_number().over(inside) == 1)
    joined = joined.join(before, ["vu", "slot"])
    prev = F.when(F.col("first"), F.col("carried")).otherwise(F.col("prev"))
    return joined.select("vu", "iter", "ts", F.abs(F.col("x") - prev).alias("delta"))


def p99_per_window(log: DataFrame, every: str = "1 minute") -> DataFrame:
    return latency_stats(log.withColumn("start", F.window("ts", every).start), ["start"]).select("start", "n", "p99")


def p99_trend(log: DataFrame, every: str = "1 minute") -> DataFrame:
    """Slope of p99 over time in milliseconds per minute, and the number of windows."""
    minute = F.col("start").cast("double") / 60.0
    windows = p99_per_window(log, every).withColumn("minute", minute)
    return windows.agg(F.count(F.lit(1)).alias("windows"), F.regr_slope("p99", "minute").alias("slope"))


def duration_seconds(text: str) -> int:
    """``1h30m5s`` in seconds; 300 when nothing can be read."""
    units = {"h": 3600, "m": 60, "s": 1}
    parts = re.findall(r"(\d+)([hms])", text.strip().lower())
    return sum(int(n) * units[u] for n, u in parts) or 300


def duration_column(c: Column | str) -> Column:
    """The same as a Column over duration texts."""
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    parts = [F.coalesce(F.regexp_extract(c, rf"(\d+){u}", 1).try_cast("bigint"), F.lit(0)) * s for u, s in (("h", 3600), ("m", 60), ("s", 1))]
    total = parts[0] + parts[1] + parts[2]
    return F.when(total > 0, total).otherwise(300)


def stage_bounds(stages: Sequence[tuple[str, int]]) -> list[tuple[int, int, int, int]]:
    """``(stage, start, end, target)`` in seconds from the begin of the run; zero-length stages stay."""
    out, at = [], 0
    for i, (duration, target) in enumerate(stages):
        seconds = 0 if re.fullmatch(r"0+[hms]?", duration.strip().lower()) else duration_seconds(duration)
        out.append((i, at, at + seconds, target))
        at += seconds
    return out


def stage_metrics(log: DataFrame, stages: Sequence[tuple[str, int]]) -> DataFrame:
    """Operations, error rate and mean latency per load stage, counted from the log's first event.

    The few stages are a literal; each row finds its stage by comparing bounds, without a join.
    """
    begin = log.agg(F.unix_micros(F.min("ts"))).first()[0]
    second = (F.unix_micros("ts") - F.lit(begin)) / F.lit(1e6)
    stage = F.lit(None).cast("struct<stage:int,target:int>")
    for i, start, end, target in reversed(stage_bounds(stages)):
        here = F.struct(F.lit(i).alias("stage"), F.lit(target).alias("target"))
        stage = F.when((second >= start) & (second < end), here).otherwise(stage)
    rows = log.withColumn("__s", stage).filter(F.col("__s").isNotNull())
    return rows.groupBy(F.col("__s.stage").alias("stage"), F.col("__s.target").alias("target")).agg(
        F.count(F.lit(1)).alias("n"), _share(~F.col("success")).alias("error_rate"), F.avg("response_time_ms").alias("avg_ms"))


def active_users(log: DataFrame, every: str = "1 minute", exact: bool = True) -> DataFrame:
    """Distinct users per interval."""
    users = F.countDistinct("vu") if exact else F.approx_count_distinct("vu")
    return log.groupBy(F.window("ts", every).start.alias("start")).agg(users.alias("users"))


LOG = T.StructType([
    T.StructField("ts", T.TimestampType()), T.StructField("vu", T.LongType()), T.StructField("iter", T.LongType()),
    T.StructField("op", T.StringType()), T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("success", T.BooleanType()), T.StructField("empty", T.BooleanType()),
    T.StructField("response_time_ms", T.LongType()), T.StructField("recall", T.DoubleType()),
    T.StructField("rows", T.LongType()), T.StructField("error", T.StringType()),
])
