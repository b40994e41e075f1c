"""Log analytics with values worked out by hand."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from nearfield.operators import logs

T0 = dt.datetime(2024, 1, 1)


def log_frame(spark, rows):
    """rows: (second, vu, op, ms, success)"""
    data = [(T0 + dt.timedelta(seconds=s), vu, i, op, {"mode": "a" if i % 2 else "b"}, ok, False, ms, 1.0, 10, None if ok else "failed to search: timeout")
            for i, (s, vu, op, ms, ok) in enumerate(rows)]
    return spark.createDataFrame(data, logs.LOG)


def values(spark, xs, by="g"):
    return spark.createDataFrame([(by, float(x)) for x in xs], "g string, response_time_ms double")


@pytest.mark.parametrize("n", [1, 2, 20, 21, 100, 101, 150])
def test_nearest_rank(spark, n):
    xs = [(i * 37) % n + 1 for i in range(n)] if math.gcd(37, n) == 1 else list(range(1, n + 1))
    s = sorted(xs)
    row = logs.latency_stats(values(spark, xs).repartition(3), ["g"]).first()
    assert (row["n"], row["min"], row["max"]) == (n, s[0], s[-1]) and row["avg"] == pytest.approx(sum(s) / n)
    assert row["p50"] == s[math.floor(n * 0.5)]
    assert row["p95"] == (s[-1] if n <= 20 else s[math.floor(n * 0.95)])
    assert row["p99"] == (s[-1] if n <= 100 else s[math.floor(n * 0.99)])
    p = logs.percentile_nearest(values(spark, xs), 95, ["g"]).first()["percentile"]
    assert p == s[min(math.floor(n * 95 / 100), n - 1)]


def test_nearest_rank_with_hot_negative_and_fractional_values(spark):
    xs = [-5.5, -5.25, 0.0, 0.001, 7.0] + [7.0] * 40 + [1e9, 3e9]
    row = logs.latency_stats(values(spark, xs), ["g"]).first()
    s = sorted(xs)
    assert (row["min"], row["p50"], row["p95"], row["max"]) == (-5.5, s[23], s[math.floor(47 * 0.95)], 3e9)


def test_empty_log_gives_zeros(spark):
    empty = values(spark, []).limit(0)
    assert tuple(logs.latency_stats(empty).first()) == (0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    assert tuple(logs.percentile_nearest(empty, 95).first()) == (0, 0.0)


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, response_time_ms double")
    rows = {r["g"]: (r["n"], r["max"]) for r in logs.latency_stats(df, ["g"]).collect()}
    assert rows == {None: (2, 3.0), "a": (1, 2.0)}


def test_interpolated_matches_builtin(spark):
    df = values(spark, [1, 2, 3, 4, 10, 50])
    mine = logs.interpolated(df, ["g"], "response_time_ms", [50, 95]).first()
    built_in = df.agg(F.percentile("response_time_ms", F.lit(0.5)), F.percentile("response_time_ms", F.lit(0.95))).first()
    assert (mine["p(50)"], mine["p(95)"]) == pytest.approx(tuple(built_in))


def test_metric_classes(spark):
    names = ["search_latency", "Duration_total", "qps", "recall_rate", "recall", "errors", "size"]
    df = spark.createDataFrame([(n,) for n in names], "metric string")
    assert [r[0] for r in df.select(logs.metric_class("metric")).collect()] == [
        "latency", "latency", "throughput", "throughput", "quality", "quality", "other"]


def test_rates_and_breakdowns(spark):
    log = log_frame(spark, [(0, 1, "search", 10, True), (1, 1, "search", 6000, False), (2, 2, "insert", 30, True), (4, 2, "insert", 50, True)])
    rates = {r["op"]: (r["n"], r["error_rate"], r["timeout_rate"]) for r in logs.op_rates(log).collect()}
    assert rates == {"search": (2, 0.5, 0.5), "insert": (2, 0.0, 0.0), None: (4, 0.25, 0.25)}
    t = logs.throughput(log).first()
    assert (t["seconds"], t["ops_per_s"], t["rows_per_s"]) == (4.0, 1.0, 10.0)
    assert logs.throughput(log.limit(1)).first()["ops_per_s"] is None
    tags = {(r["mode"], r["level"]): r["n"] for r in logs.tag_breakdown(log, ["mode"]).collect()}
    assert tags == {("a", 0): 2, ("b", 0): 2, (None, 1): 4}
    checks = {r["check"]: r["pass_rate"] for r in logs.check_rates(log, {"ok": F.col("success"), "known": F.col("error") == "x"}).collect()}
    assert checks == {"ok": 0.75, "known": 0.0}
    mix = {r["op"]: round(r["deviation"], 6) for r in logs.mix_audit(log, {"search": 3, "delete": 1}).collect()}
    assert mix == {"search": -0.25, "insert": 0.5, "delete": -0.25}
    ab = logs.ab_compare(log.withColumn("side", F.col("tags")["mode"]), "side", "b", "a").orderBy("op").collect()
    assert [(r["op"], r["avg_a"], r["avg_b"], r["delta"], r["ratio"]) for r in ab] == [("insert", 30.0, 50.0, 20.0, 50 / 30), ("search", 10.0, 6000.0, 5990.0, 600.0)]
    users = logs.active_users(log, "2 seconds").orderBy("start").collect()
    assert [r["users"] for r in users] == [1, 1, 1]


def test_recall_zero_means_unset(spark):
    df = spark.createDataFrame([(0.0,), (0.5,)], "recall double")
    assert logs.measured_recall(df).agg(F.avg("recall")).first()[0] == 0.5
    assert logs.measured_recall(df, zero_is_unset=False).agg(F.avg("recall")).first()[0] == 0.25


def test_errors(spark):
    df = spark.createDataFrame([("failed to search: rpc: timeout",), ("cancelled",), ("failed to search: rpc: timeout",), (None,), ("",)], "error string")
    rows = {(r["prefix"], r["cause"]): r["n"] for r in logs.error_breakdown(df).collect()}
    assert rows == {("failed to search", "rpc: timeout"): 2, ("cancelled", ""): 1}


def test_thresholds(spark):
    rows = [(T0, "lat", float(i), {"m": "x" if i <= 50 else "y"}) for i in range(1, 101)] + [(T0, "err", 0.0, None), (T0, "err", 1.0, None)]
    points = spark.createDataFrame(rows, "ts timestamp, metric string, value double, tags map<string,string>")
    rules = [("lat", "p(95)<95"), ("lat", "p(95)<95.1"), ("lat", "max<=50", {"m": "x"}), ("err", "rate<0.5"), ("none", "avg<1"), ("lat", "avg > 50")]
    got = [(r["observed"] and round(r["observed"], 6), r["passed"]) for r in logs.evaluate_thresholds(points, rules).orderBy("rule").collect()]
    assert got == [(95.05, False), (95.05, True), (50.0, True), (0.5, False), (None, True), (50.5, True)]
    with pytest.raises(ValueError):
        logs.threshold_rules([("a", "median<3")])


def test_matrix(spark):
    q = spark.range(2)
    assert logs.expand_matrix(q, {}).count() == 2
    rows = logs.expand_matrix(q, {"a": [1, 2], "b": [3]}).collect()
    assert sorted((r["id"], r["params"]["a"], r["params"]["b"]) for r in rows) == [(0, "1", "3"), (0, "2", "3"), (1, "1", "3"), (1, "2", "3")]
    assert logs.expand_matrix(q, {"a": []}).count() == 0


def test_runs(spark):
    runs = spark.createDataFrame([("a", 0, False, False, 9.0), ("b", 99, True, False, 5.0), ("c", 1, False, False, 1.0), ("d", 0, False, True, 2.0)],
                                 "params string, exit_code int, thresholds_failed boolean, timed_out boolean, p95 double")
    results = logs.run_results(runs)
    assert {r["params"]: (r["status"], r["thresholds_passed"]) for r in results.collect()} == {
        "a": ("success", True), "b": ("success", False), "c": ("failed", False), "d": ("error", False)}
    assert tuple(logs.run_summary(results).first()) == (4, 2, 2, 1)
    best = logs.best_config(results).first()
    assert (best["best_params"], best["best_p95"], best["thresholds_passed"]) == ("b", 5.0, 1)


def test_durations(spark):
    cases = {"1h30m": 5400, "45s": 45, "2m5s": 125, "90": 300, "": 300, "abc": 300}
    assert {k: logs.duration_seconds(k) for k in cases} == cases
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    assert {r[0]: r[1] for r in df.select("d", logs.duration_column("d")).collect()} == cases
    assert logs.stage_bounds([("1m", 5), ("0s", 9), ("2m", 0)]) == [(0, 0, 60, 5), (1, 60, 60, 9), (2, 60, 180, 0)]


def test_stages_deltas_and_trend(spark):
    log = log_frame(spark, [(0, 1, "s", 10, True), (59, 1, "s", 30, False), (60, 2, "s", 5, True), (60 * 60 * 30, 1, "s", 25, True), (200, 2, "s", 7, True)])
    stages = {r["stage"]: (r["target"], r["n"], r["error_rate"]) for r in logs.stage_metrics(log, [("1m", 5), ("1m", 10)]).collect()}
    assert stages == {0: (5, 2, 0.5), 1: (10, 1, 0.0)}
    deltas = {(r["vu"], r["iter"]): r["delta"] for r in logs.latency_delta(log).collect()}
    assert deltas == {(1, 0): None, (1, 1): 20, (1, 3): 5, (2, 2): None, (2, 4): 2}
    assert deltas == {(r["vu"], r["iter"]): r["delta"] for r in logs.latency_delta(log, "30 seconds").collect()}
    trend = logs.p99_trend(log_frame(spark, [(0, 1, "s", 10, True), (60, 1, "s", 20, True), (120, 1, "s", 30, True)])).first()
    assert (trend["windows"], trend["slope"]) == (3, 10.0)
    points = logs.checkpoints(log).orderBy("start").first()
    assert (points["n"], points["avg_ms"]) == (2, 20.0)


def test_batch_classes(spark):
    df = spark.createDataFrame([(1, 5.0), (10, 7.0), (100, 1.0), (1000, 9.0)], "rows long, response_time_ms double")
    assert {r["batch_class"]: r["n"] for r in logs.batch_class_latency(df).collect()} == {"small": 2, "medium": 1, "large": 1}


def test_points_of_a_log(spark):
    log = log_frame(spark, [(0, 1, "search", 10, True)])
    assert {r["metric"]: r["value"] for r in logs.to_points(log).collect()} == {"search_latency": 10.0, "search_recall": 1.0, "search_error_rate": 0.0}
    assert logs.op_counts(log).first()["n"] == 1


def test_quantiles_in_a_narrow_range_and_without_nan(spark):
    values = [100 + 0.9 * i / 5000 for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in values[::-1]] + [(float("nan"),), (None,)], "v double")
    ranks = {"first": F.lit(0), "mid": F.floor(F.col("n") / 2), "last": F.col("n") - 1}
    row = logs.exact_quantiles(df, [], "v", ranks).first()
    assert (row["n"], row["first"], row["mid"], row["last"]) == (5000, values[0], values[2500], values[-1])
    parts = {int((math.log(v + 1) * 64 % 1) * logs.SUBRANGES) for v in values}
    assert len(parts) > 2000  # what one window has to order is a small part of the range
