"""Windowed measures over an operation log. Every function takes a batch or a streaming frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.operators.logs import passes, threshold_rules

LATE = "2 minutes"

# Upper bounds of the latency buckets in milliseconds; the last bucket is open.
BUCKETS_MS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0, 10000.0]


def with_watermark(log: DataFrame, late: str = LATE) -> DataFrame:
    """Rows later than ``late`` are dropped by streaming aggregates."""
    return log.withWatermark("ts", late) if log.isStreaming else log


def _window(every: str, slide: str | None) -> Column:
    return F.window("ts", every, slide) if slide else F.window("ts", every)


@dataclass(frozen=True)
class Measure:
    """A windowed measure in two steps: ``parts`` that add up per window and key, and ``finish``, which turns them into its columns.

    Every part is one count, sum or maximum, so a stream's state holds just these numbers for each open window.
    """

    keys: dict[str, Column | None]
    parts: dict[str, Column]
    finish: Callable[[DataFrame], DataFrame]
    every: str = "1 minute"
    slide: str | None = None

    def partial(self, log: DataFrame, late: str = LATE) -> DataFrame:
        """(start, end, keys, parts) of a batch or a stream."""
        w, keys = F.col("window"), [F.col(n) if c is None else c.alias(n) for n, c in self.keys.items()]
        rows = with_watermark(log, late).groupBy(_window(self.every, self.slide).alias("window"), *keys).agg(*[c.alias(n) for n, c in self.parts.items()])
        return rows.select(w.start.alias("start"), w.end.alias("end"), *self.keys, *self.parts)

    def of(self, log: DataFrame, late: str = LATE) -> DataFrame:
        return self.finish(self.partial(log, late))


def _share(part: str, of: str) -> Column:
    """Null where there is nothing to share."""
    return F.col(part).cast("double") / F.when(F.col(of) > 0, F.col(of))


def op_rate_measure(every: str = "1 minute", slide: str | None = None) -> Measure:
    per_s = F.col("n") / (F.col("end").cast("double") - F.col("start").cast("double"))
    return Measure({"op": None}, {"n": F.count(F.lit(1))}, lambda d: d.select("start", "op", "n", per_s.alias("per_s")), every, slide)


def op_rate(log: DataFrame, every: str = "1 minute", slide: str | None = None, late: str = LATE) -> DataFrame:
    """Operations per second by window and operation; ``slide`` makes windows overlap."""
    return op_rate_measure(every, slide).of(log, late)


def recall_measure(every: str = "1 minute") -> Measure:
    return Measure({}, {"n": F.count("recall"), "total": F.sum("recall")}, lambda d: d.select("start", "n", _share("total", "n").alias("avg_recall")), every)


def recall_over_time(log: DataFrame, every: str = "1 minute", late: str = LATE) -> DataFrame:
    """Mean recall by window over the rows that measured it."""
    return recall_measure(every).of(log, late)


def ratios_measure(search_ops: Sequence[str], every: str = "1 minute") -> Measure:
    parts = {"searches": F.count_if(F.col("op").isin(list(search_ops))), "errors": F.count_if(~F.col("success")), "empties": F.count_if(F.col("empty"))}
    return Measure({}, parts, lambda d: d.select("start", "searches", _share("errors", "searches").alias("error_ratio"), _share("empties", "searches").alias("empty_ratio")), every)


def search_ratios(log: DataFrame, search_ops: Sequence[str], every: str = "1 minute", late: str = LATE) -> DataFrame:
    """Failed and empty operations over search operations by window; null without searches."""
    return ratios_measure(search_ops, every).of(log, late)


def checkpoint_measure(every: str = "1 minute") -> Measure:
    parts = {"n": F.count(F.lit(1)), "timed": F.count("response_time_ms"), "total": F.sum("response_time_ms")}
    return Measure({"op": None}, parts, lambda d: d.select("start", "op", "n", _share("total", "timed").alias("avg_ms")), every)


def checkpoints(log: DataFrame, every: str = "1 minute", late: str = LATE) -> DataFrame:
    """Mean latency and samples by window and operation."""
    return checkpoint_measure(every).of(log, late)


# ---------------------------------------------------------------- histogram quantiles


def bucket_of(value: Column | str, bounds: Sequence[float] = BUCKETS_MS) -> Column:
    """Smallest bound not below the value; infinity beyond the last."""
    v = F.col(value) if isinstance(value, str) else value
    out = F.lit(float("inf"))
    for bound in sorted(bounds, reverse=True):
        out = F.when(v <= bound, F.lit(float(bound))).otherwise(out)
    return out


def bucket_measure(every: str = "1 minute", bounds: Sequence[float] = BUCKETS_MS) -> Measure:
    return Measure({"op": None, "le": bucket_of("response_time_ms", bounds)}, {"n": F.count(F.lit(1))}, lambda d: d.select("start", "op", "le", "n"), every)


def bucket_counts(log: DataFrame, every: str = "1 minute", bounds: Sequence[float] = BUCKETS_MS, late: str = LATE) -> DataFrame:
    """Rows per window, operation and bucket: the part that runs as a stream."""
    return bucket_measure(every, bounds).of(log, late)


def histogram_quantiles(counts: DataFrame, shares: Sequence[float] = (0.5, 0.95, 0.99),
                        bounds: Sequence[float] = BUCKETS_MS) -> DataFrame:
    """Quantiles by linear interpolation inside the bucket that holds the rank.

    The first bucket starts at 0; a rank in the open last bucket gives the highest bound.
    """
    lower = F.lit(0.0)
    for low, high in zip(sorted(bounds), [*sorted(bounds)[1:], float("inf")]):
        lower = F.when(F.col("le") == high, F.lit(float(low))).otherwise(lower)
    group = Window.partitionBy("start", "op")
    running = group.orderBy("le").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = counts.select("start", "op", "le", "n", lower.alias("low"), F.sum("n").over(group).alias("total"), F.sum("n").over(running).alias("cum"))
    outs = []
    for share in shares:
        rank = F.col("total") * F.lit(float(share))
        here = (F.col("cum") >= rank) & (F.col("cum") - F.col("n") < rank)
        inside = F.when(F.col("le") == float("inf"), F.col("low")).otherwise(
            F.col("low") + (F.col("le") - F.col("low")) * (rank - (F.col("cum") - F.col("n"))) / F.col("n"))
        outs.append(F.min(F.when(here, inside)).alias(f"p{share * 100:g}".replace(".", "_")))
    return rows.groupBy("start", "op").agg(F.sum("n").alias("n"), *outs)


# ---------------------------------------------------------------- alerts


def long_measure(every: str = "1 minute") -> Measure:
    flags = {"success": ~F.col("success"), "empty": F.col("empty")}
    parts = {"n_ms": F.count("response_time_ms"), "sum_ms": F.sum("response_time_ms"), "top_ms": F.max("response_time_ms"),
             **{f"n_{n}": F.count(n) for n in flags}, **{f"sum_{n}": F.count_if(c) for n, c in flags.items()},
             "n_recall": F.count("recall"), "sum_recall": F.sum("recall")}
    observed = {"avg_ms": _share("sum_ms", "n_ms"), "max_ms": F.col("top_ms").cast("double"), "error_rate": _share("sum_success", "n_success"),
                "empty_rate": _share("sum_empty", "n_empty"), "avg_recall": _share("sum_recall", "n_recall")}
    steps = F.array(*[F.struct(F.lit(n).alias("measure"), c.alias("observed")) for n, c in observed.items()])
    return Measure({"op": None}, parts, lambda d: d.select("start", "op", F.inline(steps)), every)


def window_measures(log: DataFrame, every: str = "1 minute", late: str = LATE) -> DataFrame:
    """Long-form measures by window and operation: ``(start, op, measure, observed)``."""
    return long_measure(every).of(log, late)


def alerts(measures: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Windows that break a rule ``(measure, "avg<100")``; the aggregate word is only descriptive."""
    table = {}
    for r in threshold_rules(rules):
        table.setdefault(r["metric"], []).append(F.struct(F.lit(r["comparator"]).alias("comparator"), F.lit(r["limit"]).alias("limit")))
    by_measure = F.create_map(*[x for m, rs in table.items() for x in (F.lit(m), F.array(*rs))])
    rows = measures.select("start", "op", "measure", "observed", F.inline(F.element_at(by_measure, F.col("measure"))))
    return rows.filter(F.col("observed").isNotNull() & ~passes("observed"))
