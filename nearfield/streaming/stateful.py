"""Keyed streaming state with event-time timers: rows of a key in event-time order, whatever order they arrive in.

A key's rows wait in list state until the watermark has passed them; a timer then releases them in order, so what is written is final. Rows
later than the watermark are dropped by Spark. State holds a key's rows of the watermark's delay and its last released row, never its history.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from nearfield.operators.logs import latency_delta

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROW = "ts timestamp, iter bigint, response_time_ms bigint"
DELTA = "vu bigint, iter bigint, ts timestamp, delta bigint"


class LatencyDelta(StatefulProcessor):
    """``|x_n - x_(n-1)|`` of a user's rows by (ts, iter), from the row released last."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ROW)
        self.last = handle.getValueState("last", ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest = None
        for frame in rows:
            self.waiting.appendList([tuple(r) for r in frame[["ts", "iter", "response_time_ms"]].itertuples(index=False)])
            top = frame["ts"].max()
            latest = top if latest is None else max(latest, top)
        if latest is not None:  # one timer per batch: at the latest row's time all of them can go
            self.handle.registerTimer(-(-pd.Timestamp(latest).value // 1_000_000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        rows = pd.DataFrame(list(self.waiting.get()), columns=["ts", "iter", "response_time_ms"])
        if not len(rows):
            return
        ready = pd.to_datetime(rows["ts"]) <= mark
        out = rows[ready].sort_values(["ts", "iter"], kind="stable")
        if not len(out):
            return
        rest = rows[~ready]
        self.waiting.clear()
        if len(rest):
            self.waiting.put([tuple(r) for r in rest.itertuples(index=False)])
        before = self.last.get()
        values = out["response_time_ms"].astype("Int64")
        shifted = values.shift(1)
        if before is not None:
            shifted.iloc[0] = before[2]
        end = out.iloc[-1]
        self.last.update((end["ts"], int(end["iter"]), None if pd.isna(values.iloc[-1]) else int(values.iloc[-1])))
        yield pd.DataFrame({"vu": key[0], "iter": out["iter"].astype("Int64"), "ts": out["ts"], "delta": (values - shifted).abs()})

    def close(self) -> None:
        pass


def ordered_deltas(log: DataFrame, late: str) -> DataFrame:
    """The stream of deltas that the watermark has made final."""
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = log.withWatermark("ts", late).select("vu", "ts", "iter", "response_time_ms")
    return rows.groupBy("vu").transformWithStateInPandas(LatencyDelta(), outputStructType=DELTA, outputMode="append", timeMode="eventTime")


def open_deltas(spark: SparkSession, checkpoint: str, slots: str) -> DataFrame:
    """Deltas of the rows that still wait, read from the state beside the running stream; later rows may come between them."""

    def state(name: str, value: str) -> DataFrame:
        rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
        return rows.select(F.col("key.vu").alias("vu"), f"{value}.*")

    last = state("last", "value").withColumn("released", F.lit(True))
    rows = state("waiting", "list_element").withColumn("released", F.lit(False)).unionByName(last)
    deltas = latency_delta(rows.drop("released"), slots).select("vu", "iter", "ts", "delta")
    done = last.select("vu", "iter", "ts")
    return deltas.join(done, ["vu", "iter", "ts"], "left_anti")
