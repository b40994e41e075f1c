"""Streams read to their end equal the batch form; late rows are dropped in append mode only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nearfield.operators import logs, tables
from nearfield.sources.points import stream_points
from nearfield.streaming import sinks, windows

T0 = dt.datetime(2024, 1, 1)


def entry(second, vu, i, op="search", ms=10, ok=True, recall=0.9):
    return (T0 + dt.timedelta(seconds=second), vu, i, op, {}, ok, not ok, ms, recall, 10, None)


@pytest.fixture
def folder(spark, tmp_path):
    """Four files, read one per batch in the order of their times."""
    files = [[entry(0, 1, 0), entry(30, 2, 1, ms=100), entry(70, 1, 2, "insert", 50)],
             [entry(100, 1, 3, ms=700, ok=False), entry(400, 2, 4, ms=30)],
             [entry(410, 2, 7, ms=30)], [entry(20, 3, 5, ms=1), entry(900, 1, 6, ms=20)]]
    path = str(tmp_path / "log")
    for rows in files:
        spark.createDataFrame(rows, logs.LOG).coalesce(1).write.mode("append").parquet(path)
        # file streams order files by modification time, which must differ
        import time

        time.sleep(1.1)
    return path


def stream(spark, folder):
    return sinks.table_stream(spark, folder, files_per_trigger=1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("measure", [
    lambda d: windows.op_rate(d), lambda d: windows.op_rate(d, "1 minute", "15 seconds"), windows.recall_over_time,
    lambda d: windows.search_ratios(d, ["search"]), windows.checkpoints, windows.window_measures, windows.bucket_counts])
def test_stream_equals_batch(spark, folder, measure):
    batch = spark.read.schema(logs.LOG).parquet(folder)
    assert rows(sinks.complete_table(measure(stream(spark, folder)))) == rows(measure(batch))


def test_late_rows_are_dropped_in_append_mode(spark, folder):
    got = rows(sinks.append_table(windows.op_rate(stream(spark, folder), "1 minute", late="2 minutes")).select("start", "op", "n"))
    # rows count as late against the watermark of the batch before, so second 20 comes one batch
    # too late for its window; the last window stays open
    assert got == sorted([(T0, "search", 2), (T0 + dt.timedelta(minutes=1), "insert", 1), (T0 + dt.timedelta(minutes=1), "search", 1),
                          (T0 + dt.timedelta(minutes=6), "search", 2)], key=repr)


def test_histogram_quantiles(spark):
    counts = spark.createDataFrame([(T0, "s", 10.0, 10), (T0, "s", 50.0, 80), (T0, "s", float("inf"), 10), (T0, "t", 1.0, 4)],
                                   "start timestamp, op string, le double, n long")
    got = {r["op"]: r for r in windows.histogram_quantiles(counts, (0.05, 0.5, 0.95)).collect()}
    # bucket (25, 50] holds ranks 10..90: the lower bound is the bound before it in the full list
    assert got["s"]["p5"] == pytest.approx(5 + 5 * 0.5) and got["s"]["p50"] == pytest.approx(25 + 25 * 0.5)
    assert got["s"]["p95"] == windows.BUCKETS_MS[-1] and got["t"]["p50"] == pytest.approx(0.5)


def test_alerts(spark, folder):
    batch = spark.read.schema(logs.LOG).parquet(folder)
    broken = windows.alerts(windows.window_measures(batch), [("max_ms", "max<500"), ("avg_recall", "avg>=0.95")])
    assert {(r["measure"], r["observed"]) for r in broken.filter("measure = 'max_ms'").collect()} == {("max_ms", 700.0)}
    assert broken.filter("measure = 'avg_recall'").count() == 5


def test_latency_delta_across_batches(spark, folder):
    got = {(r["vu"], r["iter"]): r["delta"] for r in sinks.stream_latency_delta(stream(spark, folder), late="10 minutes").collect()}
    batch = {(r["vu"], r["iter"]): r["delta"] for r in logs.latency_delta(spark.read.schema(logs.LOG).parquet(folder)).collect()}
    assert got == batch and got[(1, 3)] == 650 and got[(1, 6)] == 680


def test_current_state_across_batches(spark, tmp_path):
    path, schema = str(tmp_path / "changes"), "id long, op string, seq long, v string"
    import time

    for part in ([(1, "insert", 0, "a"), (2, "insert", 1, "b")], [(1, "upsert", 5, "z"), (2, "delete", 4, None)], [(1, "upsert", 3, "late"), (3, "insert", 6, "c")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    got = sinks.stream_current_state(sinks.table_stream(spark, path, files_per_trigger=1), "id")
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, "z"), (3, "c")]
    batch = tables.current_state(spark.read.schema(schema).parquet(path), "id")
    assert rows(got.select("id", "v")) == rows(batch.select("id", "v"))


def test_change_state_is_compacted(spark, tmp_path):
    import random
    import time

    rnd, log, out, schema = random.Random(2), str(tmp_path / "changes"), str(tmp_path / "out"), "id long, op string, seq long, v string"
    changes = [(rnd.randrange(30), rnd.choice(["insert", "upsert", "delete"]), i, f"v{i}") for i in range(120)]
    rnd.shuffle(changes)
    sizes = []
    for start in range(0, 120, 30):
        for at in range(start, start + 30, 10):
            spark.createDataFrame(changes[at: at + 10], schema).coalesce(1).write.mode("append").parquet(log)
            time.sleep(1.1)
        got = sinks.stream_current_state(sinks.table_stream(spark, log, files_per_trigger=1), "id", path=out, compact_every=3)
        assert rows(got) == rows(tables.current_state(spark.createDataFrame(changes[: start + 30], schema), "id"))
        sizes.append(len(sinks._finished(spark, out, "batch")) + len(sinks._finished(spark, f"{out}/base", "upto")))
    assert max(sizes) <= 2 * 3 + 2 and len(sinks._finished(spark, f"{out}/base", "upto")) == 2
    # a compaction that did not finish is not read, and is done again
    sinks.compact_change_state(spark, out, got.schema, "id", "seq", 99)
    import os

    os.remove(f"{out}/base/upto=99/_SUCCESS")
    assert sinks._finished(spark, f"{out}/base", "upto")[-1] < 99
    assert rows(tables.current_state(sinks.read_change_state(spark, out, got.schema), "id")) == rows(tables.current_state(spark.createDataFrame(changes, schema), "id"))


def test_point_stream(spark, tmp_path):
    (tmp_path / "points").mkdir()
    (tmp_path / "points" / "a.json").write_text('{"type":"Point","metric":"m","data":{"time":"2024-01-01T00:00:00Z","value":1}}\nbroken\n')
    got = sinks.append_table(stream_points(spark, str(tmp_path / "points")))
    assert [(r["metric"], r["value"]) for r in got.collect()] == [("m", 1.0)]
    assert stream_points(spark, str(tmp_path / "points")).isStreaming


def test_bucket_bounds(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (10000.0,), (10001.0,)], "v double")
    assert [r[0] for r in df.select(windows.bucket_of(F.col("v"))).collect()] == [1.0, 5.0, 10000.0, float("inf")]


def write_parts(spark, path, parts):
    import time

    for part in parts:
        spark.createDataFrame(part, logs.LOG).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def test_rows_in_time_find_their_place_and_late_rows_are_dropped(spark, tmp_path):
    parts = ([entry(10, 1, 0, ms=10), entry(30, 1, 2, ms=40)], [entry(20, 1, 1, ms=30), entry(50, 1, 3, ms=100)],
             [entry(500, 1, 5, ms=7)], [entry(505, 2, 6, ms=2)], [entry(40, 1, 4, ms=1), entry(490, 1, 8, ms=4)])
    path = str(tmp_path / "late")
    write_parts(spark, path, parts)
    got = {(r["vu"], r["iter"]): r["delta"] for r in sinks.stream_latency_delta(stream(spark, path), late="1 minute").collect()}
    # second 40 comes two batches after second 500, whose watermark has passed it; second 490 is in time and lies between 50 and 500
    assert got == {(1, 0): None, (1, 1): 20, (1, 2): 10, (1, 3): 60, (1, 8): 96, (1, 5): 3, (2, 6): None}


def test_deltas_go_on_where_the_last_run_stopped(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    rows_of = [entry(30 * i + (7 * i) % 20, i % 3, i, ms=(i * 37) % 100) for i in range(60)]
    for i in range(0, 60, 20):
        write_parts(spark, path, [rows_of[i + 10: i + 20], rows_of[i: i + 10]])  # out of order, in time
        got = sinks.stream_latency_delta(stream(spark, path), out, late="15 minutes")
    want = logs.latency_delta(spark.read.schema(logs.LOG).parquet(path))
    assert rows(got) == rows(want.select("vu", "iter", "ts", "delta"))
    state = spark.read.format("statestore").option("path", f"{out}-checkpoint").option("stateVarName", "waiting").load()
    assert 0 < state.count() <= 40  # a quarter of an hour of rows, not all of them


MEASURES = {"rate": lambda: windows.op_rate_measure(), "sliding": lambda: windows.op_rate_measure("1 minute", "15 seconds"), "recall": lambda: windows.recall_measure(),
            "ratios": lambda: windows.ratios_measure(["search"]), "checkpoints": lambda: windows.checkpoint_measure(), "long": lambda: windows.long_measure(),
            "buckets": lambda: windows.bucket_measure()}


@pytest.mark.parametrize("name", ["sliding", "recall", "long", "buckets"])  # the queries compare all with SQL
def test_closed_and_open_windows_equal_the_batch(spark, tmp_path, name):
    measure, path = MEASURES[name](), str(tmp_path / "log")
    write_parts(spark, path, ([entry(0, 1, 0), entry(30, 2, 1, ms=100)], [entry(100, 1, 3, ms=700, ok=False, recall=None), entry(70, 1, 2, "insert", 50)],
                              [entry(400, 2, 4, ms=30)], [entry(410, 2, 7, ms=30), entry(395, 3, 8, recall=0.5)]))
    batch = spark.read.schema(logs.LOG).parquet(path)
    assert rows(sinks.windowed_table(measure, stream(spark, path))) == rows(measure.of(batch))
    closed = sinks.windowed_table(measure, stream(spark, path), with_open=False)
    ends = T0 + dt.timedelta(seconds=410 - 120)
    assert rows(closed) == rows(measure.finish(measure.partial(batch).filter(F.col("end") <= F.lit(ends))))


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    sizes, measure = [], windows.op_rate_measure()
    for hour in range(3):
        write_parts(spark, path, [[entry(3600 * hour + s, s % 5, s) for s in range(0, 3600, 30)]])
        got = sinks.windowed_table(measure, stream(spark, path), out)
        sizes.append(spark.read.format("statestore").option("path", f"{out}-checkpoint").load().count())
    assert rows(got) == rows(measure.of(spark.read.schema(logs.LOG).parquet(path)))
    assert max(sizes) <= 4 and got.count() == 180
