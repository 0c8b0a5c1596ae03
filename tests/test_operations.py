"""Run log and monitoring on a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featureforge.plans.runlog import run_phases
from featureforge.streaming import monitor


def test_run_log_stops_at_the_first_failure(spark, tmp_path):
    def good(phase):
        phase.write(spark.range(7), "a")
        phase.write(spark.range(0), "b")

    def bad(phase):
        phase.write(spark.range(3), "a")
        raise ValueError("no such column")

    rows = run_phases(spark, [("one", good), ("two", bad), ("three", good)], str(tmp_path)).collect()
    assert [(r["phase"], r["success"], r["tables"], r["rows"], r["error"]) for r in rows] == [
        ("one", True, 2, 7, None), ("two", False, 1, 3, "ValueError: no such column")]
    assert all(r["seconds"] >= 0 for r in rows) and spark.read.parquet(f"{tmp_path}/one/a").count() == 7
    assert run_phases(spark, [], str(tmp_path)).count() == 0


SCHEMA = "ts timestamp, label int, prediction int, p1 double"
T0 = dt.datetime(2024, 1, 1)


def rows(hours):
    return [(T0 + dt.timedelta(hours=h, minutes=i), i % 2, int(i % 3 == 0), None if i == 5 else i / 10) for h in hours for i in range(10)]


def run(spark, base, batches, edges):
    """Each batch of rows arrives while the stream is down; it is started anew."""
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        monitor.monitor_stream(stream, f"{base}/out", f"{base}/ckpt", edges).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_stream_equals_batch_across_a_restart(spark, tmp_path):
    edges = [0.25, 0.55]
    one, two = rows(range(0, 40, 3)), rows(range(38, 100, 5))
    got = run(spark, tmp_path, [one, two], edges)
    whole = spark.createDataFrame(one + two, SCHEMA)
    watermark = max(r[0] for r in one + two) - dt.timedelta(hours=6)
    want = monitor.closed_windows(monitor.window_counts(whole, edges), watermark)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.select("start").distinct().count() == 3
    perf = monitor.window_performance(got, 0.6).collect()
    assert all(r["alert"] == (0.6 - r["accuracy"] > 0.05) for r in perf)
    same = monitor.window_drift(got, [3, 2, 4]).collect()
    assert all(r["psi"] == pytest.approx(0.0, abs=1e-9) and not r["drift_alert"] for r in same)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    late = [(T0 + dt.timedelta(hours=1), 1, 1, 0.9)] * 4
    got = run(spark, tmp_path, [rows([0, 5, 40]), late + rows([41, 90])], [0.5])
    first = got.where(F.col("start") == F.lit(T0)).agg(F.sum("n")).first()[0]
    assert first == 20  # the window was written before the late rows came
