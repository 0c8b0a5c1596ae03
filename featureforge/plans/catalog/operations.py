"""Catalogued queries: run log (R6), monitoring on a stream (D2, D3), scoring a
stream with a saved model (D1)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from featureforge.functions.rank import quantiles
from featureforge.ml import models as M
from featureforge.plans.catalog.models import _split
from featureforge.plans.catalog.workflows import _w3
from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.registry import register
from featureforge.plans.runlog import run_phases
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.session import scratch_path
from featureforge.sources.tables import customer_360, customer_360_dirty, table
from featureforge.streaming import monitor
from featureforge.streaming import score as D

_DECILES = [i / 10 for i in range(1, 10)]


@register("r6_run_log", digits=None)
def q_runlog(spark, sf):
    """The three phases W1-W3, each with its outcome, seconds, tables and rows."""
    from featureforge.plans.engineer import engineer
    from featureforge.plans.explore import explore

    def explored(phase):
        for name, report in explore(customer_360_dirty(spark, sf), R).items():
            phase.write(report, name)

    def engineered(phase):
        phase.write(engineer(customer_360(spark, sf), R)[0], "features")

    def developed(phase):
        done = _w3(spark, sf)
        for name in ("test_metrics", "comparison", "cv", "trials", "interpretation"):
            phase.write(done[name], name)

    base = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    return run_phases(spark, [("explore", explored), ("engineer", engineered), ("develop", developed)], base)


def _scored_events(events):
    """Events as predictions: a score from the value, a label from the type."""
    p = F.col("value") / (F.col("value") + 50)
    return events.select(F.col("ts").cast("timestamp").alias("ts"), p.alias("p1"), (p >= 0.5).cast("int").alias("prediction"),
                         F.col("event_type").isin("click", "purchase").cast("int").alias("label"))


_MONITOR_SQL = """
WITH e AS (SELECT ts, value / (value + 50) AS p1, CAST(event_type IN ('click', 'purchase') AS INTEGER) AS label FROM events),
q AS (SELECT quantile_cont(p1, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges, count(*) AS total,
             max(ts) - INTERVAL 6 HOUR AS watermark FROM e),
b AS (SELECT date_trunc('day', ts) AS day, (SELECT count(*) FROM unnest(edges) t(v) WHERE p1 > t.v) AS bin,
             CAST(label = CAST(p1 >= 0.5 AS INTEGER) AS INTEGER) AS hit FROM e, q),
base AS (SELECT bin, count(*) * 1.0e0 / (SELECT total FROM q) AS share FROM b GROUP BY bin),
days AS (SELECT day, count(*) AS n, avg(hit) AS accuracy FROM b GROUP BY day),
drift AS (SELECT day, sum((greatest(s, 1e-6) - share) * ln(greatest(s, 1e-6) / share)) AS psi
          FROM (SELECT day, bin, share, (SELECT count(*) FROM b WHERE b.day = days.day AND b.bin = base.bin) * 1.0e0 / n AS s
                FROM days CROSS JOIN base) GROUP BY day)
SELECT strftime(day, '%Y-%m-%d') AS day, n, round(accuracy, 6) AS accuracy, round(0.5 - accuracy, 6) AS accuracy_drop,
       0.5 - accuracy > 0.05 AS alert, round(psi, 6) AS psi, psi > 0.1 AS drift_alert
FROM days JOIN drift USING (day), q WHERE day + INTERVAL 1 DAY <= watermark
"""


@register("d2_d3_stream_monitor", sql=_MONITOR_SQL)
def q_monitor(spark, sf):
    """D2 and D3 per day of the events, from a stream that is stopped in the
    middle and started again: the closed windows of both runs."""
    events = table(spark, sf, "events")
    run = scratch_path(spark, f"monitor-{uuid.uuid4().hex}")
    scored = _scored_events(events)
    edges = quantiles(scored, {"p": F.col("p1")}, _DECILES)["p"]
    whole = {r["bin"]: r["n"] for r in scored.groupBy(monitor.score_bin(F.col("p1"), edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # a row per bin
    middle = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for part in (F.col("ts") <= F.lit(middle), F.col("ts") > F.lit(middle)):
        events.where(part).write.mode("append").parquet(f"{run}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{run}/in")
        q = monitor.monitor_stream(_scored_events(stream), f"{run}/out", f"{run}/checkpoint", edges).trigger(availableNow=True).start()
        q.awaitTermination()
    counts = spark.read.parquet(f"{run}/out")
    both = monitor.window_performance(counts, 0.5).join(
        monitor.window_drift(counts, [whole.get(i, 0) for i in range(10)]), "start")
    return both.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n", "accuracy", "accuracy_drop", "alert", "psi", "drift_alert")


@register("d1_stream_reloaded_model", digits=None)
def q_stream_model(spark, sf):
    """D1 on a stream with a pipeline that was saved and read back: customers
    arrive as files, are joined with their features and scored by the model."""
    from pyspark.ml import PipelineModel
    train, _ = _split(spark, sf)
    run = scratch_path(spark, f"stream-model-{uuid.uuid4().hex}")
    M.make_pipeline("logistic_regression", FEATURES).fit(train).write().overwrite().save(f"{run}/model")
    model = PipelineModel.load(f"{run}/model")
    schema = table(spark, sf, "customer").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(os.path.abspath(sf) if "://" not in sf else sf)
    rows = stream.select(F.col("c_custkey").alias("id")).join(
        churn_features(spark, sf).withColumnRenamed("customer_id", "id"), "id")
    q = D.stream_score(model, rows, f"{run}/out", f"{run}/checkpoint", name="logistic_regression").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{run}/out")
