"""D2 and D3 on a stream: accuracy and score drift per event-time window.

The state of a window is its counts per score bin, rows and correct
predictions: sums that merge, kept by Structured Streaming across micro-batches
and restarts.  A window is written once, when the watermark (the largest event
time seen less ``delay``) has passed its end; rows that come later than that are
left out.  Accuracy (D2) and the population stability index against a baseline's
bins (D3) are derived from the written counts, by the same functions for stream
and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.streaming.score import ACCURACY_DROP, DRIFT_LIMIT, PSI_EPS


def score_bin(score, edges: list[float]):
    """Number of edges below the score (right-closed bins); null for a null score."""
    return F.when(score.isNotNull(), sum(((score > F.lit(e)).cast("int") for e in edges), F.lit(0)))


def window_counts(pred: DataFrame, edges: list[float], ts: str = "ts", period: str = "1 day",
                  delay: str = "6 hours", score: str = "p1") -> DataFrame:
    """(start, end, bin, n, hits) per window and score bin of a batch or a stream
    with ``label``, ``prediction`` and a score."""
    if pred.isStreaming:
        pred = pred.withWatermark(ts, delay)
    correct = (F.col("label").cast("int") == F.col("prediction").cast("int")).cast("int")
    rows = pred.select(ts, score_bin(F.col(score), edges).alias("bin"), correct.alias("correct"))
    return (rows.groupBy(F.window(ts, period).alias("w"), "bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("correct").alias("hits"))
            .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "bin", "n", "hits"))


def monitor_stream(pred: DataFrame, sink_path: str, checkpoint: str, edges: list[float], **options):
    """The writer of the closed windows' counts: parquet, exactly once, restartable."""
    return (window_counts(pred, edges, **options).writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def closed_windows(counts: DataFrame, watermark) -> DataFrame:
    """Of a batch's windows those that a stream with this watermark has written."""
    return counts.where(F.col("end") <= F.lit(watermark))


def window_performance(counts: DataFrame, baseline_accuracy: float, drop: float = ACCURACY_DROP) -> DataFrame:
    """(start, n, accuracy, accuracy_drop, alert) per window."""
    out = counts.groupBy("start").agg(F.sum("n").alias("n"), (F.sum("hits") / F.sum("n")).alias("accuracy"))
    return out.withColumn("accuracy_drop", F.lit(float(baseline_accuracy)) - F.col("accuracy")).withColumn(
        "alert", F.col("accuracy_drop") > drop)


def window_drift(counts: DataFrame, baseline: list[int], limit: float = DRIFT_LIMIT) -> DataFrame:
    """D3: (start, psi, drift_alert) per window against the baseline's rows per bin."""
    total = sum(baseline)
    shares = [max(n / total, PSI_EPS) if total else PSI_EPS for n in baseline]
    own = [F.greatest(F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)) / F.sum("n"), F.lit(PSI_EPS))
           for i in range(len(baseline))]
    psi = sum(((s - a) * F.log(s / a) for s, a in zip(own, map(F.lit, shares))), F.lit(0.0))
    scored = counts.where(F.col("bin").isNotNull())
    return scored.groupBy("start").agg(psi.alias("psi")).withColumn("drift_alert", F.col("psi") > limit)
