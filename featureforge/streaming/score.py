"""Config-declared scoring (D1-D3): batch and Structured Streaming.

D1 applies a fitted ``PipelineModel`` (a pure projection: no job, no
shuffle) and thresholds the positive probability; the same function works
on a streaming DataFrame.  D2 compares accuracy per period with a baseline;
D3 is the population stability index of the score distribution between a
baseline and a current table, on the baseline's score-decile edges (the
deployment config names a drift threshold but no statistic; PSI is our
stated choice).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values from the deployment configuration:
THRESHOLD = 0.5
ACCURACY_DROP = 0.05
DRIFT_LIMIT = 0.1
PSI_EPS = 1e-6


def batch_score(model: PipelineModel | None, df: DataFrame, prob_col: str | None = None,
                name: str = "model", version: str = "v1", threshold: float = THRESHOLD,
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """(keep..., p1, prediction, model_version).  ``model`` may be None
    when ``prob_col`` already holds the positive probability."""
    out = model.transform(df) if model is not None else df
    p = (F.col(prob_col).cast("double") if prob_col
         else vector_to_array(F.col(f"{name}_probability"))[1])
    return out.select(*keep, p.alias("p1"), (p >= threshold).cast("int").alias("prediction"),
                      F.lit(version).alias("model_version"))


def stream_score(model: PipelineModel | None, source: DataFrame, sink_path: str, checkpoint: str,
                 prob_col: str | None = None, name: str = "model", version: str = "v1",
                 keep: Sequence[str] = ("id",)):
    """D1 on a stream: the same projection, appended to parquet with an
    exactly-once checkpoint (restartable after executor or driver loss)."""
    scored = batch_score(model, source, prob_col, name, version, keep=keep)
    return (scored.writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def performance_alert(pred: DataFrame, period_col: str, baseline_accuracy: float,
                      drop: float = ACCURACY_DROP) -> DataFrame:
    """Accuracy per period; alert when it falls more than ``drop`` below
    the baseline."""
    acc = pred.groupBy(period_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("label").cast("int") == F.col("prediction").cast("int")).cast("double")).alias("accuracy"))
    return acc.withColumn("accuracy_drop", F.lit(float(baseline_accuracy)) - F.col("accuracy")) \
              .withColumn("alert", F.col("accuracy_drop") > drop)


def psi(baseline: DataFrame, current: DataFrame, score: str = "p1", bins: int = 10,
        limit: float = DRIFT_LIMIT) -> DataFrame:
    """D3: PSI = sum over bins of (a - b) ln(a / b), shares floored at 1e-6,
    bins = the baseline's exact score deciles (right-closed, open ends)."""
    from featureforge.functions.rank import quantiles
    qs = [i / bins for i in range(1, bins)]
    e = quantiles(baseline, {"e": F.col(score)}, qs)["e"]       # exact, bounded memory
    edges = baseline.sparkSession.createDataFrame([(e,)], "e array<double>")

    def binned(df, tag):
        j = df.select(F.col(score).cast("double").alias("_s")).where(F.col("_s").isNotNull()) \
              .crossJoin(F.broadcast(edges))
        b = F.aggregate("e", F.lit(0), lambda acc, e: acc + F.when(F.col("_s") > e, 1).otherwise(0))
        g = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias(f"n_{tag}"))
        return g
    a, c = binned(baseline, "base"), binned(current, "cur")
    allb = baseline.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    j = allb.join(a, "bin", "left").join(c, "bin", "left").fillna(0, subset=["n_base", "n_cur"])
    tot = j.agg(F.sum("n_base").alias("tb"), F.sum("n_cur").alias("tc"))
    j = j.crossJoin(F.broadcast(tot))
    sa = F.greatest(F.col("n_base") / F.col("tb"), F.lit(PSI_EPS))
    sc = F.greatest(F.col("n_cur") / F.col("tc"), F.lit(PSI_EPS))
    out = j.agg(F.sum((sc - sa) * F.log(sc / sa)).alias("psi"))
    return out.withColumn("drift_alert", F.col("psi") > limit)
