"""Iterative (round-robin regression) imputation on Spark ML.

Each round fits, per null-bearing column, a ridge ``LinearRegression`` of the
column on all other (currently imputed) columns over the rows where it is
observed, and replaces only the originally missing cells.  Rounds stop at
``max_iter`` or when the largest change of an imputed value (relative to the
column range) falls below ``tol``.  The growing lineage is cut after every
round with a reliable ``checkpoint()`` into the session's shared checkpoint
folder, so a lost executor recomputes one round, not the whole loop.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.session import cut_lineage


def iterative_impute(df: DataFrame, cols: Sequence[str], max_iter: int = 10, tol: float = 1e-3,
                     reg: float = 1.0) -> DataFrame:
    cols = list(cols)
    miss = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    targets = [c for c in cols if miss[c] > 0]
    if not targets:
        return df
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                   *[(F.max(c) - F.min(c)).alias(f"r_{c}") for c in cols]).first().asDict()
    cur = df
    for c in targets:       # initial fill: column mean
        cur = cur.withColumn(f"_miss_{c}", F.col(c).isNull()).withColumn(
            c, F.coalesce(F.col(c).cast("double"), F.lit(stats[f"m_{c}"])))
    cur = cut_lineage(cur)
    for _ in range(max_iter):
        delta = 0.0
        nxt = cur
        for c in targets:
            others = [o for o in cols if o != c]
            pipe = Pipeline(stages=[VectorAssembler(inputCols=others, outputCol="_it_x", handleInvalid="keep"),
                                    LinearRegression(featuresCol="_it_x", labelCol=c, predictionCol="_it_pred",
                                                     regParam=reg, elasticNetParam=0.0)])
            m = pipe.fit(nxt.where(~F.col(f"_miss_{c}")))
            pred = m.transform(nxt)
            upd = pred.withColumn("_new", F.when(F.col(f"_miss_{c}"), F.col("_it_pred")).otherwise(F.col(c)))
            rng = stats[f"r_{c}"] or 1.0
            d = upd.agg(F.max(F.abs(F.col("_new") - F.col(c)))).first()[0] or 0.0
            delta = max(delta, d / rng)
            nxt = upd.withColumn(c, F.col("_new")).drop("_new", "_it_pred", "_it_x")
        cur = cut_lineage(nxt)
        if delta < tol:
            break
    return cur.drop(*[f"_miss_{c}" for c in targets])
