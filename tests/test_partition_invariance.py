"""Results do not depend on how the input is partitioned (repartition(1) vs
repartition(16)) -- SURVEY §5(d)."""

from pyspark.sql import functions as F

from featureforge import CUSTOMER_360_ROLES as R
from featureforge.operators import evaluate as V
from featureforge.operators import features as X
from featureforge.operators import profile as P
from featureforge.operators.encode import OneHotEncoder
from featureforge.operators.scale import Scaler
from featureforge.sources.tables import _customer_360
from tests.conftest import SF_SMOKE


def _rows(df, digits=9):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_operators_invariant_to_partitioning(spark):
    base = _customer_360(spark, SF_SMOKE).cache()
    a, b = base.repartition(1), base.repartition(16, "customer_id")
    for fn in (lambda d: X.business_features(d, R),
               lambda d: P.outlier_report(d, R),
               lambda d: P.categorical_profile(d),
               lambda d: OneHotEncoder(exclude=[R.id, R.target]).fit(d).transform(d),
               lambda d: Scaler("robust", exclude=[R.id]).fit(d).transform(d)):
        assert _rows(fn(a)) == _rows(fn(b))


def test_metrics_invariant_to_partitioning(spark):
    p = spark.range(3000).select(
        F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.round((F.col("id") * 7919 % 1000) / 1000.0, 2).alias("p1"))
    p = p.withColumn("prediction", (F.col("p1") >= 0.5).cast("int"))
    for d1, d2 in [(p.repartition(1), p.repartition(16))]:
        h1, h2 = V.score_histogram(d1), V.score_histogram(d2)
        assert _rows(V.roc_auc(h1)) == _rows(V.roc_auc(h2))
        assert _rows(V.cumulative_gains(d1, h1)) == _rows(V.cumulative_gains(d2, h2))
