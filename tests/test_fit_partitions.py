"""Rows of iterative fits lie in few partitions, however many the shuffles have."""

from pyspark.sql import functions as F

from featureforge.ml import models as M
from featureforge.plans.catalog.models import _model_rows
from tests.conftest import SF_SMOKE


def test_model_rows_have_a_partition_per_core(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = _model_rows(spark, SF_SMOKE)
        assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert rows.count() == rows.select("id").distinct().count() == spark.read.parquet(f"{SF_SMOKE}/customer.parquet").count()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_large_inputs_keep_bounded_partitions(spark):
    many = spark.range(0, 1000, 1, 64)
    assert M.for_fits(many, 20 * M.FIT_ROWS).rdd.getNumPartitions() == 20
    assert M.for_fits(many, 20 * M.FIT_ROWS).count() == 1000


def test_meta_learner_reads_a_partition_per_core(spark, monkeypatch):
    """The out-of-fold rows are a union over folds; they are not read in a partition per fold and part."""
    rows = spark.range(0, 120, 1, spark.sparkContext.defaultParallelism).select(
        "id", (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") % 5 + F.col("id") % 2).cast("double").alias("x")).persist()
    seen, fit = [], M.LogisticRegression._fit

    def spied(self, df):
        if self.getFeaturesCol() == "_meta_features":
            seen.append((df.rdd.getNumPartitions(), df.count()))
        return fit(self, df)

    monkeypatch.setattr(M.LogisticRegression, "_fit", spied)
    M.stacking(rows, ["x"], ("naive_bayes",), "fold", 3)
    rows.unpersist()
    assert seen == [(spark.sparkContext.defaultParallelism, 120)]
