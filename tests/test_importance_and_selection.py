"""Permutation importance (P2) and model-based selection."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from featureforge.ml import explain as P
from featureforge.ml import selection as L


class _Scorer:
    """Scores by one column; counts how often rows are sent through it."""

    def __init__(self):
        self.calls = 0

    def transform(self, rows):
        self.calls += 1
        p = F.col("a") / 1000.0
        return rows.withColumn("m_probability", array_to_vector(F.array(1 - p, p)))


def test_permutation_importance_scores_all_features_in_one_pass(spark):
    rows = spark.range(1000).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                    F.lit(None).cast("double").alias("c"), (F.col("id") >= 500).cast("int").alias("label"))
    model = _Scorer()
    told = {r["feature"]: r["importance"] for r in P.permutation_importance(model, rows, ["a", "b", "c"], "m", buckets=4).collect()}
    assert model.calls == 1            # a plan per feature does not fit the driver
    assert told["b"] == told["c"] == 0.0
    assert told["a"] == pytest.approx(0.5, abs=0.1)   # a permuted score is as good as chance


@pytest.fixture(scope="module")
def gappy(spark):
    """``a`` tells the label and has nulls, ``b`` has NaN, ``e`` has no value at all."""
    y = (F.col("id") % 3 == 0).cast("int")
    return spark.range(240).select(
        "id", (F.col("id") % 2).cast("int").alias("fold"), y.alias("label"), F.when(F.col("id") % 10 != 0, y * 2.0).alias("a"),
        F.when(F.col("id") % 11 == 0, float("nan")).otherwise((F.col("id") % 7).cast("double")).alias("b"),
        F.lit(None).cast("double").alias("e")).cache()


def test_elimination_takes_rows_with_missing_values(gappy):
    told = {r["feature"]: r["ranking"] for r in L.rfe(gappy, ["a", "b", "e"], 1, trees=5).collect()}
    assert told["a"] == 1 and sorted(told.values()) == [1, 2, 3]


def test_filled_keeps_rows_and_uses_medians(spark):
    rows = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (float("nan"), None)], "x double, y double")
    fills = L.medians(rows, ["x", "y"])
    assert fills == {"x": 2.0, "y": 0.0}
    assert [tuple(r) for r in L.filled(rows, fills).collect()] == [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0), (2.0, 0.0)]


@pytest.mark.parametrize("estimator", ["random_forest", "lasso"])
def test_selection_takes_rows_with_missing_values(gappy, estimator):
    told = {r["feature"]: r for r in L.select_from_model(gappy, ["a", "b", "e"], estimator).collect()}
    assert told["a"]["selected"] and not told["b"]["selected"]
    assert told["e"]["score"] == 0.0


def test_elimination_by_folds_takes_rows_with_missing_values(gappy):
    sizes = L.rfe_cv(gappy, ["a", "b", "e"], "fold", 2, step=1, trees=3).collect()
    assert [r["n_features"] for r in sizes] == [1, 2, 3] and all(r["cv_auc"] > 0.8 for r in sizes)


def test_stability_selection_takes_rows_with_missing_values(gappy):
    told = {r["feature"]: r["frequency"] for r in L.stability_selection(gappy, ["a", "b", "e"], n_bootstrap=3, trees=5).collect()}
    assert told["a"] == 1.0 and told["e"] == 0.0
