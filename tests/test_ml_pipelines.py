"""Property tests for fitted pipelines, models and the advanced operators."""

import pytest
from pyspark.sql import functions as F

from featureforge import Roles
from featureforge.ml import models as M
from featureforge.ml.isolation import IsolationForestFlag
from featureforge.ml.iterative import iterative_impute
from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.engineer import engineering_pipeline
from featureforge.streaming.score import psi
from tests.conftest import SF_SMOKE

R = Roles()
SCHEMA = ("customerID string, tenure bigint, MonthlyCharges double, TotalCharges string, "
          "Contract string, PaymentMethod string, SeniorCitizen bigint, Partner string, "
          "Dependents string, InternetService string, OnlineSecurity string, Churn string")


def _rows(n=60):
    out = []
    for i in range(n):
        out.append((f"c{i}", i % 73, 20.0 + (i * 7) % 100, str(round((20.0 + (i * 7) % 100) * (i % 73), 2)),
                    ["Month-to-month", "One year", "Two year"][i % 3],
                    ["Electronic check", "Mailed check", "Bank transfer (automatic)"][i % 3],
                    int(i % 6 == 0), "Yes" if i % 2 else "No", "Yes" if i % 5 == 0 else "No",
                    ["DSL", "Fiber optic", "No"][i % 3], "Yes" if i % 4 == 0 else "No",
                    "Yes" if i % 3 == 0 else "No"))
    return out


def test_engineering_transform_is_one_projection(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    model = engineering_pipeline(R).fit(df)
    out = model.transform(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan     # 0 shuffles, 0 jobs at transform
    assert out.count() == 60
    assert "customerID" in out.columns and not any(c.startswith("customerID_") for c in out.columns)


def test_models_fit_and_score(spark):
    fm = churn_features(spark, SF_SMOKE).withColumnRenamed("customer_id", "id").cache()
    m = M.make_pipeline("random_forest", FEATURES, n_estimators=10).fit(fm)
    imps = [v for _, v in M.native_importance(m, FEATURES)]
    assert sum(imps) == pytest.approx(1.0)
    p = M.predictions(m, fm, "random_forest").collect()
    assert all(0.0 <= r["p1"] <= 1.0 for r in p) and len(p) == fm.count()


def test_iterative_impute_fills_everything(spark):
    d = spark.range(200).select(F.col("id").cast("double").alias("a"),
                                (F.col("id") * 2 + 1).cast("double").alias("b"))
    d = d.withColumn("b", F.when(F.col("a") % 10 == 0, None).otherwise(F.col("b")))
    out = iterative_impute(d, ["a", "b"], max_iter=3).collect()
    assert all(r["b"] is not None for r in out)
    assert max(abs(r["b"] - (2 * r["a"] + 1)) for r in out) < 5.0          # linear relation recovered


def test_isolation_forest_contamination(spark):
    d = spark.range(1000).select("id", (F.col("id") % 97).cast("double").alias("x"),
                                 F.when(F.col("id") < 20, 1000.0).otherwise((F.col("id") % 13).cast("double")).alias("y"))
    model = IsolationForestFlag(["x", "y"], "id", n_trees=30, contamination=0.05).fit(d)
    out = model.transform(d)
    flagged = out.where("is_outlier = 1").select("id").collect()
    assert 30 <= len(flagged) <= 70
    assert sum(1 for r in flagged if r["id"] < 20) >= 15                  # the planted outliers


def test_psi_zero_for_identical_distributions(spark):
    d = spark.range(1000).select((F.col("id") / 1000.0).alias("p1"))
    assert psi(d, d).first()["psi"] == pytest.approx(0.0, abs=1e-12)
