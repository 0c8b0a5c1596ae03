"""Boundary rows from the fixtures (inline data, canonical column names)."""

import math

import pytest
from pyspark.sql import functions as F

from featureforge import Roles
from featureforge.operators import encode as E
from featureforge.operators import evaluate as V
from featureforge.operators import features as X
from featureforge.operators import impute as I
from featureforge.operators import outlier as O
from featureforge.operators import profile as P
from featureforge.operators import scale as C

R = Roles()
SCHEMA = ("customerID string, tenure bigint, MonthlyCharges double, TotalCharges string, "
          "Contract string, PaymentMethod string, SeniorCitizen bigint, Partner string, "
          "Dependents string, InternetService string, Churn string")


def rows():
    return [
        ("a", 0, 0.0, " ", "Month-to-month", "Electronic check", 0, "No", "No", "No", "Yes"),
        ("b", 6, 35.0, "210", "One year", "Mailed check", 1, "Yes", "No", "DSL", "No"),
        ("c", 12, 65.0, "780", "Two year", "Bank transfer (automatic)", 0, "Yes", "Yes", "Fiber optic", "No"),
        ("d", 24, 89.0, None, "Weird", "Credit card (automatic)", 0, "No", "Yes", None, "Yes"),
        ("e", 48, 120.0, "5760", None, None, 0, "Yes", "No", "DSL", "No"),
        ("f", 72, 121.0, "8712", "Month-to-month", "Electronic check", 0, "No", "No", "No", "No"),
        ("g", 73, 50.0, "3650", "One year", "Mailed check", 1, "No", "No", "DSL", "Yes"),
    ]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def test_tenure_and_charge_bins(df):
    out = {r["customerID"]: r for r in df.select(
        "customerID", X.tenure_category(R).alias("t"), X.charges_category(R).alias("c"),
        X.lifecycle_stage(R).alias("l"), X.price_tier(R).alias("p")).collect()}
    assert out["a"]["t"] == "New"            # include_lowest closes 0
    assert out["b"]["t"] == "New" and out["c"]["t"] == "New"   # (0, 12] right-closed
    assert out["d"]["t"] == "Short" and out["f"]["t"] == "Loyal"
    assert out["g"]["t"] is None             # 73 > 72 -> null
    assert out["e"]["c"] == "Premium" and out["f"]["c"] is None   # 121 > 120
    assert out["a"]["l"] is None and out["a"]["p"] is None        # no include_lowest
    assert out["b"]["l"] == "New" and out["g"]["l"] == "Loyal"


def test_risk_scores_and_flags(df):
    out = {r["customerID"]: r for r in X.business_features(df, R).collect()}
    assert out["a"]["contract_risk_score"] == 3
    assert out["d"]["contract_risk_score"] == 2      # unmapped -> default
    assert out["e"]["contract_risk_score"] == 2      # null -> default
    assert out["a"]["ARPU"] == pytest.approx(0.0)    # ' ' -> null -> monthly fallback (0.0)
    assert out["d"]["has_internet"] == 1             # null != 'No' counts as having it
    assert out["a"]["has_internet"] == 0
    assert out["b"]["life_stage"] == "Senior"        # later rule wins
    assert out["c"]["life_stage"] == "Family" and out["e"]["life_stage"] == "Couple"
    assert out["f"]["is_new_customer"] == 0 and out["a"]["is_new_customer"] == 1
    basic = {r["customerID"]: r for r in X.basic_business_features(df, R).collect()}
    assert basic["d"]["contract_risk_score"] is None and basic["a"]["ARPU"] is None


def test_mode_ties_to_smallest_and_exact_median(spark):
    d = spark.createDataFrame([(0.0, "b"), (1.0, "a"), (2.0, "b"), (3.0, "a"), (None, None)],
                              "x double, s string")
    m = I.Imputer("median", "mode").fit(d)
    assert m.fitted["fills"]["x"] == pytest.approx(1.5)      # interpolated, not lower median
    assert m.fitted["fills"]["s"] == "a"                      # tie -> smallest
    m2 = I.Imputer("most_frequent", "unknown").fit(d)
    assert m2.fitted["fills"]["x"] == 0.0 and m2.fitted["fills"]["s"] == "Unknown"


def test_mad_zero_and_constant_column(spark):
    d = spark.createDataFrame([(0, 5.0), (0, 5.0), (0, 5.0), (1, 5.0), (0, 5.0)], "b bigint, k double")
    rep = {r["column"]: r for r in P.outlier_report(d, cols=["b", "k"]).collect()}
    assert rep["b"]["modified_zscore_outliers"] == 1          # MAD = 0: off-median value is an outlier
    assert rep["b"]["iqr_outliers"] == 1
    assert rep["k"]["modified_zscore_outliers"] == 0 and rep["k"]["zscore_outliers"] == 0
    sc = C.Scaler("standard").fit(d.select("k"))
    assert sc.transform(d.select("k")).agg(F.max("k")).first()[0] == 0.0   # constant -> 0


def test_all_null_and_high_cardinality_issues(spark):
    d = spark.createDataFrame([(i, None, f"n{i}") for i in range(60)], "i bigint, z string, name string")
    issues = {(r["issue"], r["column"]) for r in P.issue_list(d).collect()}
    assert ("all_missing", "z") in issues and ("high_cardinality", "name") in issues


def test_one_hot_guard_adds_no_id_columns(spark):
    d = spark.createDataFrame([(i, f"id{i}", "A" if i % 3 else "B") for i in range(500)],
                              "k bigint, cid string, seg string")
    out = E.OneHotEncoder(exclude=["k"], drop_first=True).fit(d).transform(d)
    assert out.columns == ["k", "cid", "seg_B"]   # id-like column untouched, first level dropped


def test_capping_keeps_nulls_and_binary(spark):
    d = spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, 0), (100.0, 0), (None, 0)], "x double, b bigint")
    out = O.OutlierCapper("iqr").fit(d).transform(d).collect()
    assert out[4]["x"] is None and max(r["x"] for r in out if r["x"] is not None) < 100
    assert [r["b"] for r in out] == [0, 1, 0, 0, 0]          # 0/1 column left alone


def test_metrics_no_positives_single_class_and_ties(spark):
    p = spark.createDataFrame([(1, 0, 0, 0.2), (2, 0, 1, 0.7), (3, 0, 0, 0.2)],
                              "id bigint, label int, prediction int, p1 double")
    m = V.classification_metrics(p).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["matthews_corr_coef"] == 0.0
    auc = V.roc_auc(V.score_histogram(p)).first()["roc_auc"]
    assert auc is None                                       # undefined with one class
    t = spark.createDataFrame([(1, 1, 1, 0.5), (2, 0, 1, 0.5), (3, 1, 1, 0.9), (4, 0, 0, 0.1)],
                              "id bigint, label int, prediction int, p1 double")
    assert V.roc_auc(V.score_histogram(t)).first()["roc_auc"] == pytest.approx(0.875)   # tie counts 1/2
    ap = V.average_precision(V.score_histogram(t)).first()["precision_recall_auc"]
    assert ap == pytest.approx(0.5 * 1.0 + 0.5 * (2 / 3))


def test_interpolation_hot_entity_split_across_slices(spark):
    import pandas as pd
    n = 3000
    d = spark.range(n).select(F.lit(1).alias("user"), F.col("id").alias("t"),
                              F.when((F.col("id") % 5 == 0) | (F.col("id") < 3) | (F.col("id") > n - 4), None)
                              .otherwise((F.col("id") * 1.5) % 97).alias("v"))
    out = I.interpolate_numeric(d, "v", "t", ["user"], slices=16).orderBy("t").toPandas()
    ref = d.orderBy("t").toPandas()["v"].interpolate(method="linear", limit_direction="forward")
    got = out["v"]
    assert got.isna().sum() == 3                                   # leading nulls stay null
    pd.testing.assert_series_equal(got.reset_index(drop=True), ref.reset_index(drop=True),
                                   check_names=False, atol=1e-9)


def test_interpolation_with_a_payload_column(spark):
    """Slices depend on values only: a kept column that is neither key nor order changes nothing."""
    n = 60_000
    d = spark.range(n).select(F.lit(1).alias("user"), F.col("id").alias("t"), F.md5(F.col("id").cast("string")).alias("payload"),
                              F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") * 1.5) % 97).alias("v"))
    out = I.interpolate_numeric(d.repartition(13), "v", "t", ["user"], slices=40)
    got = out.orderBy("t").toPandas()
    ref = d.orderBy("t").toPandas()["v"].interpolate(method="linear", limit_direction="forward")
    assert (got["v"].fillna(-1) - ref.fillna(-1)).abs().max() < 1e-9
    assert got["payload"].notna().all()
