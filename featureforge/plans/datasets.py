"""Derived datasets shared by the catalogued queries and the bench.

``churn_features``: customer_360 -> business features -> the numeric
feature columns plus a 0/1 ``label`` (one projection over the customer_360
plan; the two global statistics it needs are one broadcast one-row agg).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureforge.functions.exprs import is_value, numeric_cols
from featureforge.operators import features as X
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360

FEATURES = ["senior", "tenure", "monthly_charges", "total_charges", "CLV_estimate", "CLV_per_month",
            "ARPU", "total_services", "premium_services", "service_adoption_rate",
            "contract_risk_score", "payment_risk_score", "is_new_customer", "is_loyal_customer",
            "above_avg_charges", "has_internet", "fiber_optic_user", "phone_service_complexity",
            "family_score", "customer_value_score"]


def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    import os
    from featureforge.sources.tables import shared
    return shared(spark, ("churn_features", os.path.abspath(sf_dir)), lambda: _churn_features(spark, sf_dir))


def _churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_360(spark, sf_dir)
    biz = X.business_features(c, R)
    cols = numeric_cols(biz, exclude=[R.id])
    assert cols == FEATURES, cols
    return biz.select(R.id, *[F.col(x).cast("double").alias(x) for x in cols],
                      is_value(R.target, R.positive).alias("label"))
