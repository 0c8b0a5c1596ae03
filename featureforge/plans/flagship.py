"""Flagship query: customer + orders -> customer_360 -> business features
(CLV, ARPU, tenure category, contract risk) -> churn rate and value per segment.

Plan shape: orders are partially aggregated per customer before the only
large shuffle; customer joins co-partitioned on the customer key; the
segment report is an unpivot + partial aggregate (tiny output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureforge.functions.exprs import is_value, long_format
from featureforge.operators import features as X
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360

SEGMENTS = ["tenure_category", "contract", "contract_risk_score", "payment"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_360(spark, sf_dir)
    f = c.select(
        R.id,
        X.clv_estimate(R).alias("CLV_estimate"),
        X.arpu(R).alias("ARPU"),
        X.tenure_category(R).alias("tenure_category"),
        F.col(R.contract),
        X.map_score(R.contract, R.contract_risk, R.risk_default).cast("string").alias("contract_risk_score"),
        F.col(R.payment),
        is_value(R.target, R.positive).alias("_pos"),
    )
    long = long_format(f, SEGMENTS, "segment", "category", keep=["_pos", "CLV_estimate", "ARPU"])
    return (long.where(F.col("category").isNotNull())
            .groupBy("segment", "category")
            .agg(F.count(F.lit(1)).alias("n_customers"),
                 (F.sum("_pos") * 100.0 / F.count(F.lit(1))).alias("churn_rate"),
                 F.avg("CLV_estimate").alias("avg_clv"),
                 F.avg("ARPU").alias("avg_arpu")))
