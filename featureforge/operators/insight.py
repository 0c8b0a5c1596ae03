"""Segment and revenue insight (N1-N7): group-by aggregations over the target.

All per-category rates are computed in long format: the selected categorical
columns are unpivoted into (feature, category) pairs and aggregated once,
with map-side partial aggregation, so a hot category costs nothing extra.
Cardinality guards are applied to the aggregated rows (one row per distinct
value), joined with a per-feature count whose size is bounded by the number
of columns.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import (is_value, long_format, numeric_cols,
                                          string_cols)
from featureforge.functions.stats import safe_corr
from featureforge.roles import Roles


def _target_flag(df: DataFrame, roles: Roles):
    return is_value(roles.target, roles.positive)


def rate_by_category(df: DataFrame, roles: Roles, cols: Sequence[str],
                     max_card: int | None = None) -> DataFrame:
    """% positive per (feature, category); nulls are not a category."""
    if not cols:
        schema = "feature string, category string, n_rows bigint, churn_rate double"
        return df.sparkSession.createDataFrame([], schema)
    base = df.select(*[F.col(c).cast("string").alias(c) for c in cols],
                     _target_flag(df, roles).alias("_pos"))
    long = long_format(base, cols, "feature", "category", keep=["_pos"])
    g = (long.where(F.col("category").isNotNull())
         .groupBy("feature", "category")
         .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("_pos").alias("_npos")))
    if max_card is not None:
        card = g.groupBy("feature").agg(F.count(F.lit(1)).alias("_card"))
        g = (g.join(F.broadcast(card), "feature")   # one row per column: bounded
             .where(F.col("_card") <= max_card).drop("_card"))
    return g.select("feature", "category", "n_rows",
                    (F.col("_npos") * 100.0 / F.col("n_rows")).alias("churn_rate"))


def churn_by_segment(df: DataFrame, roles: Roles, max_cols: int = 5,
                     max_card: int = 10) -> DataFrame:
    """The first ``max_cols`` categorical columns (target excluded), only
    those with at most ``max_card`` distinct values."""
    cats = string_cols(df, exclude=[roles.target])[:max_cols]
    return rate_by_category(df, roles, cats, max_card)


def churn_rate_by_category(df: DataFrame, roles: Roles, max_card: int = 8) -> DataFrame:
    """Every categorical column with at most ``max_card`` distinct values."""
    cats = string_cols(df, exclude=[roles.target])
    return rate_by_category(df, roles, cats, max_card)


def avg_charge_by_target(df: DataFrame, roles: Roles) -> DataFrame:
    """Mean monthly charge per target class (null class dropped)."""
    return (df.where(F.col(roles.target).isNotNull())
            .groupBy(F.col(roles.target).cast("string").alias("target"))
            .agg(F.avg(roles.monthly).alias("avg_monthly")))


def revenue_at_risk(df: DataFrame, roles: Roles) -> DataFrame:
    """Total monthly charge of positive rows; 0 when there are none."""
    pos = F.col(roles.target) == F.lit(roles.positive)
    return df.agg(F.coalesce(F.sum(F.when(pos, F.col(roles.monthly))),
                             F.lit(0.0)).cast("double").alias("revenue_at_risk"),
                  F.count_if(pos).alias("n_positive"))


def churn_by_equal_width_bins(df: DataFrame, roles: Roles, column: str | None = None,
                              bins: int = 5) -> DataFrame:
    """Pandas.cut(x, bins) = equal-width right-closed bins over [min, max]
    with the first edge lowered by 0.1 % of the range; % positive per bin,
    empty bins reported with rate 0.  The edges come from a one-row min/max
    aggregate (broadcast), the bin list from ``sequence`` on that row."""
    column = column or roles.tenure
    x = F.col(column).cast("double")
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    step = (F.col("_mx") - F.col("_mn")) / bins

    def edge(i):
        if i == bins:
            return F.col("_mx")
        e = F.lit(float(i)) * step + F.col("_mn")
        if i == 0:
            e = F.col("_mn") - (F.col("_mx") - F.col("_mn")) * 0.001
        return e

    xv = F.col("_x")
    ladder = None
    for i in range(1, bins + 1):
        cond = xv <= edge(i)
        ladder = F.when(cond, F.lit(i)) if ladder is None else ladder.when(cond, F.lit(i))
    counted = (df.select(x.alias("_x"), _target_flag(df, roles).alias("_pos"))
               .where(F.col("_x").isNotNull())
               .crossJoin(F.broadcast(mm))
               .select(ladder.alias("bin"), "_pos")
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.sum("_pos").alias("_npos")))
    all_bins = mm.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"),
                         *[edge(i).alias(f"_e{i}") for i in range(bins + 1)])
    lower = F.element_at(F.array(*[F.col(f"_e{i}") for i in range(bins)]), F.col("bin"))
    upper = F.element_at(F.array(*[F.col(f"_e{i}") for i in range(1, bins + 1)]), F.col("bin"))
    out = all_bins.join(counted, "bin", "left")
    return out.select(
        F.col("bin").cast("int").alias("bin"), lower.alias("lower"), upper.alias("upper"),
        F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.col("_npos") * 100.0 / F.col("n_rows"), F.lit(0.0)).alias("churn_rate"))


def churn_rate_by_feature(df: DataFrame, roles: Roles, feature: str) -> DataFrame:
    """% positive per value of a discrete (engineered) feature."""
    return (df.where(F.col(feature).isNotNull())
            .groupBy(F.col(feature).alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 (F.avg(_target_flag(df, roles)) * 100.0).alias("churn_rate")))


def feature_target_correlation(df: DataFrame, roles: Roles,
                               features: Sequence[str] | None = None,
                               top: int = 15) -> DataFrame:
    """abs(Pearson r) of each numeric feature with the 0/1 target, nulls
    dropped pairwise, descending, top ``top`` (ties by name)."""
    features = list(features) if features is not None else numeric_cols(
        df, exclude=[roles.id, roles.target])
    label = _target_flag(df, roles).cast("double")
    row = df.agg(*[safe_corr(F.col(c), label).alias(c) for c in features])
    long = long_format(row, features, "feature", "r")
    return (long.where(F.col("r").isNotNull() & ~F.isnan("r"))
            .select("feature", F.abs("r").alias("abs_corr"))
            .orderBy(F.desc("abs_corr"), F.asc("feature")).limit(top))
