"""Feature-engineering reports as tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols, string_cols


def feature_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Column counts before/after, numeric / categorical counts and the
    number of numeric columns with exactly two distinct values."""
    num = numeric_cols(after)
    cats = string_cols(after)
    # "exactly two distinct values" without a count_distinct Expand: min != max
    # and no value other than the two (one min/max aggregate, one count)
    mm = after.agg(*[e for i, c in enumerate(num) for e in (F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}"))]) \
        .first() if num else None
    two = [i for i, _ in enumerate(num) if mm[f"a{i}"] is not None and mm[f"a{i}"] != mm[f"b{i}"]]
    checks = [F.count_if(~F.col(num[i]).isin(mm[f"a{i}"], mm[f"b{i}"])).alias(f"d{i}") for i in two]
    agg = after.agg(*checks) if checks else after.agg(F.count(F.lit(1)).alias("_n"))
    binary = F.lit(0)
    for i in two:
        binary = binary + (F.col(f"d{i}") == 0).cast("int")
    return agg.select(
        F.lit(len(before.columns)).alias("original_features"),
        F.lit(len(after.columns)).alias("final_features"),
        F.lit(len(after.columns) - len(before.columns)).alias("features_added"),
        F.lit(len(num)).alias("numeric_features"),
        F.lit(len(cats)).alias("categorical_features"),
        binary.alias("binary_features"))


def importance_preview(df: DataFrame, first: int = 20, top: int = 10) -> DataFrame:
    """R2: sample variance x range over the first ``first`` numeric columns,
    the ``top`` largest."""
    cols = numeric_cols(df)[:first]
    agg = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.var_samp(F.col(c).cast("double")).alias(f"v{i}"),
        (F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double"))).alias(f"r{i}"))])
    rows = agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(f"v{i}") * F.col(f"r{i}")).alias("importance"))
        for i, c in enumerate(cols)])))
    return (rows.where(F.col("importance").isNotNull())
            .orderBy(F.desc("importance"), F.asc("feature")).limit(top))


def feature_variance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample variance of each created feature."""
    agg = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    return agg.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"))
                                         for i, c in enumerate(cols)])))


def before_after_quality(before: DataFrame, after: DataFrame) -> DataFrame:
    """Missing cells and numeric column count before and after, with a
    status per stage."""
    def one(df, stage):
        miss = F.lit(0)
        for c in df.columns:
            miss = miss + F.count_if(F.col(c).isNull())
        return df.agg(miss.cast("bigint").alias("missing_cells")).select(
            F.lit(stage).alias("stage"), "missing_cells",
            F.lit(len(numeric_cols(df))).alias("numeric_columns"),
            F.when(F.col("missing_cells") == 0, "clean").otherwise("has_missing").alias("status"))
    return one(before, "before").unionByName(one(after, "after"))
