"""Ordered target statistics (M5): a category becomes the smoothed target mean
of the rows that stand before its row in a hash order, so that no row sees its
own label.

The running sums of a category are put together from sums per range of the
order (its first hex digits) and windows inside those ranges, so a category
that holds a third of all rows is spread over ``16 ** DIGITS`` window
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4
#: Categories of a column whose statistics a fitted model keeps.
MAX_KEPT = 100_000
NO_CATEGORY = "(missing)"


def order_key(id_col: str, seed: int):
    """Position of a row in the order: an MD5 of its id and the seed."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))


def category(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(NO_CATEGORY))


def ordered_target_stats(df: DataFrame, cols: list[str], label_col: str = "label", id_col: str = "id", seed: int = 42,
                         prior_weight: float = 1.0, suffix: str = "_ots") -> DataFrame:
    """``df`` with ``<col><suffix>`` for each column:
    (labels before + weight * mean) / (rows before + weight) over the rows of
    the same category that come earlier.  A null category is one of its own; rows
    without a label count nowhere and get the mean's share only of labelled ones."""
    mean = df.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
    y = F.coalesce(F.col(label_col).cast("double"), F.lit(0.0))
    seen = F.when(F.col(label_col).isNotNull(), 1).otherwise(0)
    out = df.withColumns({"_key": order_key(id_col, seed)}).withColumn("_range", F.substring("_key", 1, DIGITS))
    for c in cols:
        rows = out.withColumns({"_cat": category(c), "_one": y, "_seen": seen})
        sums = rows.groupBy("_cat", "_range").agg(F.sum("_one").alias("_s"), F.sum("_seen").alias("_n"))
        upward = Window.partitionBy("_cat").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.select("_cat", "_range", F.coalesce(F.sum("_s").over(upward), F.lit(0.0)).alias("_s0"),
                             F.coalesce(F.sum("_n").over(upward), F.lit(0)).alias("_n0"))
        inside = Window.partitionBy("_cat", "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumns({"_s1": F.coalesce(F.sum("_one").over(inside), F.lit(0.0)),
                                 "_n1": F.coalesce(F.sum("_seen").over(inside), F.lit(0))})
        rows = rows.join(before, ["_cat", "_range"])
        value = (F.col("_s0") + F.col("_s1") + prior_weight * mean) / (F.col("_n0") + F.col("_n1") + prior_weight)
        out = rows.withColumn(c + suffix, value).drop("_cat", "_one", "_seen", "_s0", "_n0", "_s1", "_n1")
    return out.drop("_key", "_range")


def full_target_stats(df: DataFrame, cols: list[str], label_col: str = "label", prior_weight: float = 1.0) -> dict:
    """{column: {category: value}} from all rows, and the value of unseen categories under ``None``.
    More than ``MAX_KEPT`` categories raise: such a column needs grouping first."""
    mean = float(df.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0)
    out = {}
    for c in cols:
        sums = df.where(F.col(label_col).isNotNull()).groupBy(category(c).alias("cat")).agg(
            F.sum(F.col(label_col).cast("double")).alias("s"), F.count(F.lit(1)).alias("n"))
        found = sums.limit(MAX_KEPT + 1).collect()
        if len(found) > MAX_KEPT:
            raise ValueError(f"{c} has more than {MAX_KEPT} categories; group them or leave the column out")
        out[c] = {r["cat"]: (r["s"] + prior_weight * mean) / (r["n"] + prior_weight) for r in found}
        out[c][""] = mean
    return out
