"""Fused column statistics (G1) and one-row statistics tables.

Every fit-dependent stage asks for the statistics it needs and gets them from
ONE aggregate over the data (partial aggregation map-side, a single tiny
merge), never one job per column.  The result is either collected (a single
row, bounded by the number of requested columns) or kept lazy as a one-row
DataFrame that is attached with ``crossJoin(broadcast(...))``: its size is one
row by construction, so the broadcast is always safe.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# stat name -> builder(column) ; percentiles handled separately
_BUILDERS = {
    "count": lambda c: F.count(c),
    "nulls": lambda c: F.count_if(c.isNull()),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "sum": F.sum,
    "var_pop": F.var_pop,
    "var_samp": F.var_samp,
    "std_pop": F.stddev_pop,
    "std_samp": F.stddev_samp,
    "approx_distinct": lambda c: F.approx_count_distinct(c),
}


def key(colname: str, stat: str) -> str:
    return f"{colname}__{stat}"


def stat_exprs(cols: Sequence[str], stats: Iterable[str]) -> list[Column]:
    """Named statistics for every column (quantiles: see ``rank.quantiles``,
    which stays exact without a per-value map)."""
    stats = list(stats)
    return [_BUILDERS[s](F.col(c)).alias(key(c, s)) for c in cols for s in stats]


def stats_row(df: DataFrame, cols: Sequence[str], stats: Iterable[str] = (),
              extra: Sequence[Column] = ()) -> DataFrame:
    """Lazy one-row DataFrame of the requested statistics."""
    return df.agg(*(stat_exprs(cols, stats) + list(extra)))


def collect_stats(df: DataFrame, cols: Sequence[str], stats: Iterable[str] = (),
                  extra: Sequence[Column] = ()) -> dict:
    """Run the fused aggregate and return {"col__stat": value}."""
    if not cols and not extra:
        return {}
    return stats_row(df, cols, stats, extra).collect()[0].asDict()


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row statistics table to every row (broadcast, no shuffle)."""
    return df.crossJoin(F.broadcast(one_row))


def safe_corr(a, b) -> Column:
    """Pearson r over rows where both sides are present, NULL when either side
    is constant: covar_pop / (sd_pop(a) * sd_pop(b)) with ``try_divide``
    (Spark's ``corr`` raises on a zero variance under ANSI mode)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a.cast("double"))
    bb = F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def modes(df: DataFrame, cols, numeric: bool) -> dict:
    """Most frequent non-null value per column, ties to the smallest value,
    as two distributed aggregates: (column, value) counts with map-side
    partial aggregation, then ``min_by(value, (-count, value))`` per column.
    No task holds a per-value map of a whole column (unlike ``mode``)."""
    cols = list(cols)
    if not cols:
        return {}
    cast = "double" if numeric else "string"
    wide = df.select(*[F.col(c).cast(cast).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}
