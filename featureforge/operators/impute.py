"""Missing values.

Simple imputers fit ONE aggregate (null counts + the fill statistic for each
column) and transform with ``coalesce(col, literal)``.  Only columns that
actually contain nulls are imputed (like the surveyed pipeline).  Median is
the exact interpolated median (``percentile``), not ``ml.Imputer``'s lower
median; the mode is the most frequent value with ties to the smallest.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols, string_cols
from featureforge.functions.rank import below_pivots, pivots
from featureforge.ml.base import StatsEstimator, StatsModel

UNKNOWN = "Unknown"


def _null_bearing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    if not cols:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)]).collect()[0]
    return [c for i, c in enumerate(cols) if row[f"_m{i}"] > 0]


class ImputerModel(StatsModel):
    def apply(self, df, cfg, st):
        fills = st.get("fills", {})
        out = []
        for f in df.schema.fields:
            c = f.name
            if c in fills:
                v = fills[c]
                if st.get("kind", {}).get(c) == "numeric":
                    out.append(F.coalesce(F.col(c).cast("double"),
                                          F.lit(v).cast("double")).alias(c))
                else:
                    out.append(F.coalesce(F.col(c), F.lit(v)).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


class Imputer(StatsEstimator):
    """Numeric strategy mean | median | most_frequent; categorical
    strategy mode | unknown.  Columns without nulls are left untouched."""

    model_class = ImputerModel

    def __init__(self, numeric: str = "median", categorical: str = "mode",
                 exclude: Sequence[str] = (), only_null_bearing: bool = True, approx: bool = False):
        super().__init__(numeric=numeric, categorical=categorical, exclude=list(exclude),
                         only_null_bearing=only_null_bearing, approx=approx)

    def compute(self, df, cfg):
        num = numeric_cols(df, cfg["exclude"])
        cat = string_cols(df, cfg["exclude"])
        cols = num + cat
        if cfg["only_null_bearing"]:
            cols = _null_bearing(df, cols)
        num = [c for c in num if c in cols]
        cat = [c for c in cat if c in cols]
        exprs = []
        medians, num_modes = {}, {}
        if cfg["numeric"] in ("most_frequent", "mode") and num:
            from featureforge.functions.stats import modes
            num_modes = modes(df, num, numeric=True)
        cat_modes = {}
        if cfg["categorical"] == "mode" and cat:
            from featureforge.functions.stats import modes
            cat_modes = modes(df, cat, numeric=False)
        if cfg["numeric"] == "median" and num and not cfg["approx"]:
            from featureforge.functions.rank import quantiles
            medians = quantiles(df, {c: F.col(c) for c in num}, [0.5])
        for i, c in enumerate(num):
            x = F.col(c).cast("double")
            s = cfg["numeric"]
            if s == "mean":
                e = F.avg(x)
            elif s == "median":
                if not cfg["approx"]:
                    continue
                e = F.percentile_approx(x, 0.5, 10000)
            elif s in ("most_frequent", "mode"):
                continue
            else:
                raise ValueError(f"unknown numeric strategy {s}")
            exprs.append(e.alias(f"n{i}"))
        row = df.agg(*exprs).collect()[0] if exprs else {}
        fills, kind = {}, {}
        for i, c in enumerate(num):
            if c in medians:
                fills[c], kind[c] = (medians[c][0] if medians[c] else None), "numeric"
            elif cfg["numeric"] in ("most_frequent", "mode"):
                fills[c], kind[c] = num_modes.get(c), "numeric"
            else:
                fills[c], kind[c] = row[f"n{i}"], "numeric"
        for i, c in enumerate(cat):
            fills[c] = cat_modes.get(c) if cfg["categorical"] == "mode" else UNKNOWN
            kind[c] = "categorical"
        return {"fills": {k: v for k, v in fills.items() if v is not None}, "kind": kind}


def impute(df: DataFrame, numeric: str = "median", categorical: str = "mode",
           exclude: Sequence[str] = ()) -> DataFrame:
    return Imputer(numeric, categorical, exclude).fit(df).transform(df)


def fallback_fill(df: DataFrame, column: str, other: str) -> DataFrame:
    """Null -> the other column of the same row."""
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other)))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """I8: drop rows with a null in ``subset`` (all columns by default)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


SLICE_ROWS = 200_000
MAX_SLICES = 1024


def interpolate_numeric(df: DataFrame, column: str, order_by: str | Sequence[str],
                        partition_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Linear interpolation between the neighbouring non-null values in
    ``order_by`` order within each entity (equally spaced positions, like
    pandas' ``linear``); leading nulls stay null, trailing nulls take the
    last value.

    Hot entities are split: literal cut points in the first order column (keys
    of random rows, about one per ``SLICE_ROWS`` rows) give every row a slice by
    its value alone, so every evaluation of the plan agrees; each slice computes
    local positions and running neighbours with windows over (entity, slice); a
    per-(entity, slice) summary (count, first / last non-null value and
    position) gives each slice its global offset and the neighbours carried
    over from earlier / later slices.  No task ever holds a whole entity."""
    keys = list(partition_by)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    n_slices = slices or min(df.count() // SLICE_ROWS + 8, MAX_SLICES)
    x = F.col(column)
    first = F.col(order[0])
    key = F.when(~F.isnan(first), first) if dict(df.dtypes)[order[0]] in ("double", "float") else first
    points = pivots(df.select(key.alias("_o")), "_o", n_slices - 1)
    # a NaN sorts after every number, a null before
    at = F.when(first.isNotNull() & key.isNull(), F.lit(len(points))).otherwise(below_pivots(key, points))
    sl = df.withColumn("_sl", at)
    grp = [*keys, "_sl"]
    w_pos = Window.partitionBy(*grp).orderBy(*[F.col(o).asc() for o in order])
    staged = sl.withColumn("_lp", F.row_number().over(w_pos))
    run_f = Window.partitionBy(*grp).orderBy(F.col("_lp").asc()).rowsBetween(Window.unboundedPreceding, 0)
    run_b = Window.partitionBy(*grp).orderBy(F.col("_lp").desc()).rowsBetween(Window.unboundedPreceding, 0)
    present_pos = F.when(x.isNotNull(), F.col("_lp"))
    staged = (staged
              .withColumn("_pv", F.last(x, True).over(run_f))
              .withColumn("_pp", F.last(present_pos, True).over(run_f))
              .withColumn("_nv", F.last(x, True).over(run_b))
              .withColumn("_np", F.last(present_pos, True).over(run_b)))
    # one row per (entity, slice): bounded by #entities x #slices
    summ = staged.groupBy(*grp).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.min_by(x, F.when(x.isNotNull(), F.col("_lp"))).alias("_fv"),
        F.min(present_pos).alias("_fp"),
        F.max_by(x, F.when(x.isNotNull(), F.col("_lp"))).alias("_lv"),
        F.max(present_pos).alias("_lpp"))
    w_before = Window.partitionBy(*keys).orderBy("_sl").rowsBetween(Window.unboundedPreceding, -1)
    w_after = Window.partitionBy(*keys).orderBy("_sl").rowsBetween(1, Window.unboundedFollowing)
    summ = (summ.withColumn("_off", F.coalesce(F.sum("_cnt").over(w_before), F.lit(0)))
                .withColumn("_g_lp", F.col("_off") + F.col("_lpp"))
                .withColumn("_g_fp", F.col("_off") + F.col("_fp"))
                .withColumn("_cv", F.last("_lv", True).over(w_before))
                .withColumn("_cp", F.last("_g_lp", True).over(w_before))
                .withColumn("_dv", F.first("_fv", True).over(w_after))
                .withColumn("_dp", F.first("_g_fp", True).over(w_after))
                .select(*grp, "_off", "_cv", "_cp", "_dv", "_dp"))
    # entities may be null
    for i, g in enumerate(grp):
        summ = summ.withColumnRenamed(g, f"_g{i}")
    j = staged.join(summ, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(grp)])
    pos = F.col("_off") + F.col("_lp")
    pv = F.coalesce(F.col("_pv"), F.col("_cv"))
    pp = F.coalesce(F.col("_off") + F.col("_pp"), F.col("_cp"))
    nv = F.coalesce(F.col("_nv"), F.col("_dv"))
    np_ = F.coalesce(F.col("_off") + F.col("_np"), F.col("_dp"))
    filled = (F.when(x.isNotNull(), x.cast("double"))
              .when(pv.isNull(), F.lit(None).cast("double"))
              .when(nv.isNull(), pv.cast("double"))
              .otherwise(pv + (nv - pv) * (pos - pp) / (np_ - pp)))
    return j.withColumn(column, filled).select(*df.columns)
