"""Outliers (O1-O4): capping / filtering with bounds frozen at fit time.

Bounds come from one fused aggregate (exact ``percentile`` quartiles, or
``percentile_approx`` when ``approx``); capping is ``least/greatest`` with a
null guard (Spark's greatest/least skip nulls, pandas' clip keeps them).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols
from featureforge.ml.base import StatsEstimator, StatsModel


def clip(c: str, lo, hi):
    x = F.col(c)
    return F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def _binary_cols(df: DataFrame, cols: Sequence[str]) -> set:
    if not cols:
        return set()
    exprs = []
    for i, c in enumerate(cols):      # exactly {0, 1}: min 0, max 1, nothing else (no count_distinct Expand)
        exprs += [F.count_if(~F.col(c).isin(0, 1)).alias(f"d{i}"), F.min(c).alias(f"a{i}"),
                  F.max(c).alias(f"b{i}")]
    row = df.agg(*exprs).collect()[0]
    return {c for i, c in enumerate(cols)
            if row[f"d{i}"] == 0 and row[f"a{i}"] == 0 and row[f"b{i}"] == 1}


class CapperModel(StatsModel):
    def apply(self, df, cfg, st):
        bounds = st["bounds"]
        return df.select(*[(clip(c, *bounds[c]).alias(c) if c in bounds else F.col(c))
                           for c in df.columns])

    def audit(self) -> list[dict]:
        return self._st()["audit"]


class OutlierCapper(StatsEstimator):
    """O1 (method='iqr': clip to [Q1 - k IQR, Q3 + k IQR]) and O2
    (method='zscore': detect |x - mean| / pop-sd > t, clip to mean +- t *
    sample-sd).  The target and id are excluded; ``skip_binary`` leaves 0/1
    columns alone (off = the surveyed pipeline, which flattens them)."""

    model_class = CapperModel

    def __init__(self, method: str = "iqr", k: float = 1.5, threshold: float = 3.0,
                 cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                 skip_binary: bool = True, approx: bool = False):
        super().__init__(method=method, k=k, threshold=threshold,
                         cols=list(cols) if cols is not None else None,
                         exclude=list(exclude), skip_binary=skip_binary, approx=approx)

    def compute(self, df, cfg):
        cols = cfg["cols"] if cfg["cols"] is not None else numeric_cols(df, cfg["exclude"])
        if cfg["skip_binary"]:
            binary = _binary_cols(df, cols)
            cols = [c for c in cols if c not in binary]
        if not cols:
            return {"bounds": {}, "audit": []}
        exprs = []
        exact_q = {}
        if cfg["method"] == "iqr" and not cfg["approx"]:
            from featureforge.functions.rank import quantiles
            exact_q = quantiles(df, {c: F.col(c) for c in cols}, [0.25, 0.75])
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            if cfg["method"] == "iqr":
                if cfg["approx"]:
                    qs = F.array(F.lit(0.25), F.lit(0.75))
                    exprs.append(F.percentile_approx(x, qs, 10000).alias(f"q{i}"))
            else:
                exprs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"sp{i}"),
                          F.stddev_samp(x).alias(f"ss{i}")]
            exprs.append(F.count(F.lit(1)).alias(f"n{i}"))
        row = df.agg(*exprs).collect()[0]
        bounds, counts = {}, []
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            if cfg["method"] == "iqr":
                q = exact_q.get(c) if exact_q else row[f"q{i}"]
                if q is None:
                    continue
                iqr = q[1] - q[0]
                lo, hi = q[0] - cfg["k"] * iqr, q[1] + cfg["k"] * iqr
                counts.append(F.count_if((x < lo) | (x > hi)).alias(f"o{i}"))
            else:
                m, sp, ss = row[f"m{i}"], row[f"sp{i}"], row[f"ss{i}"]
                if m is None or ss is None:
                    continue
                lo, hi = m - cfg["threshold"] * ss, m + cfg["threshold"] * ss
                counts.append(F.count_if(F.abs(x - m) / F.lit(sp) > cfg["threshold"]).alias(f"o{i}")
                              if sp else F.lit(0).alias(f"o{i}"))
            bounds[c] = [lo, hi]
        crow = df.agg(*counts).collect()[0] if counts else {}
        audit = []
        for i, c in enumerate(cols):
            if c not in bounds:
                continue
            n = row[f"n{i}"]
            o = crow[f"o{i}"]
            audit.append({"column": c, "method": "IQR" if cfg["method"] == "iqr" else "Z-Score",
                          "outliers_detected": int(o), "outlier_pct": (o * 100.0 / n) if n else None,
                          "lower": bounds[c][0], "upper": bounds[c][1], "action": "capped"})
        return {"bounds": bounds, "audit": audit}


def cap_outliers(df: DataFrame, method: str = "iqr", exclude: Sequence[str] = (), **kw) -> DataFrame:
    return OutlierCapper(method=method, exclude=exclude, **kw).fit(df).transform(df)


def outlier_audit(model: CapperModel, spark) -> DataFrame:
    """Per column method, count, %, bounds, action."""
    rows = [(a["column"], a["method"], a["outliers_detected"], a["outlier_pct"], a["lower"],
             a["upper"], a["action"]) for a in model.audit()]
    return spark.createDataFrame(rows, "column string, method string, outliers_detected bigint, "
                                       "outlier_pct double, lower double, upper double, action string")


def filter_zscore(df: DataFrame, cols: Sequence[str], threshold: float = 3.0,
                  simultaneous: bool = False) -> DataFrame:
    """O3: drop rows with |z| >= threshold (population sd), column after
    column on the survivors (``simultaneous`` = one pass on the input).  Each
    step collects its one-row mean/sd (literals), so the plan grows linearly;
    a null z (null value, constant column) drops the row, like pandas."""
    def keep(c, m, s):
        z = F.try_divide(F.abs(F.col(c).cast("double") - F.lit(m)), F.lit(s))
        return F.coalesce(z < threshold, F.lit(False))

    def stats(frame, cs):
        exprs = [e for i, c in enumerate(cs) for e in (
            F.avg(F.col(c).cast("double")).alias(f"m{i}"),
            F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]
        return frame.agg(*exprs).collect()[0]

    if simultaneous:
        row = stats(df, cols)
        cond = F.lit(True)
        for i, c in enumerate(cols):
            cond = cond & keep(c, row[f"m{i}"], row[f"s{i}"])
        return df.where(cond)
    out = df
    for c in cols:
        row = stats(out, [c])
        out = out.where(keep(c, row["m0"], row["s0"]))
    return out
