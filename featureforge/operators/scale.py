"""Scaling (C1-C6).

One fused aggregate per fit (mean / population sd, min / max, exact or
approximate quartiles, and the 0/1 test of C5); ``transform`` is an
arithmetic projection with literals.  The surveyed numbers differ from the
Spark ML scalers (sample sd, approximate quantiles), so those are not used.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols
from featureforge.ml.base import StatsEstimator, StatsModel

METHODS = ("standard", "minmax", "robust", "quantile")


class ScalerModel(StatsModel):
    def apply(self, df, cfg, st):
        params = st["params"]
        method = st["method"]
        out = []
        for c in df.columns:
            if c not in params:
                out.append(F.col(c))
                continue
            x = F.col(c).cast("double")
            p = params[c]
            if method == "quantile":
                out.append(_quantile_map(x, p["q"]).alias(c))
            else:
                out.append(((x - F.lit(p["center"])) / F.lit(p["scale"])).alias(c))
        return df.select(*out)

    @property
    def scaled_columns(self) -> list[str]:
        return list(self._st()["params"])

    @property
    def binary_columns(self) -> list[str]:
        return self._st()["binary"]


def _quantile_map(x, q: list[float]):
    """C4: piecewise-linear empirical CDF through the fitted quantiles, ties
    averaged from both directions (like sklearn's up/down interpolation).
    Arrow-batched pandas UDF with a binary search (O(log k) per value); the
    k knots travel in the closure (k = n_quantiles, bounded)."""
    knots = np.asarray(q, dtype=float)
    n = len(knots) - 1

    @F.pandas_udf("double")
    def qmap(col: pd.Series) -> pd.Series:
        xv = col.to_numpy(dtype=float, na_value=np.nan)

        def interp(k):
            i = np.clip(k, 1, n)
            lo, hi = knots[i - 1], knots[i]
            with np.errstate(invalid="ignore", divide="ignore"):
                frac = np.where(hi > lo, (xv - lo) / np.where(hi > lo, hi - lo, 1.0), 0.0)
            return ((i - 1) + frac) / n
        v = (interp(np.searchsorted(knots, xv, side="right"))
             + interp(np.searchsorted(knots, xv, side="left"))) / 2
        v = np.where(xv <= knots[0], 0.0, np.where(xv >= knots[-1], 1.0, v))
        return pd.Series(np.where(np.isnan(xv), np.nan, v))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(qmap(x))


class Scaler(StatsEstimator):
    """C1 standard ((x - mean) / population sd; sd 0 -> divisor 1),
    C2 minmax ((x - min) / range; range 0 -> divisor 1), C3 robust
    ((x - median) / IQR; IQR 0 -> divisor 1), C4 quantile (uniform CDF with
    ``n_quantiles`` points); C5: columns whose values are exactly {0, 1} are
    skipped; C6: unknown method -> standard (``fallback='none'``: no-op)."""

    model_class = ScalerModel

    def __init__(self, method: str = "standard", cols: Sequence[str] | None = None,
                 exclude: Sequence[str] = (), skip_binary: bool = True, approx: bool = False,
                 n_quantiles: int = 1000, fallback: str = "standard"):
        super().__init__(method=method, cols=list(cols) if cols is not None else None,
                         exclude=list(exclude), skip_binary=skip_binary, approx=approx,
                         n_quantiles=n_quantiles, fallback=fallback)

    def compute(self, df, cfg):
        method = cfg["method"] if cfg["method"] in METHODS else cfg["fallback"]
        cols = cfg["cols"] if cfg["cols"] is not None else numeric_cols(df, cfg["exclude"])
        if method == "none" or not cols:
            return {"method": method, "params": {}, "binary": []}
        exprs = []
        exact_q = {}
        if method in ("robust", "quantile") and not cfg["approx"]:
            from featureforge.functions.rank import quantiles
            k = cfg["n_quantiles"]
            qs = [0.25, 0.5, 0.75] if method == "robust" else [j / (k - 1) for j in range(k)]
            exact_q = quantiles(df, {c: F.col(c) for c in cols}, qs)
        for i, c in enumerate(cols):
            x = F.col(c).cast("double")
            if cfg["skip_binary"]:   # exactly {0, 1} without a count_distinct Expand
                exprs += [F.count_if(~x.isin(0.0, 1.0)).alias(f"d{i}"), F.min(x).alias(f"lo{i}"),
                          F.max(x).alias(f"hi{i}")]
            if method == "standard":
                exprs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
            elif method == "minmax":
                exprs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
            elif method == "robust":
                if cfg["approx"]:
                    qs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
                    exprs.append(F.percentile_approx(x, qs, 10000).alias(f"q{i}"))
            elif cfg["approx"]:
                k = cfg["n_quantiles"]
                qs = F.array(*[F.lit(j / (k - 1)) for j in range(k)])
                exprs.append(F.percentile_approx(x, qs, 10000).alias(f"q{i}"))
        row = df.agg(*exprs).collect()[0] if exprs else {}
        params, binary = {}, []
        for i, c in enumerate(cols):
            if cfg["skip_binary"] and row[f"d{i}"] == 0 and row[f"lo{i}"] == 0 and row[f"hi{i}"] == 1:
                binary.append(c)
                continue
            if method == "standard":
                m, s = row[f"m{i}"], row[f"s{i}"]
                if m is None:
                    continue
                params[c] = {"center": m, "scale": s if s else 1.0}
            elif method == "minmax":
                mn, mx = row[f"mn{i}"], row[f"mx{i}"]
                if mn is None:
                    continue
                params[c] = {"center": mn, "scale": (mx - mn) if mx != mn else 1.0}
            elif method == "robust":
                q = exact_q.get(c) if exact_q else row[f"q{i}"]
                if q is None:
                    continue
                iqr = q[2] - q[0]
                params[c] = {"center": q[1], "scale": iqr if iqr else 1.0}
            else:
                q = exact_q.get(c) if exact_q else row[f"q{i}"]
                if q is None:
                    continue
                params[c] = {"q": [float(v) for v in q]}
        return {"method": method, "params": params, "binary": binary}


def scale(df: DataFrame, method: str = "standard", exclude: Sequence[str] = (), **kw) -> DataFrame:
    return Scaler(method=method, exclude=exclude, **kw).fit(df).transform(df)
