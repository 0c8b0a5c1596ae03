"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import math
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric_type(dt) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in ex]


def string_cols(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int; a null comparison counts as 0 (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def is_value(c, value) -> Column:
    return flag(col(c) == F.lit(value))


def safe_div(a, b) -> Column:
    """a / b with NULL for a zero or null divisor (ANSI-safe)."""
    return F.try_divide(col(a), col(b))


def as_double(c) -> Column:
    """Parse text to double: blanks and garbage become NULL (never NaN)."""
    parsed = F.trim(col(c).cast("string")).try_cast("double")
    return F.nanvl(parsed, F.lit(None).cast("double"))


def cut(c, edges: Sequence[float], labels: Sequence[str] | None = None,
        include_lowest: bool = False) -> Column:
    """pandas.cut semantics: right-closed bins (a, b]; values outside -> NULL;
    ``include_lowest`` closes the first bin on the left.  Infinite edges are
    allowed.  Returns the label (or the bin index 0..n-1 when no labels)."""
    e = col(c)
    n = len(edges) - 1
    labels = list(labels) if labels is not None else list(range(n))
    expr = None
    for i in range(n):
        a, b = edges[i], edges[i + 1]
        if i == 0 and include_lowest:
            cond = e >= F.lit(a) if not math.isinf(a) else F.lit(True)
        else:
            cond = e > F.lit(a) if not math.isinf(a) else F.lit(True)
        if not math.isinf(b):
            cond = cond & (e <= F.lit(b))
        expr = (F.when(cond, F.lit(labels[i])) if expr is None
                else expr.when(cond, F.lit(labels[i])))
    return expr


def sum_cols(exprs: Sequence[Column]) -> Column:
    if not exprs:
        return F.lit(0)
    out = exprs[0]
    for e in exprs[1:]:
        out = out + e
    return out


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every double column (presentation step for engine-independent output)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = overrides.get(f.name, digits)
            out.append(F.round(F.col(f.name).cast("double"), d).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def long_format(df: DataFrame, cols: Sequence[str], key: str = "feature",
                value: str = "value", keep: Sequence[str] = (), cast: str | None = None) -> DataFrame:
    """Wide -> long (G6): one row per (row, column) via ``unpivot``; skew-safe
    because every downstream aggregate is partial (map-side) first."""
    vals = [F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols]
    wide = df.select(*[F.col(k) for k in keep], *vals)
    return wide.unpivot(list(keep), list(cols), key, value)


def sig_round(c, digits: int = 6) -> Column:
    """Round to ``digits`` significant digits (engine-independent presentation
    of large-magnitude statistics such as variances and chi-square sums)."""
    x = col(c).cast("double")
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / e, digits - 1) * e)
