"""Registry of catalogued queries: name -> (Spark callable, DuckDB oracle SQL).

Each callable takes (spark, sf_dir) and returns a lazy DataFrame computed
from the given tables (or tables Spark derives from them).  The oracle, when
present, is an independent ANSI-SQL formulation run by DuckDB on the same
parquet files.  Outputs round doubles (``ROUND_DIGITS``) on both sides so the
comparison is engine-independent.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from featureforge.functions.exprs import round_doubles

ROUND_DIGITS = 6


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, digits: int | dict | None = ROUND_DIGITS,
             note: str = ""):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            if digits is None:
                return df
            if isinstance(digits, dict):
                return _merge_rounded(df, digits)
            return round_doubles(df, digits)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, wrapped, sql, note)
        return wrapped
    return deco


def _merge_rounded(df: DataFrame, digits: dict) -> DataFrame:
    """Round double columns per ``digits`` (``None`` = leave as is)."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    out = []
    for f in df.schema.fields:
        d = digits.get(f.name, digits.get("*", ROUND_DIGITS))
        if d is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), d).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
