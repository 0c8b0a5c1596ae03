"""Catalogued queries: exact nearest neighbours (M8, I4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.functions.exprs import is_value
from featureforge.ml import knn
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, with_c360

_COLS = ("tenure", "monthly", "total")
#: The columns on one scale, in both engines by the same divisions.
_SCALED = {"tenure": ("tenure", 10.0), "monthly": ("monthly_charges", 10000.0), "total": ("total_charges", 500000.0)}
_SCALED_SQL = ", ".join(f"CAST({c} AS DOUBLE) / {d}e0 AS {n}" for n, (c, d) in _SCALED.items())


def _scaled(spark, sf):
    return customer_360(spark, sf).select(
        F.col("customer_id").alias("id"), *[(F.col(c).cast("double") / d).alias(n) for n, (c, d) in _SCALED.items()],
        is_value(R.target, R.positive).cast("double").alias("label"))


_DIST = " + ".join(f"(q.{c} - p.{c}) * (q.{c} - p.{c})" for c in _COLS)


@register("m8_knn_classifier", sql=with_c360(f"""
SELECT id, round(avg(y), 6) AS p1, CAST(avg(y) >= 0.5 AS INTEGER) AS prediction
FROM (SELECT q.id, p.y, row_number() OVER (PARTITION BY q.id ORDER BY sqrt({_DIST}), p.id) AS r
      FROM pts q JOIN pts p ON q.id % 5 = 0 AND p.id % 5 <> 0
      WHERE {" AND ".join(f"q.{c} IS NOT NULL AND p.{c} IS NOT NULL" for c in _COLS)})
WHERE r <= 5 GROUP BY id
""", extra_ctes=f"""
pts AS (SELECT customer_id AS id, {_SCALED_SQL}, CASE WHEN churn = 'Yes' THEN 1.0e0 ELSE 0.0e0 END AS y FROM c360)"""))
def q_knn(spark, sf):
    """M8: each customer whose id is divisible by five by its five nearest among the others."""
    rows = _scaled(spark, sf)
    return knn.knn_classify(rows.where("id % 5 <> 0"), rows.where("id % 5 = 0"), _COLS, 5)


_NULLED = {"tenure": 7, "total": 11}
_GAP = " + ".join(f"CASE WHEN q.{c} IS NULL THEN 0 ELSE (q.{c} - p.{c}) * (q.{c} - p.{c}) END" for c in _COLS)


def _filled(c):
    return f"""
SELECT id, '{c}' AS col, avg(x) AS value FROM (
  SELECT q.id, p.{c} AS x, row_number() OVER (PARTITION BY q.id ORDER BY sqrt({_GAP}), p.id) AS r
  FROM holes q JOIN holes p ON q.{c} IS NULL AND p.{c} IS NOT NULL
  WHERE {" AND ".join(f"(q.{o} IS NULL OR p.{o} IS NOT NULL)" for o in _COLS)})
WHERE r <= 5 GROUP BY id"""


@register("i4_knn_impute", sql=with_c360(f"""
SELECT id, {", ".join(f"round(coalesce({c}, (SELECT value FROM filled WHERE filled.id = holes.id AND col = '{c}'), (SELECT avg({c}) FROM holes)), 6) AS {c}"
                      for c in _COLS)}
FROM holes
""", extra_ctes=f"""
holes AS (SELECT id, {", ".join(f"CASE WHEN id % {_NULLED[c]} = 0 THEN NULL ELSE {c} END AS {c}" if c in _NULLED else c for c in _COLS)}
          FROM (SELECT customer_id AS id, {_SCALED_SQL} FROM c360)),
filled AS ({" UNION ALL ".join(_filled(c) for c in _NULLED)})"""))
def q_knn_impute(spark, sf):
    """I4: missing tenure and totals from the five nearest customers that have them."""
    rows = _scaled(spark, sf).select("id", *[
        F.when(F.col("id") % _NULLED[c] != 0, F.col(c)).alias(c) if c in _NULLED else F.col(c) for c in _COLS])
    return knn.knn_impute(rows, list(_COLS), 5)
