"""Test-data tables and the derived ``customer_360`` table.

``customer_360`` plays the role of the canonical customer table: one row per
customer, built from ``customer`` LEFT JOIN (``orders`` aggregated by
customer).  The orders side is aggregated with a map-side partial aggregate
before its shuffle, so the join input is one row per customer and the join
is co-partitioned on the customer key (only ``customer`` is exchanged; the
planner broadcasts the aggregated side only when its estimated size is under
the broadcast threshold).  The global last order date is a one-row global
aggregate of ``orders`` (broadcast: one row by construction).

The same derivation is written once in DuckDB SQL (``C360_SQL``) so every
oracle query starts from an identical table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _months(c):
    return F.year(c) * 12 + F.month(c)


_MEMO: dict = {}


def shared(spark: SparkSession, key: tuple, build) -> DataFrame:
    """A derived table shared by many reports of one session: persisted once
    (MEMORY_AND_DISK; blocks lost with an executor are recomputed from the
    lineage).  ``FEATUREFORGE_CACHE=0`` disables it."""
    if os.environ.get("FEATUREFORGE_CACHE", "1") == "0":
        return build()
    try:
        sid = spark._jsparkSession.hashCode()
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session)
        sid = id(spark)
    k = (sid, key)
    hit = _MEMO.get(k)
    if hit is None:
        from pyspark import StorageLevel
        hit = build().persist(StorageLevel.MEMORY_AND_DISK)
        _MEMO[k] = hit
    return hit


def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, ("customer_360", os.path.abspath(sf_dir)), lambda: _customer_360(spark, sf_dir))


def _customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    per = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        # cents: the true sum has two decimals, rounding makes it engine-independent
        F.round(F.sum("o_totalprice"), 2).alias("sum_price"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("n_low"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_pending"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"),
    )
    # the latest order date overall: a global max with partial aggregation
    # (no second per-customer shuffle); one row, broadcast by construction
    horizon = orders.agg(F.max("o_orderdate").alias("max_date"))
    j = (cust.join(per, cust.c_custkey == per.o_custkey, "left")
         .crossJoin(F.broadcast(horizon)))
    tenure = (_months(F.col("last_order")) - _months(F.col("first_order"))).cast("bigint")

    def flag(cnt, k):
        return F.when(F.coalesce(F.col(cnt), F.lit(0)) >= k, "Yes").otherwise("No")

    return j.select(
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_custkey") % 6 == 0).cast("bigint").alias("senior"),
        F.when(F.col("c_nationkey") % 2 == 0, "Yes").otherwise("No").alias("partner"),
        F.when(F.col("c_acctbal") > 5000, "Yes").otherwise("No").alias("dependents"),
        tenure.alias("tenure"),
        flag("n_urgent", 2).alias("svc_online_urgent"),
        flag("n_low", 2).alias("svc_streaming_low"),
        flag("n_final", 3).alias("svc_device_final"),
        flag("n_pending", 4).alias("svc_tech_pending"),
        F.col("c_mktsegment").alias("contract"),
        F.col("last_priority").alias("payment"),
        (F.col("sum_price") / (tenure + 1)).alias("monthly_charges"),
        F.col("sum_price").alias("total_charges"),
        F.when(F.col("last_order").isNull()
               | (F.col("last_order") < F.col("max_date") - F.expr("INTERVAL 365 DAYS")),
               "Yes").otherwise("No").alias("churn"),
    )


def customer_360_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_360 with deterministic gaps: numeric and categorical nulls and
    a numeric column stored as text with blanks (the classic dirty charge)."""
    c = customer_360(spark, sf_dir)
    cid = F.col("customer_id")
    return c.select(
        "customer_id", "senior", "partner", "dependents",
        F.when(cid % 13 == 0, None).otherwise(F.col("tenure")).alias("tenure"),
        "svc_online_urgent", "svc_streaming_low", "svc_device_final", "svc_tech_pending",
        F.when(cid % 5 == 0, None).otherwise(F.col("contract")).alias("contract"),
        "payment",
        F.when(cid % 7 == 0, None).otherwise(F.col("monthly_charges")).alias("monthly_charges"),
        F.when(cid % 11 == 0, F.lit(" ")).otherwise(F.col("total_charges").cast("string"))
         .alias("total_charges"),
        "churn",
    )


# DuckDB twin of customer_360 / customer_360_dirty (oracle side).
C360_SQL = """
per AS (
  SELECT o_custkey,
         min(o_orderdate) AS first_order,
         max(o_orderdate) AS last_order,
         round(sum(o_totalprice), 2) AS sum_price,
         CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS n_urgent,
         CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS n_low,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS n_final,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_pending,
         arg_max(o_orderpriority, row(o_orderdate, o_orderkey)) AS last_priority
  FROM orders GROUP BY o_custkey
),
horizon AS (SELECT max(last_order) AS max_date FROM per),
c360_base AS (
  SELECT c.c_custkey AS customer_id,
         CAST(c.c_custkey % 6 = 0 AS BIGINT) AS senior,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
         CASE WHEN c.c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS dependents,
         CAST((year(p.last_order) * 12 + month(p.last_order))
              - (year(p.first_order) * 12 + month(p.first_order)) AS BIGINT) AS tenure,
         CASE WHEN coalesce(p.n_urgent, 0) >= 2 THEN 'Yes' ELSE 'No' END AS svc_online_urgent,
         CASE WHEN coalesce(p.n_low, 0) >= 2 THEN 'Yes' ELSE 'No' END AS svc_streaming_low,
         CASE WHEN coalesce(p.n_final, 0) >= 3 THEN 'Yes' ELSE 'No' END AS svc_device_final,
         CASE WHEN coalesce(p.n_pending, 0) >= 4 THEN 'Yes' ELSE 'No' END AS svc_tech_pending,
         c.c_mktsegment AS contract,
         p.last_priority AS payment,
         p.sum_price AS total_charges,
         CASE WHEN p.last_order IS NULL OR p.last_order < h.max_date - INTERVAL 365 DAY
              THEN 'Yes' ELSE 'No' END AS churn
  FROM customer c LEFT JOIN per p ON c.c_custkey = p.o_custkey CROSS JOIN horizon h
),
c360 AS (
  SELECT customer_id, senior, partner, dependents, tenure,
         svc_online_urgent, svc_streaming_low, svc_device_final, svc_tech_pending,
         contract, payment, total_charges / (tenure + 1) AS monthly_charges,
         total_charges, churn
  FROM c360_base
),
c360_dirty AS (
  SELECT customer_id, senior, partner, dependents,
         CASE WHEN customer_id % 13 = 0 THEN NULL ELSE tenure END AS tenure,
         svc_online_urgent, svc_streaming_low, svc_device_final, svc_tech_pending,
         CASE WHEN customer_id % 5 = 0 THEN NULL ELSE contract END AS contract,
         payment,
         CASE WHEN customer_id % 7 = 0 THEN NULL ELSE monthly_charges END AS monthly_charges,
         CASE WHEN customer_id % 11 = 0 THEN ' ' ELSE CAST(total_charges AS VARCHAR) END AS total_charges,
         churn
  FROM c360
)
"""


def with_c360(select_sql: str, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the customer_360 CTEs."""
    ctes = C360_SQL.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + select_sql
