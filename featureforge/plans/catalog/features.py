"""Catalogued queries: business features, binning, interactions (F, B, X)."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols
from featureforge.operators import features as X
from featureforge.plans.catalog.sqlgen import cut_sql, flag, map_sql, products_sql, yes
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, customer_360_dirty, with_c360

SVC = ["svc_online_urgent", "svc_streaming_low", "svc_device_final", "svc_tech_pending"]


def rounded(sql_body: str, double_cols, digits: int = 6) -> str:
    rep = ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql_body}) q" if double_cols else sql_body


def new_cols(df, base_cols):
    return [c for c in df.columns if c not in base_cols]


# ------------------------------------------------------------------ F/B (FE)
_TOTAL_SVC = " + ".join(yes(c) for c in SVC)
_BUSINESS_SELECT = f"""
SELECT customer_id,
  tenure * monthly_charges AS CLV_estimate,
  (tenure * monthly_charges) / (tenure + 1) AS CLV_per_month,
  coalesce(TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) / (tenure + 1),
           CAST(monthly_charges AS DOUBLE)) AS ARPU,
  {_TOTAL_SVC} AS total_services,
  {_TOTAL_SVC} AS premium_services,
  ({_TOTAL_SVC}) / 4.0e0 AS service_adoption_rate,
  {map_sql('contract', R.contract_risk, 2)} AS contract_risk_score,
  {map_sql('payment', R.payment_risk, 2)} AS payment_risk_score,
  {cut_sql('tenure', R.tenure_bins, R.tenure_labels, True)} AS tenure_category,
  {flag('tenure <= 6')} AS is_new_customer,
  {flag('tenure >= 48')} AS is_loyal_customer,
  {cut_sql('monthly_charges', R.charges_bins, R.charges_labels, True)} AS charges_category,
  {flag('monthly_charges > s.mean_monthly')} AS above_avg_charges,
  CAST(NOT (svc_online_urgent IS NOT DISTINCT FROM 'No') AS INTEGER) AS has_internet,
  {yes('svc_online_urgent', 'Fiber optic')} AS fiber_optic_user,
  {yes('partner')} + {yes('dependents')} AS phone_service_complexity,
  {yes('partner')} + {yes('dependents')} AS family_score,
  CASE WHEN senior = 1 THEN 'Senior' WHEN dependents = 'Yes' THEN 'Family'
       WHEN partner = 'Yes' AND dependents = 'No' THEN 'Couple' ELSE 'Single' END AS life_stage,
  (tenure * monthly_charges) / s.max_clv * 0.7e0 + ({_TOTAL_SVC}) / s.max_svc * 0.3e0
    AS customer_value_score
FROM c360 CROSS JOIN (SELECT avg(monthly_charges) AS mean_monthly,
                             max(tenure * monthly_charges) AS max_clv,
                             max({_TOTAL_SVC}) AS max_svc FROM c360) s
"""
FM_CTE = ("fm AS (SELECT c360.customer_id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in [
        "senior", "tenure", "monthly_charges", "total_charges", "CLV_estimate", "CLV_per_month",
        "ARPU", "total_services", "premium_services", "service_adoption_rate",
        "contract_risk_score", "payment_risk_score", "is_new_customer", "is_loyal_customer",
        "above_avg_charges", "has_internet", "fiber_optic_user", "phone_service_complexity",
        "family_score", "customer_value_score"])
    + ", CAST(c360.churn = 'Yes' AS INTEGER) AS label FROM c360 JOIN (" + _BUSINESS_SELECT
    + ") b USING (customer_id))")
BIZ_CTE = ("biz AS (SELECT c360.*, b.* EXCLUDE (customer_id) FROM c360 JOIN ("
           + _BUSINESS_SELECT + ") b USING (customer_id))")
_BUSINESS_DOUBLES = ["CLV_estimate", "CLV_per_month", "ARPU", "service_adoption_rate",
                     "customer_value_score"]


@register("f_business_features", sql=with_c360(rounded(_BUSINESS_SELECT, _BUSINESS_DOUBLES)))
def q_business(spark, sf):
    """F1-F3, F5-F7, F9, F10, B1, F12, B2, F13-F18 on customer_360."""
    c = customer_360(spark, sf)
    out = X.business_features(c, R)
    return out.select(R.id, *new_cols(out, c.columns))


_ADV_SELECT = f"""
SELECT customer_id,
  tenure * monthly_charges AS CLV_estimate,
  (tenure * monthly_charges) / (tenure + 1) AS CLV_per_month,
  monthly_charges / (TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) / (tenure + 1) + 1e-8)
    AS revenue_momentum,
  {_TOTAL_SVC} AS total_services,
  ({_TOTAL_SVC}) / 4.0e0 AS service_adoption_rate,
  {yes('svc_streaming_low')} + {yes('svc_device_final')} + {yes('svc_tech_pending')} AS premium_services,
  ({yes('svc_streaming_low')} + {yes('svc_device_final')} + {yes('svc_tech_pending')}) / 3.0e0
    AS premium_adoption_rate,
  {map_sql('contract', R.contract_risk, 2)} AS contract_risk_score,
  {map_sql('payment', R.payment_risk, 2)} AS payment_risk_score,
  CASE WHEN tenure <= 6 THEN 3 WHEN tenure <= 24 THEN 2 ELSE 1 END AS tenure_risk_score,
  {cut_sql('monthly_charges', X.PRICE_TIER_BINS, X.PRICE_TIER_LABELS)} AS price_tier,
  {flag('monthly_charges > s.mean_monthly')} AS above_avg_spender,
  {cut_sql('tenure', X.LIFECYCLE_BINS, X.LIFECYCLE_LABELS)} AS lifecycle_stage,
  {yes('partner')} + {yes('dependents')} AS family_size_score
FROM c360 CROSS JOIN (SELECT avg(monthly_charges) AS mean_monthly FROM c360) s
"""


@register("w6_advanced_business_features", sql=with_c360(rounded(_ADV_SELECT, [
    "CLV_estimate", "CLV_per_month", "revenue_momentum", "service_adoption_rate",
    "premium_adoption_rate"])))
def q_adv_business(spark, sf):
    """F4, F8, F11, B3, B4 and the advanced F5/F6/F13/F16 variants."""
    c = customer_360(spark, sf)
    out = X.advanced_business_features(c, R)
    return out.select(R.id, *new_cols(out, c.columns))


_BASIC_SELECT = f"""
SELECT customer_id,
  tenure * monthly_charges AS CLV_estimate,
  TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) / (tenure + 1) AS ARPU,
  {map_sql('contract', R.contract_risk, None)} AS contract_risk_score,
  {map_sql('payment', R.payment_risk, None)} AS payment_risk_score
FROM c360_dirty
"""


@register("f_basic_business_features", sql=with_c360(rounded(_BASIC_SELECT, ["CLV_estimate", "ARPU"])))
def q_basic_business(spark, sf):
    """Basic variants on the dirty table: ARPU without fallback (blank -> null),
    unmapped risk -> null; no column matches the case-sensitive service names."""
    c = customer_360_dirty(spark, sf)
    out = X.basic_business_features(c, R)
    return out.select(R.id, *new_cols(out, c.columns))


_ARPU_DIRTY = """
SELECT customer_id,
  TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) AS total_numeric,
  coalesce(TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) / (tenure + 1),
           CAST(monthly_charges AS DOUBLE)) AS ARPU
FROM c360_dirty
"""


@register("i6_f3_coerce_and_arpu_fallback", sql=with_c360(rounded(_ARPU_DIRTY, ["total_numeric", "ARPU"])))
def q_arpu_dirty(spark, sf):
    """I6 coerce (blank text -> null) and F3 ARPU with its monthly fallback."""
    from featureforge.functions.exprs import as_double
    c = customer_360_dirty(spark, sf)
    return c.select(R.id, as_double(R.total).alias("total_numeric"), X.arpu(R).alias("ARPU"))


_BIN_SELECT = f"""
SELECT customer_id,
  {cut_sql('tenure', X.TENURE_GROUP_BINS, X.TENURE_GROUP_LABELS)} AS tenure_group,
  {cut_sql('monthly_charges / 1000', X.CHARGES_GROUP_BINS, X.CHARGES_GROUP_LABELS)} AS charges_group,
  CASE WHEN tenure > -1 THEN ln(1 + tenure) END AS tenure_log,
  CASE WHEN monthly_charges >= 0 THEN sqrt(monthly_charges) END AS monthly_charges_sqrt
FROM c360
"""


@register("b5_b7_binned_and_transforms", sql=with_c360(rounded(_BIN_SELECT, ["tenure_log", "monthly_charges_sqrt"])))
def q_binned(spark, sf):
    """B5/B6 fixed-edge groups (charges in thousands) and B7 log1p / sqrt."""
    c = customer_360(spark, sf).withColumn("monthly_k", F.col("monthly_charges") / 1000)
    roles = R.with_(monthly="monthly_k")
    out = X.binned_features(c, roles)
    out = X.log_sqrt_transform(out, ["tenure"], ["monthly_charges"])
    return out.select(R.id, "tenure_group", "charges_group", "tenure_log", "monthly_charges_sqrt")


# ------------------------------------------------------------------ X
_KEY = ["tenure", "monthly_charges", "CLV_estimate", "total_services"]
_X_SQL = """
SELECT customer_id,
  CAST(tenure AS DOUBLE) * CAST(monthly_charges AS DOUBLE) AS tenure_x_monthly_charges,
  CAST(tenure AS DOUBLE) * CAST(CLV_estimate AS DOUBLE) AS tenure_x_CLV_estimate,
  CAST(tenure AS DOUBLE) * CAST(total_services AS DOUBLE) AS tenure_x_total_services,
  CAST(monthly_charges AS DOUBLE) * CAST(CLV_estimate AS DOUBLE) AS monthly_charges_x_CLV_estimate,
  monthly_charges * total_services AS monthly_charges_x_total_services,
  CAST(CLV_estimate AS DOUBLE) * CAST(total_services AS DOUBLE) AS CLV_estimate_x_total_services,
  total_services * monthly_charges AS total_services_x_monthly_charges,
  contract_risk_score * payment_risk_score AS contract_risk_score_x_payment_risk_score,
  contract_risk_score / (payment_risk_score + 1e-8) AS contract_risk_score_div_payment_risk_score,
  family_score * total_services AS family_score_x_total_services
FROM biz
"""


@register("x1_x5_interaction_features", sql=with_c360(_X_SQL, extra_ctes=BIZ_CTE), digits=None)
def q_interactions(spark, sf):
    """X1 products of the key numerics + X5 manual pairs (FE gates: ratio
    only where both columns are > 0 everywhere).  The output schema is
    decided by the data at fit time; the oracle spells the sf0.01 outcome
    (tenure 0 exists there, so only the risk-score ratio passes its gate)."""
    c = customer_360(spark, sf)
    biz = X.business_features(c, R)
    out = X.interaction_features(biz, R)
    return out.select(R.id, *new_cols(out, biz.columns))


def _x2_cols():
    return ["senior", "tenure", "monthly_charges", "total_charges", "CLV_estimate",
            "CLV_per_month", "ARPU", "total_services", "premium_services",
            "service_adoption_rate"]


@register("x2_pairwise_first10", sql=with_c360(
    "SELECT customer_id, " + ", ".join(products_sql(_x2_cols(), 2, " ")) + " FROM biz",
    extra_ctes=BIZ_CTE), digits=None)
def q_x2(spark, sf):
    """Pairwise products of the first 10 numeric columns (id excluded), names 'a b'."""
    c = customer_360(spark, sf)
    biz = X.business_features(c, R)
    cols = numeric_cols(biz, exclude=[R.id])[:10]
    out = X.pairwise_products(biz, cols, 2, sep=" ")
    return out.select(R.id, *new_cols(out, biz.columns))


def _poly_sql():
    cols = ["senior", "tenure", "monthly_charges", "total_charges", "CLV_estimate"]
    items = []
    for combo in itertools.combinations_with_replacement(cols, 2):
        a, b = combo
        name = f"{a}^2" if a == b else f"{a} {b}"
        items.append(f'CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE) AS "{name}"')
    return with_c360("SELECT customer_id, " + ", ".join(items) + " FROM biz", extra_ctes=BIZ_CTE)


@register("x3_polynomial_first5", sql=_poly_sql(), digits=None)
def q_x3(spark, sf):
    """Degree-2 polynomial block (products and squares) of the first five
    numeric columns; originals dropped from the block."""
    c = customer_360(spark, sf)
    biz = X.business_features(c, R)
    cols = numeric_cols(biz, exclude=[R.id])[:5]
    out = X.polynomial_features(biz.select(R.id, *cols), cols, 2)
    return out


_X4_ORDER = ["total_charges", "monthly_charges", "tenure", "senior"]


@register("x4_x5_top_variance_interactions", digits=None, sql=with_c360(
    "SELECT customer_id, " + ", ".join(products_sql(_X4_ORDER, 2, "_x_"))
    + ", tenure * monthly_charges AS tenure_mult_monthly_charges"
    + ", tenure / (monthly_charges + 1e-8) AS tenure_div_monthly_charges FROM c360"))
def q_x4(spark, sf):
    """The top-variance numerics (ranked by sample variance, here all four
    customer numerics) multiplied pairwise, then the advanced X5 pairs
    (``_mult_`` always, ``_div_`` when the divisor is never 0)."""
    c = customer_360(spark, sf).select(R.id, "senior", "tenure", "monthly_charges", "total_charges")
    out = X.advanced_interactions(c, R, exclude=[R.id])
    return out.select(R.id, *new_cols(out, c.columns))
