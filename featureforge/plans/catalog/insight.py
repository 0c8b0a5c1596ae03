"""Catalogued queries: segment and revenue insight."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.operators import insight as N
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, with_c360

_SEG5 = ["partner", "dependents", "svc_online_urgent", "svc_streaming_low", "svc_device_final"]
_ALLCAT = _SEG5 + ["svc_tech_pending", "contract", "payment"]


def _rate_sql(cols, max_card):
    unp = ", ".join(cols)
    return with_c360(f"""
SELECT g.feature, g.category, g.n_rows,
       round(CAST(g.npos AS DOUBLE) * 100 / g.n_rows, 6) AS churn_rate
FROM g JOIN card ON g.feature = card.feature
WHERE card.k <= {max_card}
""", extra_ctes=f"""
long AS (
  UNPIVOT (SELECT {unp}, CAST(churn = 'Yes' AS INTEGER) AS pos FROM c360)
  ON {unp} INTO NAME feature VALUE category
),
g AS (
  SELECT feature, category, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(pos) AS BIGINT) AS npos
  FROM long WHERE category IS NOT NULL GROUP BY feature, category
),
card AS (SELECT feature, count(*) AS k FROM g GROUP BY feature)
""")


@register("n1_churn_by_segment", sql=_rate_sql(_SEG5, 10))
def q_n1(spark, sf):
    return N.churn_by_segment(customer_360(spark, sf), R)


@register("n2_churn_rate_by_category", sql=_rate_sql(_ALLCAT, 8))
def q_n2(spark, sf):
    return N.churn_rate_by_category(customer_360(spark, sf), R)


@register("n3_avg_charge_by_target", sql=with_c360("""
SELECT churn AS target, round(avg(monthly_charges), 6) AS avg_monthly
FROM c360 WHERE churn IS NOT NULL GROUP BY churn
"""))
def q_n3(spark, sf):
    return N.avg_charge_by_target(customer_360(spark, sf), R)


@register("n4_revenue_at_risk", sql=with_c360("""
SELECT round(coalesce(sum(monthly_charges) FILTER (WHERE churn = 'Yes'), 0.0), 6) AS revenue_at_risk,
       CAST(count(*) FILTER (WHERE churn = 'Yes') AS BIGINT) AS n_positive
FROM c360
"""))
def q_n4(spark, sf):
    return N.revenue_at_risk(customer_360(spark, sf), R)


_N5_SQL = with_c360("""
SELECT b.bin,
       round(CASE WHEN b.bin = 1 THEN mm.mn - (mm.mx - mm.mn) * 0.001
                  ELSE CAST(b.bin - 1 AS DOUBLE) * ((mm.mx - mm.mn) / 5) + mm.mn END, 6) AS lower,
       round(CASE WHEN b.bin = 5 THEN mm.mx
                  ELSE CAST(b.bin AS DOUBLE) * ((mm.mx - mm.mn) / 5) + mm.mn END, 6) AS upper,
       CAST(coalesce(c.n_rows, 0) AS BIGINT) AS n_rows,
       round(coalesce(CAST(c.npos AS DOUBLE) * 100 / c.n_rows, 0.0), 6) AS churn_rate
FROM (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS bin) b
CROSS JOIN mm
LEFT JOIN c ON b.bin = c.bin
""", extra_ctes="""
x AS (SELECT CAST(tenure AS DOUBLE) AS x, CAST(churn = 'Yes' AS INTEGER) AS pos FROM c360 WHERE tenure IS NOT NULL),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM x),
c AS (
  SELECT CASE WHEN x <= 1.0 * ((mx - mn) / 5) + mn THEN 1
              WHEN x <= 2.0 * ((mx - mn) / 5) + mn THEN 2
              WHEN x <= 3.0 * ((mx - mn) / 5) + mn THEN 3
              WHEN x <= 4.0 * ((mx - mn) / 5) + mn THEN 4
              WHEN x <= mx THEN 5 END AS bin,
         count(*) AS n_rows, sum(pos) AS npos
  FROM x CROSS JOIN mm GROUP BY 1
)
""")


@register("n5_churn_by_tenure_bins", sql=_N5_SQL)
def q_n5(spark, sf):
    return N.churn_by_equal_width_bins(customer_360(spark, sf), R, "tenure", 5)


@register("n7_feature_target_correlation", sql=with_c360("""
SELECT feature, round(abs(r), 6) AS abs_corr FROM (
  UNPIVOT (SELECT corr(CAST(senior AS DOUBLE), y) AS senior,
                  corr(CAST(tenure AS DOUBLE), y) AS tenure,
                  corr(monthly_charges, y) AS monthly_charges,
                  corr(total_charges, y) AS total_charges
           FROM (SELECT *, CAST(churn = 'Yes' AS DOUBLE) AS y FROM c360))
  ON senior, tenure, monthly_charges, total_charges INTO NAME feature VALUE r)
WHERE r IS NOT NULL AND NOT isnan(r)
ORDER BY abs(r) DESC, feature LIMIT 15
"""))
def q_n7(spark, sf):
    return N.feature_target_correlation(customer_360(spark, sf), R, top=15)


@register("n6_churn_rate_by_services", sql=with_c360(f"""
SELECT total_services AS value, count(*) AS n_rows,
       round(avg(CAST(churn = 'Yes' AS DOUBLE)) * 100.0, 6) AS churn_rate
FROM (SELECT churn, {" + ".join(f"CAST(coalesce({c} = 'Yes', false) AS INTEGER)" for c in
       ["svc_online_urgent", "svc_streaming_low", "svc_device_final", "svc_tech_pending"])} AS total_services
      FROM c360)
GROUP BY total_services
"""))
def q_n6(spark, sf):
    """% positive by an engineered discrete feature (service count)."""
    from featureforge.operators import features as X
    c = customer_360(spark, sf)
    biz = X.business_features(c, R)
    return N.churn_rate_by_feature(biz, R, "total_services")
