"""Catalogued flagship query (the ``entry()`` slice at any scale)."""

from featureforge.plans.catalog.sqlgen import cut_sql, map_sql
from featureforge.plans.flagship import flagship
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import with_c360

_SQL = with_c360(f"""
SELECT segment, category, CAST(count(*) AS BIGINT) AS n_customers,
       round(CAST(sum(pos) AS DOUBLE) * 100 / count(*), 6) AS churn_rate,
       round(avg(CLV_estimate), 4) AS avg_clv, round(avg(ARPU), 4) AS avg_arpu
FROM (UNPIVOT f ON tenure_category, contract, contract_risk_score, payment
      INTO NAME segment VALUE category)
WHERE category IS NOT NULL
GROUP BY segment, category
""", extra_ctes=f"""
f AS (
  SELECT customer_id, tenure * monthly_charges AS CLV_estimate,
         coalesce(TRY_CAST(trim(CAST(total_charges AS VARCHAR)) AS DOUBLE) / (tenure + 1),
                  monthly_charges) AS ARPU,
         {cut_sql('tenure', R.tenure_bins, R.tenure_labels, True)} AS tenure_category,
         contract,
         CAST({map_sql('contract', R.contract_risk, 2)} AS VARCHAR) AS contract_risk_score,
         payment,
         CAST(churn = 'Yes' AS INTEGER) AS pos
  FROM c360)
""")


@register("flagship_segment_churn_value", sql=_SQL, digits={"*": 6, "avg_clv": 4, "avg_arpu": 4})
def q_flagship(spark, sf):
    return flagship(spark, sf)
