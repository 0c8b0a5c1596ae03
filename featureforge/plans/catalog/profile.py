"""Catalogued queries: validation and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.operators import features as X
from featureforge.operators import profile as P
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, customer_360_dirty, table, with_c360

C360_COLS = ["customer_id", "senior", "partner", "dependents", "tenure", "svc_online_urgent",
             "svc_streaming_low", "svc_device_final", "svc_tech_pending", "contract", "payment",
             "monthly_charges", "total_charges", "churn"]
EXPECTED = ["customer_id", "gender", "senior", "partner", "dependents", "tenure", "contract",
            "payment", "monthly_charges", "total_charges", "churn"]


def _nulls_sql(table_name, cols):
    counts = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in cols)
    on = ", ".join(f'"{c}"' for c in cols)
    return (f"(SELECT \"column\", CAST(m AS BIGINT) AS missing_count, n AS total_rows FROM "
            f"(UNPIVOT (SELECT {counts} FROM {table_name}) ON {on} INTO NAME \"column\" VALUE m) "
            f"CROSS JOIN (SELECT count(*) AS n FROM {table_name}))")


_NULL_SUM = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in C360_COLS)


@register("q1_q3_validation_report", sql=with_c360(f"""
SELECT 1 AS n_missing, 4 AS n_extra, 'gender' AS missing,
       'svc_device_final,svc_online_urgent,svc_streaming_low,svc_tech_pending' AS extra,
       false AS schema_valid, *
FROM (
  SELECT count(*) AS total_rows, 1000 AS min_rows_required, count(*) >= 1000 AS has_enough_rows,
         round(CAST(sum(m) AS DOUBLE) / (count(*) * 14), 6) AS missing_fraction,
         0.3e0 AS max_missing_allowed,
         coalesce(CAST(sum(m) AS DOUBLE) / (count(*) * 14) <= 0.3, false) AS acceptable_missing,
         count(*) > 0 AS is_not_empty,
         count(*) >= 1000 AND coalesce(CAST(sum(m) AS DOUBLE) / (count(*) * 14) <= 0.3, false)
           AND count(*) > 0 AS overall_valid
  FROM (SELECT {_NULL_SUM} AS m FROM c360_dirty))
"""))
def q_validation(spark, sf):
    """Q1 schema check (one expected column missing, service columns extra),
    Q2 quality gate (fraction of null cells), Q3 both as one row."""
    return P.validation_report(customer_360_dirty(spark, sf), EXPECTED, 0.3, 1000)


@register("q4_q6_schema_profile", sql=with_c360("""
SELECT CAST(position AS INTEGER) AS position, "column", dtype, kind, n AS total_records FROM (VALUES
 (0, 'customer_id', 'bigint', 'numeric'), (1, 'senior', 'bigint', 'numeric'),
 (2, 'partner', 'string', 'categorical'), (3, 'dependents', 'string', 'categorical'),
 (4, 'tenure', 'bigint', 'numeric'), (5, 'svc_online_urgent', 'string', 'categorical'),
 (6, 'svc_streaming_low', 'string', 'categorical'), (7, 'svc_device_final', 'string', 'categorical'),
 (8, 'svc_tech_pending', 'string', 'categorical'), (9, 'contract', 'string', 'categorical'),
 (10, 'payment', 'string', 'categorical'), (11, 'monthly_charges', 'double', 'numeric'),
 (12, 'total_charges', 'string', 'categorical'), (13, 'churn', 'string', 'categorical'))
 t(position, "column", dtype, kind)
CROSS JOIN (SELECT count(*) AS n FROM c360_dirty)
"""))
def q_schema(spark, sf):
    """Q4 basic stats (rows, columns, dtypes) and Q6 numeric/categorical split."""
    return P.schema_profile(customer_360_dirty(spark, sf))


@register("q5_missing_profile", sql=with_c360(f"""
SELECT "column", missing_count, round(missing_count * 100.0e0 / total_rows, 6) AS missing_pct
FROM {_nulls_sql('c360_dirty', C360_COLS)} WHERE missing_count > 0
"""))
def q_missing(spark, sf):
    return P.missing_profile(customer_360_dirty(spark, sf))


@register("q5_missing_summary", sql=with_c360(f"""
SELECT CAST(sum(missing_count) AS BIGINT) AS total_missing_cells,
       round(sum(missing_count) * 100.0e0 / (max(total_rows) * 14), 6) AS pct_missing_cells
FROM {_nulls_sql('c360_dirty', C360_COLS)}
"""))
def q_missing_summary(spark, sf):
    return P.missing_summary(customer_360_dirty(spark, sf))


@register("q7_duplicate_profile", sql="""
SELECT CAST(sum(c - 1) AS BIGINT) AS duplicate_count, round(sum(c - 1) * 100.0e0 / sum(c), 6) AS duplicate_pct
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber)
""")
def q_dups(spark, sf):
    """Q7 on the low-cardinality lineitem columns (most rows repeat)."""
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return P.duplicate_profile(li)


def _unique_sql(table_name, cols, n_expr="n"):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT \"{c}\") AS BIGINT) AS unique_count FROM {table_name}"
        for c in cols)
    return (f"SELECT \"column\", unique_count, round(unique_count * 100.0e0 / {n_expr}, 6) AS unique_pct "
            f"FROM ({parts}) CROSS JOIN (SELECT count(*) AS n FROM {table_name})")


@register("q8_unique_profile", sql=with_c360(_unique_sql("c360_dirty", C360_COLS)))
def q_unique(spark, sf):
    return P.unique_profile(customer_360_dirty(spark, sf))


@register("q9_issue_list", sql="""
SELECT 'high_cardinality' AS issue, 'c_name' AS "column"
FROM customer HAVING count(DISTINCT c_name) > 50
UNION ALL
SELECT 'high_cardinality', 'c_mktsegment' FROM customer HAVING count(DISTINCT c_mktsegment) > 50
UNION ALL
SELECT 'all_missing', 'c_phone_dummy' FROM customer WHERE false
""")
def q_issues(spark, sf):
    """Q9 on ``customer`` (c_name is an id-like string)."""
    return P.issue_list(table(spark, sf, "customer"))


_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in C360_COLS)
_NULL_COUNTS = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in C360_COLS)
_COLS_WITH_NULL = " + ".join(f"CAST(count(*) FILTER (WHERE {c} IS NULL) > 0 AS INTEGER)" for c in C360_COLS)


@register("q10_completeness", sql=with_c360(f"""
SELECT round((count(*) * 14 - ({_NULL_COUNTS})) * 100.0e0 / (count(*) * 14), 6) AS overall_completeness,
       {_COLS_WITH_NULL} AS columns_with_missing_data,
       CAST(count(*) FILTER (WHERE {_ANY_NULL}) AS BIGINT) AS records_with_missing_data
FROM c360_dirty
"""))
def q_completeness(spark, sf):
    return P.completeness(customer_360_dirty(spark, sf))


_CATS = ["partner", "dependents", "svc_online_urgent", "svc_streaming_low", "svc_device_final",
         "svc_tech_pending", "contract", "payment", "total_charges", "churn"]


@register("q11_categorical_profile", sql=with_c360(f"""
SELECT "column", CAST(rank AS INTEGER) AS rank, value, count, round(count * 100.0e0 / n, 6) AS pct,
       unique_values, unique_values > 20 AS is_high_cardinality
FROM (
  SELECT vc.*, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value ASC) AS rank,
         count(*) OVER (PARTITION BY "column") AS unique_values
  FROM (SELECT "column", value, count(*) AS count
        FROM (UNPIVOT (SELECT {", ".join(_CATS)} FROM c360_dirty) ON {", ".join(_CATS)}
              INTO NAME "column" VALUE value)
        WHERE value IS NOT NULL GROUP BY "column", value) vc)
CROSS JOIN (SELECT count(*) AS n FROM c360_dirty)
WHERE rank <= 10
"""))
def q_categorical(spark, sf):
    """Q11 on every string column of the dirty table (total_charges as text is
    high-cardinality: only its top 10 values are kept)."""
    return P.categorical_profile(customer_360_dirty(spark, sf))


@register("q12_target_distribution", sql=with_c360("""
SELECT churn AS target, count(*) AS count, round(count(*) * 100.0e0 / (SELECT count(*) FROM c360), 6) AS pct
FROM c360 WHERE churn IS NOT NULL GROUP BY churn
"""))
def q_target(spark, sf):
    return P.target_distribution(customer_360(spark, sf), R)


@register("q12_class_balance", sql=with_c360("""
SELECT count(*) AS total_samples, CAST(count(*) FILTER (WHERE churn IS NULL) AS BIGINT) AS missing_count,
       round(count(*) FILTER (WHERE churn IS NULL) * 100.0e0 / count(*), 6) AS missing_pct,
       k AS n_classes, mn AS minority_class_count, mx AS majority_class_count,
       round(CAST(mx AS DOUBLE) / mn, 6) AS imbalance_ratio, CAST(mx AS DOUBLE) / mn > 1.5 AS is_imbalanced
FROM c360 CROSS JOIN (SELECT count(*) AS k, min(c) AS mn, max(c) AS mx
                      FROM (SELECT count(*) AS c FROM c360 WHERE churn IS NOT NULL GROUP BY churn))
GROUP BY k, mn, mx
"""))
def q_balance(spark, sf):
    return P.class_balance(customer_360(spark, sf), R)


_LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net_price"]


def _lineitem_num(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*_LI[:4], (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"))


def _corr_sql():
    cells = []
    for i, a in enumerate(_LI):
        for j, b in enumerate(_LI):
            r = ("CASE WHEN stddev_pop({a}) > 0 THEN 1.0e0 END".format(a=a) if i == j
                 else f"corr({_LI[min(i, j)]}, {_LI[max(i, j)]})")
            cells.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS feature1, '{b}' AS feature2, "
                         f"round({r}, 6) AS correlation FROM li")
    return ("WITH li AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_extendedprice * (1 - l_discount) AS net_price FROM lineitem)\n"
            + "\nUNION ALL\n".join(cells))


@register("q13_correlation_matrix", sql=_corr_sql())
def q_corr(spark, sf):
    """Q13 on lineitem numerics plus the derived net price (r ~ 0.998)."""
    return P.correlation_matrix(_lineitem_num(spark, sf), _LI).withColumn("i", F.col("i").cast("int")).withColumn("j", F.col("j").cast("int"))


@register("q13_correlation_summary", sql="SELECT round(max(x), 6) AS max_correlation, round(avg(m), 6) AS mean_correlation FROM ("
          "SELECT j, avg(abs(correlation)) AS m, max(abs(correlation)) AS x FROM ("
          + _corr_sql().replace("round(", "(").replace(", 6) AS correlation", ") AS correlation")
          + ") GROUP BY j)")
def q_corr_summary(spark, sf):
    return P.correlation_summary(P.correlation_matrix(_lineitem_num(spark, sf), _LI))


@register("q14_high_correlations", sql="SELECT feature1, feature2, round(correlation, 6) AS correlation FROM ("
          + _corr_sql().replace("round(", "(").replace(", 6) AS correlation", ") AS correlation")
          + ") WHERE i < j AND abs(correlation) > 0.7")
def q_high_corr(spark, sf):
    return P.high_correlations(P.correlation_matrix(_lineitem_num(spark, sf), _LI), 0.7)


def _outlier_sql(src: str, cols, label_src: str):
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS "column", n, round(q1 - 1.5 * (q3 - q1), 6) AS iqr_lower, round(q3 + 1.5 * (q3 - q1), 6) AS iqr_upper,
  iqr_outliers, round(iqr_outliers * 100.0e0 / n, 6) AS iqr_pct,
  zscore_outliers, round(zscore_outliers * 100.0e0 / n, 6) AS zscore_pct,
  modified_zscore_outliers, round(modified_zscore_outliers * 100.0e0 / n, 6) AS modified_zscore_pct
FROM (
  SELECT s.n, s.q1, s.q3,
    CAST(count(*) FILTER (WHERE x < s.q1 - 1.5 * (s.q3 - s.q1) OR x > s.q3 + 1.5 * (s.q3 - s.q1)) AS BIGINT) AS iqr_outliers,
    CAST(count(*) FILTER (WHERE s.sd > 0 AND abs(x - s.mu) / s.sd > 3) AS BIGINT) AS zscore_outliers,
    CAST(count(*) FILTER (WHERE CASE WHEN s.mad = 0 THEN x <> s.med ELSE abs(0.6745 * (x - s.med) / s.mad) > 3.5 END) AS BIGINT)
      AS modified_zscore_outliers
  FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {src} WHERE {c} IS NOT NULL) d
  CROSS JOIN (
    SELECT a.*, (SELECT quantile_cont(abs(CAST({c} AS DOUBLE) - a.med), 0.5) FROM {src} WHERE {c} IS NOT NULL) AS mad
    FROM (SELECT count({c}) AS n, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
                 quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
                 avg(CAST({c} AS DOUBLE)) AS mu, stddev_pop(CAST({c} AS DOUBLE)) AS sd FROM {src}) a) s
  GROUP BY s.n, s.q1, s.q3)""")
    return label_src + "\nUNION ALL\n".join(parts)


@register("q15_outlier_report", sql=with_c360(_outlier_sql(
    "c360", ["senior", "tenure", "monthly_charges", "total_charges"], "")))
def q_outliers(spark, sf):
    """Q15 on customer_360 numerics (senior has MAD = 0 and IQR = 0)."""
    return P.outlier_report(customer_360(spark, sf), R)


@register("q15_outlier_report_events", sql=_outlier_sql("events", ["value"], ""))
def q_outliers_events(spark, sf):
    """Q15 on events.value (heavy right tail)."""
    return P.outlier_report(table(spark, sf, "events"), cols=["value"])


@register("q16_histogram", sql=with_c360("""
SELECT CAST(b.bin AS INTEGER) AS bin, round(mn + (b.bin - 1) * (mx - mn) / 30, 6) AS lower,
       round(mn + b.bin * (mx - mn) / 30, 6) AS upper, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT unnest(range(1, 31)) AS bin) b CROSS JOIN mm
LEFT JOIN (SELECT CAST(least(floor((x - mn) / ((mx - mn) / 30)) + 1, 30) AS INTEGER) AS bin, count(*) AS cnt
           FROM (SELECT monthly_charges AS x FROM c360 WHERE monthly_charges IS NOT NULL) CROSS JOIN mm GROUP BY 1) c
  ON b.bin = c.bin
""", extra_ctes="mm AS (SELECT min(monthly_charges) AS mn, max(monthly_charges) AS mx FROM c360)"))
def q_hist(spark, sf):
    return P.histogram(customer_360(spark, sf), "monthly_charges", 30)


@register("q17_box_stats", sql=with_c360("""
SELECT b.churn AS "group", q.n, round(q.q1, 6) AS q1, round(q.med, 6) AS median, round(q.q3, 6) AS q3,
       round(min(x) FILTER (WHERE x >= q.q1 - 1.5 * (q.q3 - q.q1)), 6) AS whisker_low,
       round(max(x) FILTER (WHERE x <= q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_high
FROM (SELECT churn, monthly_charges AS x FROM c360 WHERE monthly_charges IS NOT NULL) b
JOIN (SELECT churn, count(*) AS n, quantile_cont(monthly_charges, 0.25) AS q1, quantile_cont(monthly_charges, 0.5) AS med,
             quantile_cont(monthly_charges, 0.75) AS q3 FROM c360 WHERE monthly_charges IS NOT NULL GROUP BY churn) q
  ON b.churn IS NOT DISTINCT FROM q.churn
GROUP BY b.churn, q.n, q.q1, q.med, q.q3
"""))
def q_box(spark, sf):
    return P.box_stats(customer_360(spark, sf), "monthly_charges", "churn")


def _q18_sql():
    """Types as the engine reports them for the columns' values."""
    import re

    from featureforge.plans.catalog.features import _BUSINESS_SELECT
    made = re.findall(r" AS (\w+)(?:,\n|\n$)", _BUSINESS_SELECT.split("FROM c360 CROSS JOIN")[0])
    cells = [("c360", c) for c in C360_COLS] + [("biz", c) for c in made]
    rows = " UNION ALL ".join(f"SELECT '{t}' AS source, any_value(typeof({c})) AS kind, count({c}) AS filled FROM {t}" for t, c in cells)
    return with_c360("""
SELECT CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(kind) END AS dtype,
       CAST(count(*) FILTER (WHERE source = 'c360') AS INTEGER) AS n_before, CAST(count(*) AS INTEGER) AS n_after,
       CAST(coalesce(sum(filled) FILTER (WHERE source = 'c360'), 0) AS BIGINT) AS filled_before,
       CAST(sum(filled) AS BIGINT) AS filled_after
FROM cells GROUP BY 1
""", extra_ctes=f"biz AS ({_BUSINESS_SELECT}), cells AS ({rows})")


@register("q18_dtype_distribution", sql=_q18_sql())
def q_dtypes(spark, sf):
    """Q18: columns and filled cells per dtype before/after the business-feature step."""
    c = customer_360(spark, sf)
    return P.dtype_distribution(c, X.business_features(c, R))


@register("r5_recommendations", sql=with_c360(f"""
SELECT 1 AS rule, 'missing_values' AS "check", '{P.REC_MISSING}' AS recommendation
FROM c360_dirty HAVING ({_NULL_COUNTS}) * 100.0 / (count(*) * 14) > 5
UNION ALL
SELECT 2, 'class_imbalance', '{P.REC_IMBALANCE}'
FROM (SELECT count(*) AS c FROM c360_dirty GROUP BY churn) HAVING count(*) = 2 AND max(c) * 1.0 / min(c) > 1.5
UNION ALL
SELECT 3, 'multicollinearity', '{P.REC_MULTICOLLINEARITY}'
FROM c360_dirty HAVING abs(corr(senior, tenure)) > 0.7 OR abs(corr(senior, monthly_charges)) > 0.7
   OR abs(corr(tenure, monthly_charges)) > 0.7
"""))
def q_recs(spark, sf):
    """R5 rules over the dirty table's profile."""
    return P.recommendations(customer_360_dirty(spark, sf), R)
