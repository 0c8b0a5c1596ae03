"""Catalogued queries: feature selection (L) and feature reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.functions.exprs import sig_round
from featureforge.operators import features as X
from featureforge.operators import report as RP
from featureforge.operators import select as L
from featureforge.plans.catalog.features import FM_CTE
from featureforge.plans.catalog.sqlgen import sig_sql
from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, with_c360

_ON = ", ".join(FEATURES)
_LONG = f"long AS (SELECT feature, x, label AS y FROM (UNPIVOT fm ON {_ON} INTO NAME feature VALUE x))"


def _fm_sql(select, extra=""):
    ctes = FM_CTE + ",\n" + _LONG + ("," + extra if extra else "")
    return with_c360(select, extra_ctes=ctes)


@register("l1_variance_scores", digits={"variance": None}, sql=_fm_sql(f"""
SELECT feature, {sig_sql('var_pop(x)')} AS variance, coalesce(var_pop(x) > 0.01, false) AS selected
FROM long GROUP BY feature
"""))
def q_var(spark, sf):
    """L1: population variance per feature, threshold 0.01 (6 significant digits)."""
    out = L.variance_scores(churn_features(spark, sf), FEATURES, 0.01)
    return out.withColumn("variance", sig_round("variance"))


def _corr_removal_sql(threshold):
    pairs = []
    for j, b in enumerate(FEATURES):
        if j == 0:
            pairs.append(f"SELECT '{b}' AS feature, CAST(NULL AS DOUBLE) AS max_abs_corr")
            continue
        terms = ", ".join(f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN abs(corr({a}, {b})) END"
                          for a in FEATURES[:j])
        pairs.append(f"SELECT '{b}' AS feature, round(greatest({terms}), 6) AS max_abs_corr FROM fm")
    body = " UNION ALL ".join(pairs)
    return _fm_sql(f"SELECT feature, max_abs_corr, coalesce(max_abs_corr > {threshold}, false) AS removed FROM ({body})")


@register("l2_correlation_filter", sql=_corr_removal_sql(0.95))
def q_corr_filter(spark, sf):
    """L2: drop a feature if any EARLIER feature has |r| > 0.95 with it."""
    return L.correlation_removals(churn_features(spark, sf), FEATURES, 0.95)


@register("l3_anova_f_topk", sql=_fm_sql("""
SELECT feature, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank, rank <= 10 AS selected FROM (
  SELECT feature, score, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rank FROM (
    SELECT feature, CASE WHEN sum(n * v) > 0 THEN (sum(n * (m - gm) * (m - gm)) / (max(n_groups) - 1))
                    / (sum(n * v) / (max(n_total) - max(n_groups))) END AS score
    FROM (SELECT *, sum(n) OVER w AS n_total, count(*) OVER w AS n_groups,
                 sum(n * m) OVER w / sum(n) OVER w AS gm
          FROM (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long
                WHERE x IS NOT NULL GROUP BY feature, y)
          WINDOW w AS (PARTITION BY feature))
    GROUP BY feature))
"""))
def q_anova(spark, sf):
    """L3: one-way ANOVA F per feature, top 10 selected."""
    fm = churn_features(spark, sf)
    return L.rank_scores(L.anova_f(fm, FEATURES, "label"), 10)


@register("l4_chi2_topk", digits={"score": None}, sql=_fm_sql(f"""
SELECT feature, {sig_sql('score')} AS score, CAST(rank AS INTEGER) AS rank, rank <= 10 AS selected FROM (
  SELECT feature, score, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rank FROM (
    SELECT feature, sum((s - e) * (s - e) / e) AS score FROM (
      SELECT *, n / sum(n) OVER w * sum(s) OVER w AS e FROM (
        SELECT feature, y, n, s - n * (min(mn) OVER (PARTITION BY feature) - 1e-8) AS s FROM (
          SELECT feature, y, count(*) AS n, sum(x) AS s, min(x) AS mn FROM long GROUP BY feature, y))
      WINDOW w AS (PARTITION BY feature))
    GROUP BY feature))
"""))
def q_chi2(spark, sf):
    """L4: chi-square on shifted (x - min + 1e-8) features, top 10 (6 significant digits)."""
    fm = churn_features(spark, sf)
    ranked = L.rank_scores(L.chi2_scores(fm, FEATURES, "label"), 10)
    return ranked.withColumn("score", sig_round("score"))


@register("l5_l6_mutual_info", sql=_fm_sql("""
SELECT feature, round(sum(n * 1.0 / n_total * ln(n * n_total * 1.0 / (n_bin * n_class))), 6) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY feature) AS n_total, sum(n) OVER (PARTITION BY feature, bin) AS n_bin,
         sum(n) OVER (PARTITION BY feature, y) AS n_class FROM (
    SELECT l.feature, (SELECT count(*) FROM unnest(e.edges) t(v) WHERE l.x > t.v) AS bin, l.y, count(*) AS n
    FROM long l JOIN edges e USING (feature) WHERE l.x IS NOT NULL GROUP BY 1, 2, 3))
GROUP BY feature
""", extra=f"""
edges AS (SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
          FROM long GROUP BY feature)"""))
def q_mi(spark, sf):
    """L5 (re-aimed, exact): plug-in MI over exact decile bins; L6 picks it
    for mixed inputs (here called directly)."""
    return L.mutual_info(churn_features(spark, sf), FEATURES, "label", 10)


@register("l12_selection_report")
def q_sel_report(spark, sf):
    """Correlation -> variance -> univariate (F) report rows."""
    fm = churn_features(spark, sf)
    model = L.FeatureSelector("label", FEATURES, methods=["correlation", "variance", "univariate"],
                              k=10).fit(fm)
    return model.report(spark).withColumn("score", sig_round("score"))


# ------------------------------------------------------------------ R1-R4
_BIZ_NEW = ["CLV_estimate", "CLV_per_month", "ARPU", "total_services", "premium_services",
            "service_adoption_rate", "contract_risk_score", "payment_risk_score", "is_new_customer",
            "is_loyal_customer", "above_avg_charges", "has_internet", "fiber_optic_user",
            "phone_service_complexity", "family_score", "customer_value_score"]
_BIZ_NUM = ["customer_id", "senior", "tenure", "monthly_charges", "total_charges"] + _BIZ_NEW


@register("r1_feature_report", sql=with_c360(
    "SELECT 14 AS original_features, 33 AS final_features, 19 AS features_added, "
    "21 AS numeric_features, 12 AS categorical_features, "
    + " + ".join(f"CAST(count(DISTINCT {c}) = 2 AS INTEGER)" for c in _BIZ_NUM)
    + " AS binary_features FROM biz", extra_ctes=__import__(
        "featureforge.plans.catalog.features", fromlist=["BIZ_CTE"]).BIZ_CTE))
def q_feat_report(spark, sf):
    c = customer_360(spark, sf)
    return RP.feature_report(c, X.business_features(c, R))


@register("r2_importance_preview", digits={"importance": None}, sql=with_c360(
    "SELECT feature, " + sig_sql("imp") + " AS importance FROM (UNPIVOT (SELECT "
    + ", ".join(f"var_samp(CAST({c} AS DOUBLE)) * (max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE))) AS {c}"
                for c in _BIZ_NUM)
    + " FROM biz) ON " + ", ".join(_BIZ_NUM) + " INTO NAME feature VALUE imp) "
    "WHERE imp IS NOT NULL ORDER BY imp DESC, feature LIMIT 10",
    extra_ctes=__import__("featureforge.plans.catalog.features", fromlist=["BIZ_CTE"]).BIZ_CTE))
def q_imp_preview(spark, sf):
    """R2: variance x range over the first 20 numeric columns, top 10."""
    c = customer_360(spark, sf)
    out = RP.importance_preview(X.business_features(c, R), 20, 10)
    return out.withColumn("importance", sig_round("importance"))


@register("r3_business_feature_variance", digits={"variance": None}, sql=with_c360(
    "SELECT feature, " + sig_sql("v") + " AS variance FROM (UNPIVOT (SELECT "
    + ", ".join(f"var_samp(CAST({c} AS DOUBLE)) AS {c}" for c in _BIZ_NEW)
    + " FROM biz) ON " + ", ".join(_BIZ_NEW) + " INTO NAME feature VALUE v)",
    extra_ctes=__import__("featureforge.plans.catalog.features", fromlist=["BIZ_CTE"]).BIZ_CTE))
def q_biz_var(spark, sf):
    c = customer_360(spark, sf)
    out = RP.feature_variance(X.business_features(c, R), _BIZ_NEW)
    return out.withColumn("variance", sig_round("variance"))


@register("r4_before_after_quality", sql=with_c360("""
SELECT 'before' AS stage, CAST(""" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in [
    "customer_id", "senior", "partner", "dependents", "tenure", "svc_online_urgent", "svc_streaming_low",
    "svc_device_final", "svc_tech_pending", "contract", "payment", "monthly_charges", "total_charges", "churn"])
    + """ AS BIGINT) AS missing_cells, 4 AS numeric_columns,
       CASE WHEN count(*) FILTER (WHERE tenure IS NULL OR contract IS NULL OR monthly_charges IS NULL) = 0
            THEN 'clean' ELSE 'has_missing' END AS status FROM c360_dirty
UNION ALL
SELECT 'after', CAST(0 AS BIGINT), 4, 'clean' FROM (SELECT count(*) FROM c360_dirty)
"""))
def q_quality(spark, sf):
    """Missing cells / numeric columns before and after median+mode
    imputation of the dirty table."""
    from featureforge.operators.impute import Imputer
    from featureforge.sources.tables import customer_360_dirty
    d = customer_360_dirty(spark, sf)
    after = Imputer("median", "mode", exclude=[R.id, R.target]).fit(d).transform(d)
    return RP.before_after_quality(d, after)
