"""Catalogued queries: model-based selection (L7-L11), interpretation
(P2-P3), isolation-forest flag (O5), iterative imputation (I5).  Training is
stochastic, so these carry no oracle (rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.ml import explain as P
from featureforge.ml import models as M
from featureforge.ml import selection as L
from featureforge.ml.isolation import IsolationForestFlag
from featureforge.ml.iterative import iterative_impute
from featureforge.operators import select as LS
from featureforge.operators.split import row_sample
from featureforge.plans.catalog.models import _split
from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360_dirty

@register("l7_rfe", digits=None)
def q_rfe(spark, sf):
    """Forest RFE down to 10 of all 20 features."""
    train, _ = _split(spark, sf)
    return L.rfe(train, FEATURES, 10, step=1, trees=30)


@register("l8_rfe_cv", digits=None)
def q_rfe_cv(spark, sf):
    """CV AUC per RFE subset size of all 20 features (3 folds, step 5)."""
    train, _ = _split(spark, sf)
    return L.rfe_cv(train, FEATURES, "fold", 3, step=5, trees=10)


@register("l9_select_from_model", digits=None)
def q_sfm(spark, sf):
    """Forest importance >= mean, and lasso |coef| >= median."""
    train, _ = _split(spark, sf)
    rf = L.select_from_model(train, FEATURES, "random_forest", "mean").withColumn("estimator", F.lit("random_forest"))
    la = L.select_from_model(train, FEATURES, "lasso", "median").withColumn("estimator", F.lit("lasso"))
    return rf.unionByName(la)


@register("l10_stability_selection", digits=None)
def q_stab(spark, sf):
    """20 bootstrap forests (80 %) on all features, median-vote frequency >= 0.6."""
    train, _ = _split(spark, sf)
    return L.stability_selection(train, FEATURES, n_bootstrap=20, trees=20)


def _l11_sql():
    from featureforge.plans.catalog.select import _fm_sql
    return _fm_sql("""
SELECT feature, CAST(count(DISTINCT method) AS BIGINT) AS votes, round(count(DISTINCT method) / 3.0e0, 6) AS vote_share,
       count(DISTINCT method) / 3.0e0 >= 0.5 AS selected
FROM (SELECT 'variance' AS method, feature FROM long GROUP BY feature HAVING var_pop(x) > 0.01
      UNION ALL SELECT 'f_classif', feature FROM fsel WHERE rank <= 10
      UNION ALL SELECT 'mutual_info', feature FROM misel WHERE rank <= 10)
GROUP BY feature
""", extra="""
fstat AS (SELECT feature, CASE WHEN sum(n * v) > 0 THEN (sum(n * (m - gm) * (m - gm)) / (max(n_groups) - 1))
                    / (sum(n * v) / (max(n_total) - max(n_groups))) END AS score
    FROM (SELECT *, sum(n) OVER w AS n_total, count(*) OVER w AS n_groups,
                 sum(n * m) OVER w / sum(n) OVER w AS gm
          FROM (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long
                WHERE x IS NOT NULL GROUP BY feature, y)
          WINDOW w AS (PARTITION BY feature))
    GROUP BY feature),
fsel AS (SELECT feature, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rank FROM fstat),
edges AS (SELECT feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
          FROM long GROUP BY feature),
mi AS (SELECT feature, sum(n * 1.0 / n_total * ln(n * n_total * 1.0 / (n_bin * n_class))) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY feature) AS n_total, sum(n) OVER (PARTITION BY feature, bin) AS n_bin,
         sum(n) OVER (PARTITION BY feature, y) AS n_class FROM (
    SELECT l.feature, (SELECT count(*) FROM unnest(e.edges) t(v) WHERE l.x > t.v) AS bin, l.y, count(*) AS n
    FROM long l JOIN edges e USING (feature) WHERE l.x IS NOT NULL GROUP BY 1, 2, 3))
  GROUP BY feature),
misel AS (SELECT feature, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rank FROM mi)""")


@register("l11_ensemble_selection", sql=_l11_sql())
def q_ens_sel(spark, sf):
    """Votes of variance (> 0.01), ANOVA-F top 10 and MI top 10; kept at >= 50 %."""
    fm = churn_features(spark, sf)
    v = LS.variance_scores(fm, FEATURES).where("selected").select(F.lit("variance").alias("method"), "feature")
    f = LS.rank_scores(LS.anova_f(fm, FEATURES, "label"), 10).where("selected").select(
        F.lit("f_classif").alias("method"), "feature")
    mi = LS.rank_scores(LS.mutual_info(fm, FEATURES, "label"), 10).where("selected").select(
        F.lit("mutual_info").alias("method"), "feature")
    return LS.ensemble_vote(v.unionByName(f).unionByName(mi), 3, 0.5)


@register("p2_linear_global_importance", digits=None)
def q_p2_lin(spark, sf):
    """P2 (linear, exact given the fit): mean |beta (x - mean)| on test rows."""
    train, test = _split(spark, sf)
    m = M.make_pipeline("logistic_regression", FEATURES).fit(train)
    return P.linear_global_importance(m, test, FEATURES)


@register("p2_tree_global_importance", digits=None)
def q_p2_tree(spark, sf):
    """P2 (trees, exact given the fit): mean absolute Shapley value on the test rows of a boosted model."""
    from featureforge.ml.treeshap import tree_global_importance
    train, test = _split(spark, sf)
    m = M.make_pipeline("lightgbm", FEATURES, n_estimators=10).fit(train)
    return tree_global_importance(m, test, FEATURES)


@register("p2_tree_local_values", digits=None)
def q_p2_values(spark, sf):
    """P2 (trees): Shapley values of every test row under a random forest; they
    and the base add up to its probability."""
    from featureforge.ml.treeshap import explain_trees
    train, test = _split(spark, sf)
    m = M.make_pipeline("random_forest", FEATURES, n_estimators=10, max_depth=6).fit(train)
    told, base = explain_trees(m, test, FEATURES)
    sums = told.groupBy("id").agg(F.sum("value").alias("total"))
    return M.predictions(m, test, "random_forest").join(sums, "id").select(
        "id", "p1", (F.lit(base) + F.col("total")).alias("explained"))


@register("p2_permutation_importance", digits=None)
def q_p2_perm(spark, sf):
    """P2 (any model): AUC drop of a decision tree under bucketed permutation."""
    train, test = _split(spark, sf)
    m = M.make_pipeline("decision_tree", FEATURES).fit(train)
    return P.permutation_importance(m, test, FEATURES, "decision_tree", "id")


@register("p3_local_explanations", digits=None)
def q_p3(spark, sf):
    """LIME-style explanations of 5 sampled test rows, top 10 weights."""
    train, test = _split(spark, sf)
    m = M.make_pipeline("logistic_regression", FEATURES).fit(train)
    rows = row_sample(test, "id", 5, 42)
    return P.local_explanations(m, rows, train, FEATURES, "logistic_regression", "id")


@register("o5_isolation_forest_flag", digits=None)
def q_o5(spark, sf):
    """Isolation forest (100 trees, contamination 0.1) on customer numerics."""
    fm = churn_features(spark, sf)
    feats = ["tenure", "monthly_charges", "total_charges", "CLV_estimate"]
    model = IsolationForestFlag(feats, "customer_id", n_trees=100, contamination=0.1).fit(fm)
    return model.transform(fm.select("customer_id", *feats)).select("customer_id", "outlier_score", "is_outlier")


@register("i5_iterative_impute", digits=None)
def q_i5(spark, sf):
    """Round-robin ridge imputation of the dirty numerics (max 10 rounds)."""
    d = customer_360_dirty(spark, sf)
    d = d.select(R.id, F.col("senior").cast("double").alias("senior"), F.col("tenure").cast("double").alias("tenure"),
                 "monthly_charges", F.trim("total_charges").try_cast("double").alias("total_charges"))
    return iterative_impute(d, ["senior", "tenure", "monthly_charges", "total_charges"], max_iter=10)
