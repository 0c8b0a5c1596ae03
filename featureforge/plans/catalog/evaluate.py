"""Catalogued queries: splits (T1-T5) and evaluation (V1-V20) on
deterministic scores (no training): the monthly-charge score of the test
fixtures, a tenure score and their average act as three 'models'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureforge.functions.exprs import is_value
from featureforge.operators import evaluate as V
from featureforge.operators import split as T
from featureforge.plans.catalog.sqlgen import round_all
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, table, with_c360

MODELS = ("logistic_baseline", "random_forest_optimized", "voting_ensemble")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """(model, id, label, prediction, p1, monthly) for the three score rules
    (a derived table shared by the evaluation reports of a session)."""
    import os
    from featureforge.sources.tables import shared
    return shared(spark, ("scored", os.path.abspath(sf)), lambda: _scored(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    c = customer_360(spark, sf)
    st = c.agg(F.avg("monthly_charges").alias("mm"), F.stddev_pop("monthly_charges").alias("ms"),
               F.avg("tenure").alias("tm"), F.stddev_pop("tenure").alias("ts"))
    j = c.crossJoin(F.broadcast(st))

    def clip4(e):
        return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), e)), 4)
    pa = clip4(0.5 + (F.col("monthly_charges") - F.col("mm")) / (4 * F.col("ms")))
    pb = clip4(0.5 - (F.col("tenure") - F.col("tm")) / (4 * F.col("ts")))
    base = j.select(F.col(R.id).alias("id"), is_value(R.target, R.positive).alias("label"),
                    F.col("monthly_charges").alias("monthly"), pa.alias("pa"), pb.alias("pb"))
    out = base.select("id", "label", "monthly", F.inline(F.array(
        F.struct(F.lit(MODELS[0]).alias("model"), F.col("pa").alias("p1")),
        F.struct(F.lit(MODELS[1]).alias("model"), F.col("pb").alias("p1")),
        F.struct(F.lit(MODELS[2]).alias("model"), ((F.col("pa") + F.col("pb")) / 2).alias("p1")))))
    return out.withColumn("prediction", (F.col("p1") >= 0.5).cast("int"))


def one_model(spark, sf):
    return scored(spark, sf).where(F.col("model") == MODELS[0]).drop("model")


SCORED_CTE = f"""
st AS (SELECT avg(monthly_charges) AS mm, stddev_pop(monthly_charges) AS ms,
              avg(tenure) AS tm, stddev_pop(tenure) AS ts FROM c360),
base AS (
  SELECT customer_id AS id, CAST(churn = 'Yes' AS INTEGER) AS label, monthly_charges AS monthly,
         round(least(1.0, greatest(0.0, 0.5 + (monthly_charges - mm) / (4 * ms))), 4) AS pa,
         round(least(1.0, greatest(0.0, 0.5 - (tenure - tm) / (4 * ts))), 4) AS pb
  FROM c360 CROSS JOIN st),
scored AS (
  SELECT '{MODELS[0]}' AS model, id, label, monthly, pa AS p1 FROM base
  UNION ALL SELECT '{MODELS[1]}', id, label, monthly, pb FROM base
  UNION ALL SELECT '{MODELS[2]}', id, label, monthly, (pa + pb) / 2 FROM base),
pred AS (SELECT *, CAST(p1 >= 0.5 AS INTEGER) AS prediction FROM scored),
one AS (SELECT * FROM pred WHERE model = '{MODELS[0]}')
"""


def ev_sql(select: str, extra: str = "") -> str:
    return with_c360(select, extra_ctes=SCORED_CTE + ("," + extra if extra else ""))


# ------------------------------------------------------------------ T
_RANK_CTE = """
rk AS (SELECT customer_id, churn,
              row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(customer_id AS VARCHAR) || '-42'), customer_id) AS r,
              count(*) OVER (PARTITION BY churn) AS n
       FROM c360)
"""


@register("t1_stratified_split", sql=with_c360("""
SELECT customer_id, CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM rk
""", extra_ctes=_RANK_CTE))
def q_t1(spark, sf):
    """Exact stratified 80/20 split by hash rank (seed 42)."""
    c = customer_360(spark, sf).select(R.id, R.target)
    return T.train_test_split(c, R.id, R.target, 0.2, 42).select(R.id, "split")


@register("t2_train_val_test_split", sql=with_c360("""
SELECT customer_id,
  CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test'
       WHEN r <= floor(n * 0.2 + 0.5) + floor((n - floor(n * 0.2 + 0.5)) * 0.25 + 0.5) THEN 'val'
       ELSE 'train' END AS split FROM rk
""", extra_ctes=_RANK_CTE))
def q_t2(spark, sf):
    c = customer_360(spark, sf).select(R.id, R.target)
    return T.train_val_test_split(c, R.id, R.target, 0.2, 0.2, 42).select(R.id, "split")


@register("t3_stratified_kfold", sql=with_c360("""
SELECT customer_id, CAST((r - 1) % 5 AS INTEGER) AS fold FROM rk
""", extra_ctes=_RANK_CTE))
def q_t3(spark, sf):
    c = customer_360(spark, sf).select(R.id, R.target)
    return T.stratified_kfold(c, R.id, R.target, 5, 42).select(R.id, "fold")


@register("t4_random_split", sql="""
SELECT c_custkey, CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT c_custkey, row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR) || '-7'), c_custkey) AS r,
             count(*) OVER () AS n FROM customer)
""")
def q_t4(spark, sf):
    """T4 random (unstratified) split of ``customer`` with seed 7."""
    cu = table(spark, sf, "customer").select("c_custkey")
    return T.random_split(cu, "c_custkey", 0.2, 7).select("c_custkey", "split")


@register("t4_time_split", sql="""
SELECT event_id, CASE WHEN r <= n - floor(n * 0.2 + 0.5) THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, row_number() OVER (ORDER BY ts NULLS LAST, event_id) AS r, count(*) OVER () AS n FROM events)
""")
def q_t4_time(spark, sf):
    """T4 time split of ``events``: the latest 20 % (by ts, event_id) is test."""
    ev = table(spark, sf, "events").select("event_id", "ts")
    return T.time_split(ev, "ts", "event_id", 0.2).select("event_id", "split")


@register("t5_row_sample", sql="""
SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || '-42'), c_custkey LIMIT 100
""")
def q_t5(spark, sf):
    """T5: 100 customers without replacement (the sample size is the feature)."""
    cu = table(spark, sf, "customer").select("c_custkey", "c_name")
    return T.row_sample(cu, "c_custkey", 100, 42)


# ------------------------------------------------------------------ V
_CM_SQL = """
SELECT {keys}tp, tn, fp, fn, n,
  coalesce((tp + tn) * 1.0e0 / nullif(n, 0), 0) AS accuracy,
  coalesce(tp * 1.0e0 / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp * 1.0e0 / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2.0e0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_score,
  coalesce(tn * 1.0e0 / nullif(tn + fp, 0), 0) AS specificity,
  coalesce(tp * 1.0e0 / nullif(tp + fn, 0), 0) AS sensitivity,
  (coalesce(tp * 1.0e0 / nullif(tp + fn, 0), 0) + coalesce(tn * 1.0e0 / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
  coalesce((tp * 1.0e0 * tn - fp * 1.0e0 * fn) / nullif(sqrt((tp + fp) * 1.0e0 * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)
    AS matthews_corr_coef,
  brier_score, log_loss,
  fp * 50.0e0 + fn * 500.0e0 AS total_cost,
  coalesce((fp * 50.0e0 + fn * 500.0e0) / nullif(n, 0), 0) AS cost_per_customer,
  tp * 1200.0e0 AS revenue_saved, fn * 1200.0e0 AS revenue_lost,
  coalesce(tp * 1.0e0 / nullif(tp + fn, 0), 0) AS churn_detection_rate,
  coalesce(fp * 1.0e0 / nullif(fp + tn, 0), 0) AS false_alarm_rate,
  coalesce((tp * 1200.0e0 - (tp + fp) * 50.0e0) / nullif((tp + fp) * 50.0e0, 0), 0) * 100 AS roi_percentage,
  tp * 1200.0e0 - (tp + fp) * 50.0e0 AS net_benefit,
  coalesce(tp * 1.0e0 / nullif(tp + fp, 0), 0) AS precision_in_targeting,
  coalesce((tp - fp) * 1.0e0 / nullif(tp + fn, 0), 0) AS cost_savings_ratio
FROM (SELECT {keys}count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
             count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) AS n,
             avg((p1 - label) * (p1 - label)) AS brier_score,
             avg(-(label * ln(least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                   + (1 - label) * ln(1 - least(greatest(p1, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))
               AS log_loss
      FROM {src} {group})
"""


@register("v1_v10_classification_metrics", sql=ev_sql(
    "SELECT round(COLUMNS(*), 6) FROM (" + _CM_SQL.format(keys="", src="one", group="") + ")"))
def q_cm(spark, sf):
    """V1 confusion, V2 accuracy/precision/recall/F1, V4 log loss, V5, V7
    MCC, V8 Brier, V9 cost model, V10 detection/targeting ratios."""
    return V.classification_metrics(one_model(spark, sf))


_HIST = """
hist AS (SELECT model, p1 AS score, sum(label) AS pos, sum(1 - label) AS neg, count(*) AS cnt
         FROM pred GROUP BY model, p1),
asc_c AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg,
                 sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS Nn FROM hist),
desc_c AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cpos,
                  sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cneg,
                  sum(cnt) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ccnt,
                  sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS Nn FROM hist),
auc AS (SELECT model, sum(pos * (cneg - neg + 0.5 * neg)) / (max(P) * 1.0e0 * max(Nn)) AS roc_auc
        FROM asc_c GROUP BY model),
ap AS (SELECT model, sum(pos * (cpos * 1.0e0 / ccnt)) / max(P) AS precision_recall_auc FROM desc_c GROUP BY model),
rows_ranked AS (SELECT model, label, row_number() OVER (PARTITION BY model ORDER BY p1 DESC, id) AS r,
                       count(*) OVER (PARTITION BY model) AS n, sum(label) OVER (PARTITION BY model) AS P FROM pred),
gains AS (SELECT model, CAST(d.decile AS INTEGER) AS decile,
                 coalesce(sum(label) FILTER (WHERE r <= d.decile * (n // 10)) * 1.0e0 / nullif(max(P), 0), 0) AS gain
          FROM rows_ranked CROSS JOIN (SELECT unnest(range(1, 11)) AS decile) d GROUP BY model, d.decile)
"""


@register("v3_v13_roc_auc_gini", sql=ev_sql(
    "SELECT model, round(roc_auc, 6) AS roc_auc, round(2 * roc_auc - 1, 6) AS gini_coefficient FROM auc",
    extra=_HIST))
def q_auc(spark, sf):
    """V3 AUC (ties = 1/2) and V13 Gini for the three models in one job."""
    p = scored(spark, sf)
    return V.roc_auc(V.score_histogram(p, ["model"]), ["model"])


@register("v6_average_precision", sql=ev_sql(
    "SELECT model, round(precision_recall_auc, 6) AS precision_recall_auc FROM ap", extra=_HIST))
def q_ap(spark, sf):
    p = scored(spark, sf)
    return V.average_precision(V.score_histogram(p, ["model"]), ["model"])


@register("v11_cumulative_gains", sql=ev_sql("SELECT model, decile, round(gain, 6) AS gain FROM gains",
                                             extra=_HIST))
def q_gains(spark, sf):
    """Gains by decile, rows ordered (score desc, id asc)."""
    p = scored(spark, sf)
    return V.cumulative_gains(p, V.score_histogram(p, ["model"]), ["model"])


@register("v12_lift_summary", sql=ev_sql("""
SELECT model, round(coalesce(max(CASE WHEN decile = 1 THEN gain * 10 END), 0), 6) AS top_decile_lift,
       round(coalesce(max(CASE WHEN decile = 2 THEN gain END), 0), 6) AS top_quintile_gain
FROM gains GROUP BY model""", extra=_HIST))
def q_lift(spark, sf):
    p = scored(spark, sf)
    return V.lift_summary(V.cumulative_gains(p, V.score_histogram(p, ["model"]), ["model"]), ["model"])


@register("v14_revenue_metrics", sql=ev_sql("""
SELECT model, round(coalesce(sum(monthly) FILTER (WHERE label = 1), 0), 2) AS total_revenue_at_risk,
       round(coalesce(sum(monthly) FILTER (WHERE label = 1 AND prediction = 1), 0), 2) AS revenue_potentially_saved,
       round(coalesce(sum(monthly) FILTER (WHERE label = 0 AND prediction = 1), 0), 2) AS false_alarm_cost,
       round(CASE WHEN coalesce(sum(monthly) FILTER (WHERE label = 1), 0) > 0
                  THEN coalesce(sum(monthly) FILTER (WHERE label = 1 AND prediction = 1), 0)
                       / sum(monthly) FILTER (WHERE label = 1) ELSE 0 END, 6) AS revenue_capture_rate
FROM pred GROUP BY model"""), digits={"*": 6, "total_revenue_at_risk": 2, "revenue_potentially_saved": 2,
                                      "false_alarm_cost": 2})
def q_revenue(spark, sf):
    """Revenue at risk / saved / false-alarm cost by monthly charge."""
    return V.revenue_metrics(scored(spark, sf), "monthly", ["model"])


@register("v15_roc_curve", sql=ev_sql("""
SELECT model, round(score, 6) AS threshold, round(cneg * 1.0e0 / Nn, 6) AS fpr, round(cpos * 1.0e0 / P, 6) AS tpr FROM desc_c
""", extra=_HIST))
def q_roc(spark, sf):
    p = scored(spark, sf)
    return V.roc_curve(V.score_histogram(p, ["model"]), ["model"])


@register("v16_per_class_report", sql=ev_sql(round_all("""
SELECT model, c AS class,
  coalesce(count(*) FILTER (WHERE label = c AND prediction = c) * 1.0e0 / nullif(count(*) FILTER (WHERE prediction = c), 0), 0) AS precision,
  coalesce(count(*) FILTER (WHERE label = c AND prediction = c) * 1.0e0 / nullif(count(*) FILTER (WHERE label = c), 0), 0) AS recall,
  coalesce(2.0e0 * count(*) FILTER (WHERE label = c AND prediction = c)
           / nullif(count(*) FILTER (WHERE prediction = c) + count(*) FILTER (WHERE label = c), 0), 0) AS f1_score,
  count(*) FILTER (WHERE label = c) AS support
FROM pred CROSS JOIN (SELECT 0 AS c UNION ALL SELECT 1) k GROUP BY model, c""", ["model", "class"])))
def q_class_report(spark, sf):
    return V.per_class_report(scored(spark, sf), ["model"])


@register("v17_ks_statistic", sql=ev_sql(
    "SELECT model, round(max(cpos * 1.0e0 / P - cneg * 1.0e0 / Nn), 6) AS ks FROM desc_c GROUP BY model",
    extra=_HIST))
def q_ks(spark, sf):
    p = scored(spark, sf)
    return V.ks_statistic(V.score_histogram(p, ["model"]), ["model"])


@register("v17_calibration_deciles", sql=ev_sql("""
SELECT model, decile, CAST(sum(cnt) AS BIGINT) AS n, round(sum(score * cnt) / sum(cnt), 6) AS mean_score,
       round(sum(pos) * 1.0e0 / sum(cnt), 6) AS observed_rate
FROM (SELECT *, CAST(least(floor((cc - cnt) * 10 / total), 9) AS INTEGER) + 1 AS decile
      FROM (SELECT *, sum(cnt) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cc,
                   sum(cnt) OVER (PARTITION BY model) AS total FROM hist))
GROUP BY model, decile""", extra=_HIST))
def q_calib(spark, sf):
    p = scored(spark, sf)
    return V.calibration_by_decile(V.score_histogram(p, ["model"]), ["model"])


_ALL_SQL_CTE = _HIST + """,
cm AS (""" + _CM_SQL.format(keys="model, ", src="pred", group="GROUP BY model") + """),
lift AS (SELECT model, coalesce(max(CASE WHEN decile = 1 THEN gain * 10 END), 0) AS top_decile_lift,
                coalesce(max(CASE WHEN decile = 2 THEN gain END), 0) AS top_quintile_gain FROM gains GROUP BY model),
wide AS (SELECT cm.*, auc.roc_auc, 2 * auc.roc_auc - 1 AS gini_coefficient, ap.precision_recall_auc,
                lift.top_decile_lift, lift.top_quintile_gain
         FROM cm JOIN auc USING (model) JOIN ap USING (model) JOIN lift USING (model)),
long AS (SELECT model, metric, round(CAST(value AS DOUBLE), 6) AS value FROM (UNPIVOT (SELECT model, """ + ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}" for m in V._LONG_METRICS) + """ FROM wide)
         ON """ + ", ".join(V._LONG_METRICS) + """ INTO NAME metric VALUE value))
"""


@register("v18_evaluate_all", sql=ev_sql("SELECT * FROM long", extra=_ALL_SQL_CTE))
def q_eval_all(spark, sf):
    """(model, metric, value) for all models, metric families grouped by model."""
    return V.evaluate_all(scored(spark, sf))


@register("v19_best_model", sql=ev_sql(
    "SELECT model, 'roc_auc' AS metric, value FROM long WHERE metric = 'roc_auc' ORDER BY value DESC, model LIMIT 1",
    extra=_ALL_SQL_CTE))
def q_best(spark, sf):
    return V.best_model(V.evaluate_all(scored(spark, sf)), "roc_auc")


@register("v20_comparison_table", sql=ev_sql("""
SELECT CASE model WHEN 'logistic_baseline' THEN 'Logistic Baseline'
                  WHEN 'random_forest_optimized' THEN 'Random Forest Optimized'
                  ELSE 'Voting Ensemble' END AS Model,
       CASE WHEN model LIKE '%optimized%' THEN 'Optimized' WHEN model LIKE '%ensemble%' THEN 'Ensemble'
            ELSE 'Baseline' END AS Type,
       max(value) FILTER (WHERE metric = 'roc_auc') AS AUC, max(value) FILTER (WHERE metric = 'precision') AS Precision,
       max(value) FILTER (WHERE metric = 'recall') AS Recall, max(value) FILTER (WHERE metric = 'f1_score') AS F1_Score,
       max(value) FILTER (WHERE metric = 'accuracy') AS Accuracy,
       max(value) FILTER (WHERE metric = 'specificity') AS Specificity,
       max(value) FILTER (WHERE metric = 'log_loss') AS Log_Loss,
       max(value) FILTER (WHERE metric = 'tp') AS True_Positives, max(value) FILTER (WHERE metric = 'fp') AS False_Positives,
       max(value) FILTER (WHERE metric = 'tn') AS True_Negatives, max(value) FILTER (WHERE metric = 'fn') AS False_Negatives
FROM long GROUP BY model""", extra=_ALL_SQL_CTE))
def q_compare(spark, sf):
    return V.comparison_table(V.evaluate_all(scored(spark, sf)))
