"""Catalogued queries: models (M), interpretation (P), scoring (D).

Training is stochastic or numerically different from any SQL engine, so the
model queries carry no oracle (rows-only check); the scoring queries D1-D3
run on the deterministic fixture scores and are oracle-checked.  Model sizes
are kept small (the catalogue checks behaviour, the bench measures scale).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from featureforge.ml import models as M
from featureforge.operators import split as T
from featureforge.plans.catalog.evaluate import MODELS, SCORED_CTE, scored
from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.registry import register
from featureforge.session import scratch_path
from featureforge.sources.tables import shared, with_c360
from featureforge.streaming import score as D


def _split(spark, sf):
    """Train and test rows with folds; the assembled frame is persisted once per
    session, since every fit of the model queries reads it."""
    sp = shared(spark, ("model_rows", os.path.abspath(sf)), lambda: _model_rows(spark, sf))
    return sp.where("split = 'train'"), sp.where("split = 'test'")


def _model_rows(spark, sf):
    fm = churn_features(spark, sf).withColumnRenamed("customer_id", "id")
    sp = T.train_test_split(fm, "id", "label", 0.2, 42)
    folds = T.stratified_kfold(fm.select("id", "label"), "id", "label", 3, 42).select("id", "fold")
    return M.for_fits(sp.join(folds, "id"), fm.count())


@register("m1_m11_baseline_models", digits=None)
def q_baselines(spark, sf):
    """M11 over all default base models (M1-M5, M7, M9, M10; boosting stops early on the
    scored rows, M12): fit on train, metrics on test, training time, errors."""
    train, test = _split(spark, sf)
    _, status = M.train_baselines(train, test, FEATURES, M.BASE_MODELS, parallelism=4)
    return status


@register("m3_m4_m5_m12_boosted_trees", digits=None)
def q_boosted(spark, sf):
    """M3-M5 with M12 early stopping on a validation fold, 30 rounds at most; the
    three growth strategies are fitted side by side; test AUC of each."""
    from concurrent.futures import ThreadPoolExecutor

    from featureforge.operators import evaluate as V
    train, test = _split(spark, sf)
    tv = train.withColumn("is_valid", F.col("fold") == 0)
    with ThreadPoolExecutor(max_workers=3) as pool:
        models = list(pool.map(lambda kind: M.fit_with_early_stopping(tv, FEATURES, kind, rounds=5, n_estimators=30), M.BOOSTED))
    preds = None
    for kind, model in zip(M.BOOSTED, models):
        p = M.predictions(model, test, kind)
        preds = p if preds is None else preds.unionByName(p)
    auc = V.auc_by_key(preds, "model")
    return spark.createDataFrame([(k, x, None if x is None else 2 * x - 1) for k, x in auc.items()],
                                 "model string, roc_auc double, gini_coefficient double")


_RAW = ("senior", "tenure", "monthly_charges", "total_charges")


@register("m3_first_split", sql=with_c360(f"""
SELECT feature, round(cut, 6) AS cut, missing_left, round(gain, 6) AS gain, round(-0.3 * gl / (0.25 * nl + 1), 6) AS left_weight,
       round(-0.3 * gr / (0.25 * nr + 1), 6) AS right_weight, nl AS left_rows, nr AS right_rows
FROM (SELECT *, 0.5 * (gl * gl / (0.25 * nl + 1) + gr * gr / (0.25 * nr + 1) - (gl + gr) * (gl + gr) / (0.25 * (nl + nr) + 1)) AS gain
      FROM (SELECT feature, k, cut, missing_left,
                   sum(CASE WHEN coalesce(x <= cut, missing_left) THEN g ELSE 0 END) AS gl,
                   sum(CASE WHEN coalesce(x <= cut, missing_left) THEN 0 ELSE g END) AS gr,
                   count(*) FILTER (WHERE coalesce(x <= cut, missing_left)) AS nl,
                   count(*) FILTER (WHERE NOT coalesce(x <= cut, missing_left)) AS nr
            FROM long JOIN cuts USING (feature) CROSS JOIN (VALUES (true), (false)) m(missing_left)
            GROUP BY feature, k, cut, missing_left))
WHERE nl >= 4 AND nr >= 4
ORDER BY gain DESC, k, cut, missing_left DESC LIMIT 1
""", extra_ctes=f"""
long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CASE WHEN churn = 'Yes' THEN -0.5e0 ELSE 0.5e0 END AS g FROM c360" for c in _RAW)}),
cuts AS (SELECT DISTINCT feature, k, cut FROM (
    {" UNION ALL ".join(f"SELECT '{c}' AS feature, {k} AS k, unnest(quantile_cont(CAST({c} AS DOUBLE), [i / 16.0e0 for i in range(1, 16)])) AS cut, max({c}) AS top FROM c360" for k, c in enumerate(_RAW))})
    WHERE cut < top)"""))
def q_first_split(spark, sf):
    """M3: the first split of a boosted model on four raw columns, its gain and
    leaf weights: closed forms of the summed gradients."""
    from featureforge.functions.exprs import is_value
    from featureforge.ml.boosting import BoostedTrees
    from featureforge.roles import CUSTOMER_360_ROLES as R
    from featureforge.sources.tables import customer_360
    rows = customer_360(spark, sf).select(F.col("customer_id").alias("id"), *_RAW, is_value(R.target, R.positive).alias("label"))
    model = BoostedTrees("xgboost", _RAW, n_estimators=1, max_depth=1, max_bins=16).fit(rows)
    (tree,) = model.trees
    split = spark.createDataFrame([(_RAW[tree.feature[0]], float(tree.threshold[0]), bool(tree.missing_left[0]), float(tree.gain[0]),
                                    float(tree.value[1]), float(tree.value[2]))],
                                  "feature string, cut double, missing_left boolean, gain double, left_weight double, right_weight double")
    x = F.col(_RAW[tree.feature[0]]).cast("double")
    left = F.coalesce(x <= tree.threshold[0], F.lit(bool(tree.missing_left[0])))
    counts = rows.agg(F.count_if(left).alias("left_rows"), F.count_if(~left).alias("right_rows"))
    return split.crossJoin(F.broadcast(counts))


@register("m3_m4_m5_training_loss", digits=None)
def q_boosting_loss(spark, sf):
    """M3-M5: training loss before each of 5 rounds and after the last."""
    train, _ = _split(spark, sf)
    rows = []
    for kind in M.BOOSTED:
        model = M.make_pipeline(kind, FEATURES, n_estimators=5).fit(train).stages[-1]
        rows += [(kind, i, float(loss)) for i, (loss, _) in enumerate(model.losses)]
    return spark.createDataFrame(rows, "model string, round int, log_loss double")


_CATS = ("contract", "payment")


@register("m5_ordered_target_stats", sql=with_c360(f"""
SELECT customer_id AS id, {", ".join(
    f"round((coalesce(sum(y) OVER (PARTITION BY {c} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + mean) / "
    f"(count(*) OVER (PARTITION BY {c} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1.0e0), 6) AS {c}_ots"
    for c in _CATS)}
FROM (SELECT *, CASE WHEN churn = 'Yes' THEN 1.0e0 ELSE 0.0e0 END AS y, md5(customer_id || '|42') AS place,
             (SELECT avg(CASE WHEN churn = 'Yes' THEN 1.0e0 ELSE 0.0e0 END) FROM c360) AS mean FROM c360)
"""))
def q_target_stats(spark, sf):
    """M5: categories as smoothed target means of the rows before each row."""
    from featureforge.functions.exprs import is_value
    from featureforge.ml.target_stats import ordered_target_stats
    from featureforge.roles import CUSTOMER_360_ROLES as R
    from featureforge.sources.tables import customer_360
    rows = customer_360(spark, sf).select(F.col("customer_id").alias("id"), *_CATS, is_value(R.target, R.positive).alias("label"))
    return ordered_target_stats(rows, list(_CATS)).select("id", *[f"{c}_ots" for c in _CATS])


@register("m5_boosting_with_categories", digits=None)
def q_categories(spark, sf):
    """M5 on raw columns and two categories, encoded by ordered target statistics; test probabilities."""
    from featureforge.sources.tables import customer_360
    train, test = _split(spark, sf)
    cats = customer_360(spark, sf).select(F.col("customer_id").alias("id"), *_CATS)
    model = M.make_pipeline("catboost", [*_RAW, *_CATS], cat_features=_CATS, n_estimators=20).fit(train.join(cats, "id"))
    return M.predictions(model, test.join(cats, "id"), "catboost")


@register("m6_svm_platt", digits=None)
def q_svm(spark, sf):
    """M6: linear SVM + Platt scaling; test-set probabilities."""
    train, test = _split(spark, sf)
    m = M.make_pipeline("svm", FEATURES).fit(train)
    return M.predictions(m, test, "svm")


@register("m13_tune_random_forest", digits=None)
def q_tune(spark, sf):
    """Seeded Parzen trials, AUC over the T3 folds."""
    train, _ = _split(spark, sf)
    _, trials, _ = M.tune(train, FEATURES, "random_forest", n_trials=6, startup=3)
    return trials


@register("m14_voting_soft_hard", digits=None)
def q_voting(spark, sf):
    """Soft and hard voting of three fitted models on the test rows."""
    train, test = _split(spark, sf)
    fitted = {k: M.make_pipeline(k, FEATURES).fit(train) for k in ("logistic_regression", "naive_bayes",
                                                                  "decision_tree")}
    both = M.chain(fitted, test)
    soft = M.vote_columns(both, list(fitted), soft=True, name="soft")
    hard = M.vote_columns(soft, list(fitted), soft=False, name="hard")
    return hard.select("id", "label", "soft_p1", "soft_prediction", "hard_p1", "hard_prediction")


@register("m15_stacking", digits=None)
def q_stacking(spark, sf):
    """Out-of-fold (3 folds) probabilities -> logistic meta-learner."""
    train, test = _split(spark, sf)
    base, meta = M.stacking(train, FEATURES, ("logistic_regression", "naive_bayes"), "fold", 3)
    out = M.stacking_predict(base, meta, test)
    return out.select("id", "label", M.p1("stacking_ensemble").alias("p1"),
                      F.col("stacking_ensemble_prediction").cast("int").alias("prediction"))


@register("m16_bagging", digits=None)
def q_bagging(spark, sf):
    """10 bootstrap decision trees, mean probability."""
    train, test = _split(spark, sf)
    bag = M.bagging(train, FEATURES, "decision_tree", n=10)
    out = M.bagging_predict(bag, test)
    return out.select("id", "label", "bagging_ensemble_p1", "bagging_ensemble_prediction")


@register("m17_p1_forest_importance", digits=None)
def q_importance(spark, sf):
    """Random-forest importances, top 15."""
    train, _ = _split(spark, sf)
    return M.forest_importance_table(train, FEATURES, 15)


@register("m18_compare_feature_sets", digits=None)
def q_compare_sets(spark, sf):
    """Raw customer columns vs the engineered feature set, same model."""
    train, test = _split(spark, sf)
    basic = ["senior", "tenure", "monthly_charges", "total_charges"]
    return M.compare_feature_sets(train, test, basic, FEATURES, "logistic_regression")


# ------------------------------------------------------------------ D1-D3
_D1_SQL = with_c360(f"""
SELECT id, p1, CAST(p1 >= 0.5 AS INTEGER) AS prediction, 'v1' AS model_version
FROM pred WHERE model = '{MODELS[0]}'
""", extra_ctes=SCORED_CTE)


@register("d1_batch_score", sql=_D1_SQL)
def q_d1(spark, sf):
    """Threshold 0.5 and a version tag on the positive probability."""
    p = scored(spark, sf).where(F.col("model") == MODELS[0])
    return D.batch_score(None, p, prob_col="p1", version="v1", keep=["id"])


@register("d1_stream_score", sql=_D1_SQL)
def q_d1_stream(spark, sf):
    """D1 on Structured Streaming: customers arrive as a parquet stream, are
    joined with the (static) scored features and scored by the same
    projection; the sink is parquet with a checkpoint (exactly once,
    restartable).  Runs with ``availableNow`` and reads the sink back."""
    cust_schema = spark.read.parquet(os.path.join(sf, "customer.parquet")).schema
    stream = (spark.readStream.schema(cust_schema).option("pathGlobFilter", "customer.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf))
    static = scored(spark, sf).where(F.col("model") == MODELS[0]).select("id", "p1")
    joined = stream.select(F.col("c_custkey").alias("id")).join(static, "id")
    run = uuid.uuid4().hex
    sink, ckpt = scratch_path(spark, f"d1_stream_{run}/out"), scratch_path(spark, f"d1_stream_{run}/ckpt")
    q = D.stream_score(None, joined, sink, ckpt, prob_col="p1", version="v1").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("d2_performance_alert", sql=with_c360(f"""
SELECT contract, count(*) AS n, round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy,
       round(0.8 - avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy_drop,
       0.8 - avg(CAST(label = prediction AS DOUBLE)) > 0.05 AS alert
FROM pred JOIN (SELECT customer_id AS id, contract FROM c360) USING (id)
WHERE model = '{MODELS[0]}' GROUP BY contract
""", extra_ctes=SCORED_CTE))
def q_d2(spark, sf):
    """Accuracy per market segment against a 0.80 baseline."""
    from featureforge.sources.tables import customer_360
    p = scored(spark, sf).where(F.col("model") == MODELS[0])
    seg = customer_360(spark, sf).select(F.col("customer_id").alias("id"), "contract")
    return D.performance_alert(p.join(seg, "id"), "contract", 0.8)


@register("d2_performance_by_month", sql=with_c360(f"""
SELECT period, count(*) AS n, round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy,
       round(0.8 - avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy_drop,
       0.8 - avg(CAST(label = prediction AS DOUBLE)) > 0.05 AS alert
FROM pred JOIN (SELECT o_custkey AS id, CAST(year(max(o_orderdate)) * 100 + month(max(o_orderdate)) AS INTEGER) AS period
                FROM orders GROUP BY o_custkey) USING (id)
WHERE model = '{MODELS[0]}' GROUP BY period
""", extra_ctes=SCORED_CTE))
def q_d2_month(spark, sf):
    """D2 over time: accuracy per month of the customer's last order."""
    from featureforge.sources.tables import table
    last = F.max("o_orderdate")
    months = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        (F.year(last) * 100 + F.month(last)).cast("int").alias("period"))
    p = scored(spark, sf).where(F.col("model") == MODELS[0])
    return D.performance_alert(p.join(months, "id"), "period", 0.8)


@register("d1_batch_score_reloaded_model", digits=None)
def q_d1_model(spark, sf):
    """D1 with a fitted pipeline that was saved and read back: test rows scored
    by the reloaded model."""
    from pyspark.ml import PipelineModel
    train, test = _split(spark, sf)
    path = scratch_path(spark, f"d1_model_{uuid.uuid4().hex}")
    M.make_pipeline("logistic_regression", FEATURES).fit(train).write().overwrite().save(path)
    return D.batch_score(PipelineModel.load(path), test, name="logistic_regression", version="v1", keep=["id"])


@register("d3_prediction_drift_psi", sql=with_c360(f"""
SELECT round(sum((sc - sa) * ln(sc / sa)), 6) AS psi, sum((sc - sa) * ln(sc / sa)) > 0.1 AS drift_alert
FROM (SELECT greatest(coalesce(nb, 0) * 1.0e0 / (SELECT count(*) FROM pred WHERE model = '{MODELS[0]}'), 1e-6) AS sa,
             greatest(coalesce(nc, 0) * 1.0e0 / (SELECT count(*) FROM pred WHERE model = '{MODELS[1]}'), 1e-6) AS sc
      FROM (SELECT unnest(range(0, 10)) AS bin) b
      LEFT JOIN (SELECT bin, count(*) AS nb FROM binned WHERE model = '{MODELS[0]}' GROUP BY bin) x USING (bin)
      LEFT JOIN (SELECT bin, count(*) AS nc FROM binned WHERE model = '{MODELS[1]}' GROUP BY bin) y USING (bin))
""", extra_ctes=SCORED_CTE + """,
edges AS (SELECT quantile_cont(p1, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM pred
          WHERE model = 'logistic_baseline'),
binned AS (SELECT model, (SELECT count(*) FROM unnest(e) t(v) WHERE p1 > t.v) AS bin FROM pred CROSS JOIN edges
           WHERE p1 IS NOT NULL)
"""))
def q_d3(spark, sf):
    """D3: PSI of the second scorer's distribution against the first's deciles."""
    p = scored(spark, sf)
    return D.psi(p.where(F.col("model") == MODELS[0]), p.where(F.col("model") == MODELS[1]))
