"""Catalogued queries: whole pipelines (W1-W5) and sources/sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from featureforge.plans.datasets import FEATURES, churn_features
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.session import scratch_path
from featureforge.sources import io as S
from featureforge.sources.tables import customer_360, customer_360_dirty, with_c360


@register("w1_explore_overview", digits={"*": 6, "value": None})
def q_w1(spark, sf):
    """Headline numbers of the exploration reports as (section, metric, value)."""
    from featureforge.plans.explore import explore
    rep = explore(customer_360_dirty(spark, sf), R)

    def long(name, df):
        cols = [c for c, t in df.dtypes if t in ("bigint", "int", "double", "boolean")]
        return df.select(F.inline(F.array(*[F.struct(F.lit(name).alias("section"), F.lit(c).alias("metric"),
                                                     F.col(c).cast("double").alias("value")) for c in cols])))
    parts = [long(n, rep[n]) for n in ("missing_summary", "duplicates", "completeness", "class_balance",
                                       "correlation_summary", "revenue_at_risk")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("value", F.round("value", 6))


@register("w2_engineer_features", digits=None)
def q_w2(spark, sf):
    """Impute -> cap -> business -> interactions -> one-hot (dummy
    variance guard) -> scale -> variance selection, fitted then applied."""
    from featureforge.plans.engineer import engineering_pipeline
    c = customer_360(spark, sf)
    model = engineering_pipeline(R).fit(c)
    return model.transform(c)


@register("w4_basic_preprocess", sql=None)
def q_w4(spark, sf):
    """W4 on the dirty table (blank text charges stay categorical)."""
    from featureforge.plans.engineer import basic_preprocess_pipeline
    d = customer_360_dirty(spark, sf).drop("total_charges")
    return basic_preprocess_pipeline(R).fit(d).transform(d)


@register("w5_advanced_preprocess", sql=None)
def q_w5(spark, sf):
    """Median impute -> frozen IQR caps -> robust scale -> polynomial block."""
    from featureforge.plans.engineer import advanced_preprocess_pipeline
    d = customer_360_dirty(spark, sf).drop("total_charges")
    return advanced_preprocess_pipeline(R).fit(d).transform(d)


def _w3(spark, sf):
    """One run of the whole workflow per session and folder; its tables are small."""
    from featureforge.plans.develop import develop_models
    fm = churn_features(spark, sf).withColumnRenamed("customer_id", "id")
    key = (spark.sparkContext.applicationId, sf)
    if key not in _W3_RUNS:
        _W3_RUNS[key] = develop_models(fm, FEATURES)
    return _W3_RUNS[key]


_W3_RUNS: dict = {}


@register("w5_strategies", digits=None)
def q_w5_strategies(spark, sf):
    """W5 with the other strategies: k-NN or iterative imputation, isolation flag."""
    from featureforge.plans.engineer import advanced_preprocess
    d = customer_360_dirty(spark, sf).drop("total_charges")
    parts = [advanced_preprocess(d, R, impute, scaling="standard", isolation=True)
             .withColumn("imputation", F.lit(impute)) for impute in ("knn", "iterative")]
    return parts[0].unionByName(parts[1])


@register("w3_develop_models", digits=None)
def q_w3(spark, sf):
    """Split, eight baselines, three tuned models (50 trials over five folds each),
    vote, stack and ten bags of them, test evaluation, comparison table."""
    return _w3(spark, sf)["comparison"]


@register("w3_cross_validation", digits=None)
def q_w3_cv(spark, sf):
    """Fold metrics of every tuned model and of the stack, five folds."""
    return _w3(spark, sf)["cv"]


@register("w3_interpretation", digits=None)
def q_w3_interpretation(spark, sf):
    """Mean absolute Shapley values of the best model on the test rows."""
    return _w3(spark, sf)["interpretation"]


_ROUNDTRIP_SQL = with_c360("""
SELECT customer_id, tenure, monthly_charges, total_charges, CAST(churn = 'Yes' AS INTEGER) AS label FROM c360
""")


@register("s1_s3_s8_csv_roundtrip", sql=_ROUNDTRIP_SQL, digits=None)
def q_roundtrip(spark, sf):
    """S3 write (CSV sink) -> S1 load with an explicit schema -> S8 target to 0/1."""
    c = customer_360(spark, sf).select(R.id, "tenure", "monthly_charges", "total_charges", R.target)
    path = scratch_path(spark, f"csv_{uuid.uuid4().hex}")
    c.write.mode("overwrite").option("header", True).csv(path)
    back = S.load_raw(spark, path, schema=c.schema, fmt="csv")
    return S.load_xy(back, R.target, R.positive)


@register("s2_s4_processed_with_metadata", digits=None, sql=with_c360("""
SELECT c360.*, 'train' AS split FROM c360 JOIN (
  SELECT customer_id FROM (
    SELECT customer_id, row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(customer_id AS VARCHAR) || '-42'),
                                           customer_id) AS r, count(*) OVER (PARTITION BY churn) AS n FROM c360)
  WHERE r > floor(n * 0.2 + 0.5)) USING (customer_id)
"""))
def q_meta(spark, sf):
    """S4 table + metadata sidecar, S2 reload of the train partition."""
    from featureforge.operators.split import train_test_split
    c = customer_360(spark, sf)
    base = scratch_path(spark, f"proc_{uuid.uuid4().hex}")
    S.save_with_metadata(train_test_split(c, R.id, R.target), base, "processed", ["imputer", "scaler"])
    return S.load_processed(spark, base, train=True)


@register("s5_s7_persisted_model")
def q_persist(spark, sf):
    """A fitted W4 pipeline saved, reloaded and applied."""
    from featureforge.plans.engineer import basic_preprocess_pipeline
    d = customer_360_dirty(spark, sf).drop("total_charges")
    model = basic_preprocess_pipeline(R).fit(d)
    path = scratch_path(spark, f"model_{uuid.uuid4().hex}")
    S.save_fitted(model, path)
    return S.load_fitted(path).transform(d)


# ------------------------------------------------------------------ W4/W5 oracles
_W_NUM = ["senior", "tenure", "monthly_charges"]
_W_CAT = ["partner", "dependents", "svc_online_urgent", "svc_streaming_low", "svc_device_final",
          "svc_tech_pending", "contract", "payment"]
_W_LEVELS = {"partner": ["Yes"], "dependents": ["Yes"], "svc_online_urgent": ["Yes"],
             "svc_streaming_low": ["Yes"], "svc_device_final": ["Yes"], "svc_tech_pending": ["Yes"],
             "contract": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
             "payment": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}


def _imp_cap_ctes():
    mode = ("(SELECT contract FROM c360_dirty WHERE contract IS NOT NULL GROUP BY contract "
            "ORDER BY count(*) DESC, contract LIMIT 1)")
    imp = ("imp AS (SELECT customer_id, CAST(senior AS DOUBLE) AS senior, "
           "coalesce(CAST(tenure AS DOUBLE), (SELECT quantile_cont(CAST(tenure AS DOUBLE), 0.5) FROM c360_dirty)) AS tenure, "
           "coalesce(monthly_charges, (SELECT quantile_cont(monthly_charges, 0.5) FROM c360_dirty)) AS monthly_charges, "
           + ", ".join(c if c != "contract" else f"coalesce(contract, {mode}) AS contract" for c in _W_CAT)
           + ", churn FROM c360_dirty)")
    qs = "qs AS (SELECT " + ", ".join(f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}" for c in _W_NUM) + " FROM imp)"
    cap = ("cap AS (SELECT customer_id, " + ", ".join(
        f"least(greatest({c}, q_{c}[1] - 1.5 * (q_{c}[2] - q_{c}[1])), q_{c}[2] + 1.5 * (q_{c}[2] - q_{c}[1])) AS {c}"
        for c in _W_NUM) + ", " + ", ".join(_W_CAT) + ", churn FROM imp CROSS JOIN qs)")
    return [imp, qs, cap]


def _w4_sql():
    dummies = [(f"{c}_{v}", f"CAST(coalesce({c} = '{v}', false) AS INTEGER)") for c, vs in _W_LEVELS.items() for v in vs]
    enc = ("enc AS (SELECT customer_id, " + ", ".join(_W_NUM) + ", "
           + ", ".join(f'{e} AS "{n}"' for n, e in dummies) + ", churn FROM cap)")
    cols = _W_NUM + [n for n, _ in dummies]
    st = "st AS (SELECT " + ", ".join(
        f'avg("{c}") AS "m_{c}", CASE WHEN stddev_pop("{c}") > 0 THEN stddev_pop("{c}") ELSE 1 END AS "s_{c}"'
        for c in cols) + " FROM enc)"
    sel = ("SELECT customer_id, " + ", ".join(f'round(("{c}" - "m_{c}") / "s_{c}", 6) AS "{c}"' for c in cols)
           + ", churn FROM enc CROSS JOIN st")
    return with_c360(sel, extra_ctes=",\n".join(_imp_cap_ctes() + [enc, st]))


def _w5_sql():
    rs = "rs AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.5) AS med_{c}, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) <> 0 "
        f"THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) ELSE 1 END AS iqr_{c}" for c in _W_NUM) + " FROM cap)"
    sc = ("sc AS (SELECT customer_id, " + ", ".join(f"({c} - med_{c}) / iqr_{c} AS {c}" for c in _W_NUM)
          + ", " + ", ".join(_W_CAT) + ", churn FROM cap CROSS JOIN rs)")
    import itertools
    poly = []
    for a, b in itertools.combinations_with_replacement(_W_NUM, 2):
        name = f"{a}^2" if a == b else f"{a} {b}"
        poly.append(f'round({a} * {b}, 6) + 0.0 AS "{name}"')
    sel = ("SELECT customer_id, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _W_NUM) + ", "
           + ", ".join(_W_CAT) + ", churn, " + ", ".join(poly) + " FROM sc")
    return with_c360(sel, extra_ctes=",\n".join(_imp_cap_ctes() + [rs, sc]))


from featureforge.plans.registry import REGISTRY as _REG  # noqa: E402
_REG["w4_basic_preprocess"].sql = _w4_sql()
_REG["s5_s7_persisted_model"].sql = _REG["w4_basic_preprocess"].sql  # a reloaded pipeline does the same
_REG["w5_advanced_preprocess"].sql = _w5_sql()


@register("s6_save_analysis", sql=None)
def q_s6(spark, sf):
    """The exploration reports written as JSON lines (one folder per
    report) and the missing-value report read back."""
    from featureforge.plans.explore import explore
    rep = explore(customer_360_dirty(spark, sf), R)
    base = scratch_path(spark, f"analysis_{uuid.uuid4().hex}")
    S.save_analysis({k: rep[k] for k in ("missing_values", "missing_summary", "class_balance")}, base)
    back = spark.read.schema("column string, missing_count bigint, missing_pct double").json(
        base + "/missing_values")
    return back


@register("s7_save_models", digits=None)
def q_s7(spark, sf):
    """Two fitted models + their metrics table persisted, the results
    table read back."""
    from featureforge.ml import models as M
    from featureforge.plans.catalog.models import _split
    train, test = _split(spark, sf)
    fitted, status = M.train_baselines(train, test, FEATURES, ("naive_bayes", "decision_tree"), parallelism=1)
    base = scratch_path(spark, f"models_{uuid.uuid4().hex}")
    S.save_models(fitted, status, base, best="decision_tree")
    return spark.read.parquet(base + "/results")


@register("v21_cross_validate", digits=None)
def q_v21(spark, sf):
    """3-fold AUC / precision / recall / F1 per model, mean and population sd."""
    from featureforge.ml import models as M
    from featureforge.plans.catalog.models import _split
    train, _ = _split(spark, sf)
    return M.cross_validate(train, FEATURES, ("naive_bayes", "decision_tree"), "fold", 3)

from featureforge.plans.catalog.profile import C360_COLS as _C360_COLS, _nulls_sql  # noqa: E402
_REG["s6_save_analysis"].sql = with_c360(
    "SELECT \"column\", missing_count, round(missing_count * 100.0e0 / total_rows, 6) AS missing_pct FROM "
    + _nulls_sql("c360_dirty", _C360_COLS) + " WHERE missing_count > 0")


def _w1_sql():
    from featureforge.plans.catalog.profile import _NULL_COUNTS, _ANY_NULL, _COLS_WITH_NULL
    nums = ["senior", "tenure", "monthly_charges"]
    pairs = [(a, b) for i, a in enumerate(nums) for b in nums[i + 1:]]
    corr = {f"{a}|{b}": f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN abs(corr({a}, {b})) END"
            for a, b in pairs}
    diag = {c: f"CASE WHEN stddev_pop({c}) > 0 THEN 1.0e0 END" for c in nums}

    def cell(a, b):
        if a == b:
            return diag[a]
        return corr.get(f"{a}|{b}") or corr[f"{b}|{a}"]
    per_col_mean = [f"(SELECT avg(v) FROM (VALUES {', '.join('(' + cell(c, o) + ')' for o in nums)}) t(v))"
                    for c in nums]
    per_col_max = [f"greatest({', '.join(cell(c, o) for o in nums)})" for c in nums]
    metrics = [
        ("missing_summary", "total_missing_cells", f"({_NULL_COUNTS})"),
        ("missing_summary", "pct_missing_cells", f"({_NULL_COUNTS}) * 100.0e0 / (count(*) * 14)"),
        ("duplicates", "duplicate_count", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c360_dirty))"),
        ("duplicates", "duplicate_pct",
         "(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM c360_dirty))) * 100.0e0 / count(*)"),
        ("completeness", "overall_completeness", f"(count(*) * 14 - ({_NULL_COUNTS})) * 100.0e0 / (count(*) * 14)"),
        ("completeness", "columns_with_missing_data", _COLS_WITH_NULL),
        ("completeness", "records_with_missing_data", f"count(*) FILTER (WHERE {_ANY_NULL})"),
        ("class_balance", "total_samples", "count(*)"),
        ("class_balance", "missing_count", "count(*) FILTER (WHERE churn IS NULL)"),
        ("class_balance", "missing_pct", "count(*) FILTER (WHERE churn IS NULL) * 100.0e0 / count(*)"),
        ("class_balance", "n_classes", "count(DISTINCT churn)"),
        ("class_balance", "minority_class_count", "least(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No'))"),
        ("class_balance", "majority_class_count", "greatest(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No'))"),
        ("class_balance", "imbalance_ratio", "greatest(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No')) * 1.0e0 / least(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No'))"),
        ("class_balance", "is_imbalanced", "CAST(greatest(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No')) * 1.0e0 / least(count(*) FILTER (WHERE churn = 'Yes'), count(*) FILTER (WHERE churn = 'No')) > 1.5 AS INTEGER)"),
        ("correlation_summary", "max_correlation", f"greatest({', '.join(per_col_max)})"),
        ("correlation_summary", "mean_correlation", f"({' + '.join(per_col_mean)}) / 3"),
        ("revenue_at_risk", "revenue_at_risk", "coalesce(sum(monthly_charges) FILTER (WHERE churn = 'Yes'), 0)"),
        ("revenue_at_risk", "n_positive", "count(*) FILTER (WHERE churn = 'Yes')"),
    ]
    parts = [f"SELECT '{s}' AS section, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) + 0.0 AS value FROM c360_dirty"
             for s, m, e in metrics]
    return with_c360("\nUNION ALL\n".join(parts))


_REG["w1_explore_overview"].sql = _w1_sql()
