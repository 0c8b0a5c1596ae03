"""Models (M1-M18) as Spark ML training jobs.

Every model is a ``Pipeline``: median imputation of the feature columns
(frozen at fit) -> ``VectorAssembler`` -> a Spark ML classifier with its own
output column names, so several fitted models can be chained on the SAME
DataFrame (one projection per model, no joins) for ensembles and for
``evaluate_all``.  Training data is read once and cached by the caller's
plan; every fit is a distributed Spark ML job (tree aggregation, no
driver-side data).

Library differences (stated, not hidden): the boosted-tree families of the
surveyed project are the three growth strategies of ``boosting.py``, and SVM
is a linear SVM with Platt scaling (no kernels).
"""

from __future__ import annotations

import json
import math
import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols, string_cols
from featureforge.functions.rank import weighted_quantiles
from featureforge.ml.boosting import PRESETS, BoostedTrees
from featureforge.ml.extratrees import ExtraTrees
from featureforge.ml.forest import RandomForest
from featureforge.ml.search import Choice, Range, fold_aucs, search
from featureforge.operators.impute import Imputer, ImputerModel

SEED = 42
FIT_ROWS = 500_000     # of a partition that iterative fits read
BOOSTED = tuple(PRESETS)
BASE_MODELS = ("logistic_regression", "random_forest", "xgboost", "lightgbm", "catboost",
               "naive_bayes", "extra_trees", "decision_tree")
OPTIONAL_MODELS = ("svm",)


def _cols(name: str) -> dict:
    return {"featuresCol": f"_{name}_features", "predictionCol": f"{name}_prediction",
            "probabilityCol": f"{name}_probability", "rawPredictionCol": f"{name}_raw"}


def make_classifier(kind: str, name: str | None = None, n_rows: int | None = None, **params):
    """Factory of Spark classifiers (M1, M7, M10) with the surveyed
    defaults mapped to Spark parameters."""
    name = name or kind
    c = _cols(name)
    if kind == "logistic_regression":
        # C -> regParam = 1 / (C * n); l1/l2/elasticnet -> elasticNetParam 1 / 0 / 0.5.
        # Spark standardises internally (coefficients are reported on the
        # original scale); the penalty then acts on standardised
        # coefficients, unlike the unscaled liblinear/lbfgs fit.
        C = params.get("C", 1.0)
        pen = params.get("penalty", "l2")
        reg = 1.0 / (C * (n_rows or 1000))
        return LogisticRegression(maxIter=params.get("max_iter", 1000), regParam=reg, tol=1e-4,
                                  elasticNetParam={"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}[pen],
                                  standardization=True, labelCol="label", **c)
    if kind == "naive_bayes":
        return NaiveBayes(modelType="gaussian", labelCol="label", **c)
    if kind == "decision_tree":
        return DecisionTreeClassifier(seed=SEED, maxDepth=min(params.get("max_depth", 10), 30),
                                      labelCol="label", **c)
    raise ValueError(f"unknown model kind {kind}")


def make_pipeline(kind: str, features: Sequence[str], name: str | None = None,
                  n_rows: int | None = None, **params) -> Pipeline:
    name = name or kind
    if kind == "svm":
        return _svm_pipeline(features, name, **params)
    if kind == "random_forest":
        return Pipeline(stages=[_FeatureImputer(features), RandomForest(list(features), name, **params)])
    if kind == "extra_trees":
        return Pipeline(stages=[ExtraTrees(list(features), name, **params)])
    if kind in BOOSTED:  # missing values and categories are the booster's own
        return Pipeline(stages=[BoostedTrees(kind, list(features), name, **params)])
    assembler = VectorAssembler(inputCols=list(features), outputCol=f"_{name}_features",
                                handleInvalid="keep")
    return Pipeline(stages=[_FeatureImputer(features), assembler,
                            make_classifier(kind, name, n_rows, **params)])


class _FeatureImputer(Imputer):
    """Median imputation restricted to the model's feature columns."""

    def __init__(self, features: Sequence[str] = ()):
        super().__init__("median", "mode", exclude=[], only_null_bearing=False)
        cfg = json.loads(self.getOrDefault(self.config))
        cfg["features"] = list(features)
        self._set(config=json.dumps(cfg))

    def compute(self, df, cfg):
        feats = cfg.get("features") or []
        sub = df.select(*feats)
        return super().compute(sub, {**cfg, "exclude": []})


def _svm_pipeline(features, name, **params) -> Pipeline:
    """M6: LinearSVC, then Platt scaling = logistic regression on the margin."""
    svc = LinearSVC(featuresCol=f"_{name}_features", labelCol="label",
                    predictionCol=f"_{name}_svm_pred", rawPredictionCol=f"_{name}_margin",
                    regParam=params.get("reg", 0.01), maxIter=100)
    margin = _MarginToVector(name)
    platt = LogisticRegression(featuresCol=f"_{name}_mvec", labelCol="label", **{
        "predictionCol": f"{name}_prediction", "probabilityCol": f"{name}_probability",
        "rawPredictionCol": f"{name}_raw"})
    return Pipeline(stages=[_FeatureImputer(features),
                            VectorAssembler(inputCols=list(features), outputCol=f"_{name}_features",
                                            handleInvalid="keep"),
                            svc, margin, platt])


from pyspark.ml import Transformer  # noqa: E402
from pyspark.ml.param import Param, Params, TypeConverters  # noqa: E402
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable  # noqa: E402


class _MarginToVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    model_name = Param(Params._dummy(), "model_name", "name of the model", TypeConverters.toString)

    def __init__(self, name: str = "svm"):
        super().__init__()
        self._setDefault(model_name="svm")
        self._set(model_name=name)

    def _transform(self, df):
        name = self.getOrDefault(self.model_name)
        m = vector_to_array(F.col(f"_{name}_margin"))[1]
        return VectorAssembler(inputCols=["_m"], outputCol=f"_{name}_mvec").transform(
            df.withColumn("_m", m)).drop("_m")


def p1(name: str):
    """Probability of the positive class of model ``name``."""
    return vector_to_array(F.col(f"{name}_probability"))[1]


def predictions(fitted: PipelineModel, df: DataFrame, name: str, id_col: str = "id",
                extra: Sequence[str] = ()) -> DataFrame:
    """(model, id, label, prediction, p1, extra...) from one fitted model."""
    out = fitted.transform(df)
    return out.select(F.lit(name).alias("model"), F.col(id_col).alias("id"), F.col("label").cast("int").alias("label"),
                      F.col(f"{name}_prediction").cast("int").alias("prediction"),
                      p1(name).alias("p1"), *extra)


def for_fits(df: DataFrame, n_rows: int) -> DataFrame:
    """Rows for iterative fits, in no more partitions than keep every core busy with
    at most about ``FIT_ROWS`` rows each: a fit passes over them hundreds of times, and
    each pass starts a task per partition that reports to the driver."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, math.ceil(n_rows / FIT_ROWS)))


# ------------------------------------------------------------------ M11
BASELINE_METRICS = ("accuracy", "precision", "recall", "f1_score", "specificity", "balanced_accuracy", "log_loss", "tp", "fp", "tn", "fn")


def train_baselines(train: DataFrame, valid: DataFrame, features: Sequence[str],
                    models: Sequence[str] = BASE_MODELS, id_col: str = "id",
                    parallelism: int = 2) -> tuple[dict, DataFrame]:
    """Fit each model on ``train`` (concurrent fits from a small thread pool),
    score ``valid``; a failing model is recorded, not fatal.  Boosted models stop
    early on ``valid`` (M12).  Returns the fitted models and (model, status,
    training_time, error, roc_auc and the other metrics of ``valid``)."""
    from featureforge.operators import evaluate as V
    n, n_valid = train.count(), valid.count()
    both = with_validation(train, valid, n + n_valid)

    def fit(kind):
        t0 = time.perf_counter()
        try:
            if kind in BOOSTED:
                m = fit_with_early_stopping(both, features, kind)
            else:
                m = make_pipeline(kind, features, n_rows=n).fit(train)
            return kind, m, time.perf_counter() - t0, None
        except Exception as e:  # noqa: BLE001
            return kind, None, time.perf_counter() - t0, f"{type(e).__name__}: {str(e)[:200]}"
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        results = list(ex.map(fit, models))
    fitted = {k: m for k, m, _, err in results if m is not None}
    auc, scored = {}, {}
    if fitted:
        preds = [predictions(m, valid, k, id_col) for k, m in fitted.items()]
        preds = for_fits(reduce(DataFrame.unionByName, preds), len(preds) * n_valid).persist()
        auc = V.auc_by_key(preds, "model")
        scored = {r["model"]: r for r in V.classification_metrics(preds, ["model"]).collect()}  # a row per model
        preds.unpersist()

    def told(k):
        return [float(scored[k][m]) if k in scored and scored[k][m] is not None else None for m in BASELINE_METRICS]
    rows = [(k, "ok" if err is None else "failed", float(t), err, auc.get(k), *told(k)) for k, _, t, err in results]
    status = train.sparkSession.createDataFrame(
        rows, "model string, status string, training_time double, error string, roc_auc double, "
        + ", ".join(f"{m} double" for m in BASELINE_METRICS))
    return fitted, status


# ------------------------------------------------------------------ M12
def with_validation(train: DataFrame, valid: DataFrame, n_rows: int) -> DataFrame:
    """Both in one frame; ``is_valid`` flags the rows on which boosting stops."""
    return for_fits(train.withColumn("is_valid", F.lit(False)).unionByName(valid.withColumn("is_valid", F.lit(True))), n_rows)


def fit_with_early_stopping(train_and_valid: DataFrame, features: Sequence[str], kind: str = "xgboost",
                            valid_flag: str = "is_valid", rounds: int = 50, **params) -> PipelineModel:
    """Boosting stops when the loss of the flagged rows has not improved
    for ``rounds`` rounds, and keeps the trees up to the best one."""
    return make_pipeline(kind, features, valid_col=valid_flag, early_stopping_rounds=rounds, **params).fit(train_and_valid)


# ------------------------------------------------------------------ M13
_BOOST_SPACE = {"n_estimators": Range(100, 500, whole=True), "max_depth": Range(3, 10, whole=True),
                "learning_rate": Range(0.01, 0.3), "subsample": Range(0.6, 1.0), "colsample_bytree": Range(0.6, 1.0),
                "reg_alpha": Range(0.0, 1.0), "reg_lambda": Range(0.0, 1.0)}
SEARCH_SPACES = {
    "random_forest": {"n_estimators": Range(100, 500, whole=True), "max_depth": Range(5, 20, whole=True),
                      "min_samples_leaf": Range(1, 10, whole=True), "max_features": Choice(("sqrt", "log2", "all"))},
    "xgboost": _BOOST_SPACE,
    "lightgbm": _BOOST_SPACE,
    "catboost": {"iterations": Range(100, 500, whole=True), "depth": Range(3, 10, whole=True),
                 "learning_rate": Range(0.01, 0.3), "l2_leaf_reg": Range(1.0, 10.0)},
    "logistic_regression": {"C": Range(0.001, 100.0, log=True), "penalty": Choice(("l1", "l2", "elasticnet"))},
}


def fitter(kind: str, features: Sequence[str], rows: DataFrame, n_rows: int | None = None) -> tuple:
    """(fit, release): ``fit`` of parameters gives the model of ``rows``; a forest's fill
    values and bins do not depend on its parameters and are made once."""
    if kind != "random_forest":
        return lambda **params: make_pipeline(kind, features, n_rows=n_rows, **params).fit(rows), lambda: None
    imputer = _FeatureImputer(features).fit(rows)
    binned = RandomForest(features).rows(imputer.transform(rows))
    return lambda **params: PipelineModel([imputer, RandomForest(features, kind, **params).grown(binned)]), binned.release


def release(model: PipelineModel) -> None:
    """Deletes what a fitted model that is no longer needed keeps outside of itself."""
    for stage in model.stages:
        if hasattr(stage, "release"):
            stage.release()


def tune(train: DataFrame, features: Sequence[str], kind: str, n_trials: int = 50, fold_col: str = "fold",
         parallelism: int = 5, seed: int = SEED, space: dict | None = None, startup: int = 10,
         fixed: dict | None = None, valid: DataFrame | None = None) -> tuple[PipelineModel, DataFrame, dict]:
    """``n_trials`` seeded trials of a Parzen sampler over the model's
    space, mean AUC over the T3 folds, the best point refitted on all of
    ``train``; with ``valid``, the refit of a boosted model stops early on those rows (M12).
    ``train`` should be persisted: every fold of every trial reads it.
    Returns (model, trials table, best parameters)."""
    n = train.count()
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    fixed = fixed or {}

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        fits = dict(zip(folds, pool.map(lambda f: fitter(kind, features, train.where(F.col(fold_col) != f), n), folds)))

    def value(params):
        made = []

        def fit(f):
            made.append(fits[f][0](**fixed, **params))
            return made[-1]

        try:
            aucs = fold_aucs(train, fit, lambda m, rows: predictions(m, rows, kind), fold_col, folds, parallelism)
        finally:
            for m in made:
                release(m)
        return sum(aucs.values()) / len(aucs)

    try:
        sampler = search(space or SEARCH_SPACES[kind], value, n_trials, seed, startup)
    finally:
        for _, free in fits.values():
            free()
    rows = [(i, str(params), float(v)) for i, (params, v) in enumerate(sampler.trials)]
    trials = train.sparkSession.createDataFrame(rows, "trial int, params string, cv_auc double")
    best = {**fixed, **sampler.best[0]}
    if valid is not None and kind in BOOSTED:
        return fit_with_early_stopping(with_validation(train, valid, n + valid.count()), features, kind, **best), trials, best
    return make_pipeline(kind, features, n_rows=n, **best).fit(train), trials, best


# ------------------------------------------------------------------ M14-M16
def chain(models: dict, df: DataFrame) -> DataFrame:
    """Apply several fitted pipelines to the same rows (no joins)."""
    out = df
    for m in models.values():
        out = m.transform(out)
    return out


def voting(models: dict, df: DataFrame, soft: bool = True, name: str = "voting_ensemble") -> DataFrame:
    """soft = mean positive probability of the models; hard = majority
    of their 0/1 predictions (ties -> 1, like the mean >= 0.5 rule)."""
    return vote_columns(chain(models, df), list(models), soft, name)


def vote_columns(out: DataFrame, names: Sequence[str], soft: bool = True,
                 name: str = "voting_ensemble") -> DataFrame:
    """M14 on a frame that already carries the models' output columns."""
    if soft:
        p = sum((p1(n) for n in names[1:]), p1(names[0])) / len(names)
        return out.withColumn(f"{name}_p1", p).withColumn(f"{name}_prediction", (p >= 0.5).cast("int"))
    votes = sum((F.col(f"{n}_prediction") for n in names[1:]), F.col(f"{names[0]}_prediction"))
    return (out.withColumn(f"{name}_p1", votes / len(names))
            .withColumn(f"{name}_prediction", (votes * 2 >= len(names)).cast("int")))


def specs_of(kinds) -> dict[str, tuple[str, dict]]:
    """{name: (kind, parameters)} from names of kinds or such a dict."""
    return dict(kinds) if isinstance(kinds, dict) else {k: (k, {}) for k in kinds}


def fit_spec(rows: DataFrame, features: Sequence[str], name: str, spec: tuple[str, dict]) -> PipelineModel:
    return make_pipeline(spec[0], features, name=name, **spec[1]).fit(rows)


def stacking(train: DataFrame, features: Sequence[str], kinds, fold_col: str = "fold", k: int = 5,
             parallelism: int = 4) -> tuple[dict, PipelineModel]:
    """Out-of-fold probabilities of the base models (T3 folds) train a
    logistic-regression meta learner; base models are then refit on all rows.
    ``kinds``: names, or {name: (kind, parameters)}.  The fits run side by side."""
    specs = specs_of(kinds)

    def fold(f):
        tr, scored = train.where(F.col(fold_col) != f), train.where(F.col(fold_col) == f)
        for name, spec in specs.items():
            scored = fit_spec(tr, features, name, spec).transform(scored).withColumn(f"oof_{name}", p1(name))
        return scored.select("id", "label", *[f"oof_{name}" for name in specs])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(fold, range(k)))
        base = dict(zip(specs, pool.map(lambda x: fit_spec(train, features, *x), specs.items())))
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    oof = for_fits(oof, train.count()).persist()   # the union has the partitions of every fold
    meta = Pipeline(stages=[VectorAssembler(inputCols=[f"oof_{name}" for name in specs], outputCol="_meta_features"),
                            LogisticRegression(featuresCol="_meta_features", labelCol="label",
                                               **{kk: v for kk, v in _cols("stacking_ensemble").items()
                                                  if kk != "featuresCol"})]).fit(oof)
    oof.unpersist()
    return base, meta


def stacking_predict(base: dict, meta: PipelineModel, df: DataFrame) -> DataFrame:
    out = chain(base, df)
    for kind in base:
        out = out.withColumn(f"oof_{kind}", p1(kind))
    return meta.transform(out)


def draw_chances(mean: float) -> list[float]:
    """Chances of at most 0, 1, ... 7 Poisson draws."""
    out, below, p = [], 0.0, math.exp(-mean)
    for k in range(1, 9):
        below += p
        out.append(below)
        p *= mean / k
    return out


def times_drawn(hashes: np.ndarray, mean: float = 1.0) -> np.ndarray:
    """``_times`` of ``drawn``, 0 included, from the hashes of the rows' ids and the seed."""
    return np.searchsorted(draw_chances(mean), (hashes & ((1 << 40) - 1)) / float(1 << 40), "right")


def drawn(df: DataFrame, seed: int, id_col: str = "id", mean: float = 1.0) -> DataFrame:
    """The rows of a bootstrap sample, each once, and in ``_times`` how often the sample has it:
    a Poisson draw, derived from the row's id and the seed, so that the sample does not
    depend on partitioning."""
    u = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    times = F.lit(0)
    for below in draw_chances(mean):
        times = times + (F.col("_times") >= below).cast("int")
    return df.withColumn("_times", u).withColumn("_times", times).where(F.col("_times") > 0)


def repeated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_times", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).drop("_times")


def bootstrap(df: DataFrame, seed: int, id_col: str = "id", mean: float = 1.0) -> DataFrame:
    """Each row as often as its Poisson draw says."""
    return repeated(drawn(df, seed, id_col, mean))


def bag_imputers(train: DataFrame, features: Sequence[str], seeds: Sequence[int]) -> list[ImputerModel] | None:
    """What ``_FeatureImputer`` gives on the bootstrap sample of each seed; the medians of
    all samples are found together.  None if a feature is text, whose mode is asked for."""
    sub = train.select(*features)
    if string_cols(sub):
        return None
    numeric = numeric_cols(sub)
    found = weighted_quantiles(train, {c: F.col(c) for c in numeric}, [F.xxhash64(F.col("id"), F.lit(s)) for s in seeds], times_drawn, [0.5])
    config = json.dumps(_FeatureImputer(features)._cfg())
    return [ImputerModel(config=config, state=json.dumps({
        "fills": {c: v[0] for c, v in medians.items() if v}, "kind": {c: "numeric" for c in numeric}}, default=float)) for medians in found]


def bagging(train: DataFrame, features: Sequence[str], kind: str, n: int = 10, seed: int = SEED,
            parallelism: int = 4, **params) -> dict:
    """``n`` bootstrap fits, run side by side.  Medians of all samples come from the
    same passes over ``train``; a sample's vectors are made once and kept while its model is fitted."""
    seeds = [seed + i for i in range(n)]
    imputes = isinstance(make_pipeline(kind, features, **params).getStages()[0], _FeatureImputer)
    imputers = bag_imputers(train, features, seeds) if imputes and n else None

    def fit(i):
        name = f"{kind}_bag{i}"
        if not imputers:
            return name, fit_spec(bootstrap(train, seeds[i]), features, name, (kind, params))
        _, first, *rest = make_pipeline(kind, features, name=name, **params).getStages()
        if not isinstance(first, VectorAssembler):
            rows = imputers[i].transform(bootstrap(train, seeds[i]))
            return name, PipelineModel([imputers[i], *Pipeline(stages=[first, *rest]).fit(rows).stages])
        rows = imputers[i].transform(drawn(train.select("id", "label", *features), seeds[i]))
        rows = repeated(first.transform(rows).select("label", first.getOutputCol(), "_times")).persist()
        try:
            return name, PipelineModel([imputers[i], first, *Pipeline(stages=rest).fit(rows).stages])
        finally:
            rows.unpersist()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return dict(pool.map(fit, range(n)))


def bagging_predict(models: dict, df: DataFrame, name: str = "bagging_ensemble") -> DataFrame:
    return voting(models, df, soft=True, name=name)


# ------------------------------------------------------------------ M17, P1
def native_importance(fitted: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """Tree importances or |coefficients| of the final stage."""
    m = fitted.stages[-1]
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray()
    elif hasattr(m, "coefficients"):
        vals = [abs(x) for x in m.coefficients.toArray()]
    elif hasattr(m, "theta"):
        vals = [0.0] * len(features)
    else:
        vals = [0.0] * len(features)
    return sorted(zip(features, map(float, vals)), key=lambda t: (-t[1], t[0]))


def forest_importance_table(train: DataFrame, features: Sequence[str], top: int = 15) -> DataFrame:
    """Fit a random forest, importances descending (top ``top``)."""
    m = make_pipeline("random_forest", features).fit(train)
    rows = native_importance(m, features)[:top]
    return train.sparkSession.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)],
                                              "rank int, feature string, importance double")


def compare_feature_sets(train: DataFrame, test: DataFrame, basic: Sequence[str],
                         engineered: Sequence[str], kind: str = "random_forest") -> DataFrame:
    """The same model on two feature sets; AUC and its delta."""
    from featureforge.operators import evaluate as V
    res = []
    for label, feats in (("basic", basic), ("engineered", engineered)):
        m = make_pipeline(kind, feats, name=kind).fit(train)
        p = predictions(m, test, kind)
        auc = V.roc_auc(V.score_histogram(p)).first()["roc_auc"]
        res.append((label, len(feats), auc))
    spark = train.sparkSession
    d = spark.createDataFrame(res, "feature_set string, n_features int, roc_auc double")
    b, e = res[0][2], res[1][2]
    return d.withColumn("delta_vs_basic", F.col("roc_auc") - F.lit(b)).withColumn(
        "relative_delta_pct", (F.col("roc_auc") - F.lit(b)) / F.lit(b) * 100 if b else F.lit(None)) \
        if e is not None else d


# ------------------------------------------------------------------ V21
def cross_validate(train: DataFrame, features: Sequence[str], kinds, fold_col: str = "fold", k: int = 5,
                   parallelism: int = 4, stack=()) -> DataFrame:
    """Per fold AUC / precision / recall / F1 of each model (fit on the
    other folds), then mean and POPULATION sd per (model, metric).  ``kinds``: names,
    or {name: (kind, parameters)}; ``stack``: likewise the base models of a stack that is
    validated too, with ``k`` folds of its own inside the other folds.  Fits run side by
    side; all fold predictions are scored in one grouped evaluation job."""
    from featureforge.operators import evaluate as V
    from featureforge.operators import split as T

    def one(job):
        f, (name, spec) = job
        model = fit_spec(train.where(F.col(fold_col) != f), features, name, spec)
        return predictions(model, train.where(F.col(fold_col) == f), name).withColumn("fold", F.lit(f))

    def stacked(f):
        rows = train.where(F.col(fold_col) != f).drop(fold_col)
        inner = T.stratified_kfold(rows.select("id", "label"), "id", "label", k, SEED).select("id", F.col("fold").alias(fold_col))
        rows = for_fits(rows.join(inner, "id"), rows.count()).persist()
        base, meta = stacking(rows, features, stack, fold_col, k, parallelism)
        rows.unpersist()
        name = "stacking_ensemble"
        return stacking_predict(base, meta, train.where(F.col(fold_col) == f)).select(
            F.lit(name).alias("model"), "id", F.col("label").cast("int").alias("label"),
            F.col(f"{name}_prediction").cast("int").alias("prediction"), p1(name).alias("p1"), F.lit(f).alias("fold"))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, [(f, x) for f in range(k) for x in specs_of(kinds).items()]))
    if stack:   # a stack's own fits run side by side
        parts += [stacked(f) for f in range(k)]
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    keys = ["model", "fold"]
    cm = V.classification_metrics(preds, keys)
    told = V.auc_by_key(preds.withColumn("_of", F.concat_ws("|", "fold", "model")), "_of")
    auc = [(of.split("|", 1)[1], int(of.split("|", 1)[0]), x) for of, x in told.items()]
    auc = train.sparkSession.createDataFrame(auc, "model string, fold int, roc_auc double")
    per = cm.join(F.broadcast(auc), keys).select("model", "fold", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
        for m in ("roc_auc", "precision", "recall", "f1_score")])))
    return per.groupBy("model", "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                              F.count(F.lit(1)).alias("folds"))
