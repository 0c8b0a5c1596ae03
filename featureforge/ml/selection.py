"""Model-based feature selection (L7-L10) on Spark ML forests / lasso.

Each elimination or bootstrap round is one distributed fit on the cached,
assembled training data (only the feature subset changes, so the plan does
not grow); importances come back as one small vector per fit.  Missing values
(null or NaN) are the median of the rows that the fit sees, as in every other
model; a feature without any value is constant.
"""

from __future__ import annotations

import statistics
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.rank import quantiles
from featureforge.ml.models import SEED, bootstrap


def medians(rows: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact median of each feature, 0 for one without values."""
    found = quantiles(rows, {f: F.col(f) for f in features}, [0.5])
    return {f: found[f][0] if found[f] else 0.0 for f in features}


def filled(rows: DataFrame, fills: dict[str, float]) -> DataFrame:
    """Null and NaN features replaced; a lazy projection."""
    def value(f):
        x = F.col(f).cast("double")
        return F.coalesce(F.when(~F.isnan(x), x), F.lit(float(fills[f])))
    return rows.withColumns({f: value(f) for f in fills})


def _forest(features, trees=50, bootstrap=True, seed=SEED):
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_sel_features", handleInvalid="keep"),
        RandomForestClassifier(featuresCol="_sel_features", labelCol="label", numTrees=trees, seed=seed,
                               bootstrap=bootstrap, featureSubsetStrategy="sqrt", maxDepth=10)])


def importances(train: DataFrame, features: Sequence[str], trees: int = 50, bootstrap: bool = True,
                seed: int = SEED) -> dict:
    m = _forest(features, trees, bootstrap, seed).fit(train)
    return dict(zip(features, map(float, m.stages[-1].featureImportances.toArray())))


def rfe(train: DataFrame, features: Sequence[str], n_select: int, step: int = 1,
        trees: int = 50) -> DataFrame:
    """Refit the forest and drop the ``step`` least important features
    until ``n_select`` remain; ranking 1 = selected, then elimination order
    reversed (like RFE.ranking_)."""
    train = filled(train.select(*features, "label"), medians(train, features)).cache()
    current, eliminated = list(features), []
    while len(current) > n_select:
        imp = importances(train, current, trees)
        k = min(step, len(current) - n_select)
        drop = sorted(current, key=lambda f: (imp[f], f))[:k]
        eliminated.append(drop)
        current = [f for f in current if f not in drop]
    train.unpersist()
    rows = [(f, 1, True) for f in current]
    for i, group in enumerate(reversed(eliminated)):
        rows += [(f, i + 2, False) for f in group]
    spark = train.sparkSession
    return spark.createDataFrame(rows, "feature string, ranking int, selected boolean")


def rfe_cv(train: DataFrame, features: Sequence[str], fold_col: str = "fold", folds: int = 3,
           step: int = 2, trees: int = 30) -> DataFrame:
    """The RFE ranking, then the subset size with the best mean CV AUC
    (each size scored by a forest on the top-ranked features, per fold)."""
    ranking = {r["feature"]: r["ranking"] for r in rfe(train, features, 1, step, trees).collect()}
    order = sorted(features, key=lambda f: (ranking[f], f))
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", numBins=0)
    sizes = range(1, len(order) + 1, step)

    def fold_aucs(f):
        tr, ho = train.where(F.col(fold_col) != f), train.where(F.col(fold_col) == f)
        fills = medians(tr, features)
        tr, ho = filled(tr.select(*features, "label"), fills), filled(ho.select(*features, "label"), fills)
        return [ev.evaluate(_forest(order[:size], trees).fit(tr).transform(ho)) for size in sizes]

    with ThreadPoolExecutor(max_workers=4) as pool:
        aucs = list(pool.map(fold_aucs, range(folds)))
    rows = [(size, float(sum(of_size) / folds)) for size, of_size in zip(sizes, zip(*aucs))]
    best = max(rows, key=lambda t: (t[1], -t[0]))[0]
    spark = train.sparkSession
    return spark.createDataFrame([(s, a, s == best) for s, a in rows],
                                 "n_features int, cv_auc double, best boolean")


def select_from_model(train: DataFrame, features: Sequence[str], estimator: str = "random_forest",
                      threshold: str | float = "mean", alpha: float = 0.01) -> DataFrame:
    """Keep features whose importance (forest, extra trees) or |lasso
    coefficient| is >= threshold ('mean', 'median' or a number)."""
    train = filled(train.select(*features, "label"), medians(train, features))
    if estimator == "lasso":
        m = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_l1", handleInvalid="keep"),
                             LinearRegression(featuresCol="_l1", labelCol="label", regParam=alpha,
                                              elasticNetParam=1.0, standardization=True)]).fit(train)
        score = dict(zip(features, map(abs, m.stages[-1].coefficients.toArray())))
    else:
        score = importances(train, features, 50, bootstrap=(estimator != "extra_trees"))
    vals = list(score.values())
    t = (statistics.fmean(vals) if threshold == "mean" else statistics.median(vals)
         if threshold == "median" else float(threshold))
    rows = [(f, float(score[f]), bool(float(score[f]) >= t)) for f in features]
    return train.sparkSession.createDataFrame(rows, "feature string, score double, selected boolean")


def stability_selection(train: DataFrame, features: Sequence[str], n_bootstrap: int = 100,
                        sample_fraction: float = 0.8, threshold: float = 0.6, trees: int = 50,
                        seed: int = SEED) -> DataFrame:
    """Bootstrap samples (Poisson draws from the row's id) -> forest -> a
    feature votes when its importance >= the median; keep frequency >= threshold.
    The fits run side by side."""
    votes = {f: 0 for f in features}
    base = filled(train.select("id", *features, "label"), medians(train, features)).cache()

    def fit(i):
        return importances(bootstrap(base, seed + i, mean=sample_fraction), features, trees, seed=seed + i)

    with ThreadPoolExecutor(max_workers=4) as pool:
        for imp in pool.map(fit, range(n_bootstrap)):
            med = statistics.median(imp.values())
            for f, v in imp.items():
                votes[f] += int(v >= med)
    base.unpersist()
    rows = [(f, votes[f] / n_bootstrap, bool(votes[f] / n_bootstrap >= threshold)) for f in features]
    return train.sparkSession.createDataFrame(rows, "feature string, frequency double, selected boolean")
