"""Bags: medians of all samples in the same passes, vectors made once, the same models as fits one by one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.functions import rank
from featureforge.ml import models as M

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    x = [(F.xxhash64(F.col("id"), F.lit(k)) % m) for k, m in enumerate((1000, 7, 3))]
    df = spark.range(0, 800, 1, 3).select(
        "id", F.when(F.col("id") % 5 > 0, x[0] / 3.0).alias("a"), F.when(F.col("id") % 11 > 0, x[1]).alias("b"),
        x[2].cast("double").alias("c"), ((x[0] > 200) != (x[1] > 0)).cast("int").alias("label")).persist()
    df.count()
    yield df
    df.unpersist()


def test_medians_and_vectors_are_not_made_anew_by_each_pass_of_a_bag(spark, rows, monkeypatch):
    want = {f"decision_tree_bag{i}": M.fit_spec(M.bootstrap(rows, 42 + i), FEATURES, f"decision_tree_bag{i}", ("decision_tree", {}))
            for i in range(3)}
    asked, stored, plain, fit = [], [], rank.quantiles, M.DecisionTreeClassifier._fit
    monkeypatch.setattr(rank, "quantiles", lambda *a, **k: (asked.append(1), plain(*a, **k))[1])
    monkeypatch.setattr(M.DecisionTreeClassifier, "_fit", lambda self, df: (stored.append(df.storageLevel.useMemory), fit(self, df))[1])
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    got = M.bagging(rows, FEATURES, "decision_tree", n=3)
    assert asked == [] and stored == [True] * 3    # before: medians of each bag by itself, its rows imputed and assembled in every pass
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert list(got) == list(want)
    for name, model in want.items():
        assert [type(s) for s in got[name].stages] == [type(s) for s in model.stages]
        assert got[name].stages[0].fitted == model.stages[0].fitted
        lines = [m.stages[-1].toDebugString.split("\n")[1:] for m in (got[name], model)]
        assert lines[0] == lines[1] and len(lines[0]) > 20
    out = M.bagging_predict(got, rows).select("id", "bagging_ensemble_p1")
    assert {r[0]: r[1] for r in out.collect()} == {r[0]: r[1] for r in M.bagging_predict(want, rows).select(
        "id", "bagging_ensemble_p1").collect()}


def test_bags_of_forests_and_of_boosted_trees(rows):
    for kind, params in (("random_forest", {"n_estimators": 2, "max_depth": 3}), ("xgboost", {"n_estimators": 2, "max_depth": 2})):
        got = M.bagging(rows, FEATURES, kind, n=2, **params)
        want = M.fit_spec(M.bootstrap(rows, 43), FEATURES, f"{kind}_bag1", (kind, params))
        assert [s.fitted for s in got[f"{kind}_bag1"].stages] == [s.fitted for s in want.stages]


def test_draws_in_arrays_are_the_draws_of_the_sample(spark):
    df = spark.range(0, 4000, 1, 2).withColumn("h", F.xxhash64("id", F.lit(7)))
    told = df.toPandas()
    for mean in (1.0, 0.8):
        got = dict(zip(told["id"], M.times_drawn(told["h"].to_numpy(), mean)))
        want = {r["id"]: r["count"] for r in M.bootstrap(df, 7, mean=mean).groupBy("id").count().collect()}
        assert {i: n for i, n in got.items() if n} == want and max(want.values()) > 3


def test_weighted_quantiles_are_those_of_the_repeated_rows(spark):
    h = F.xxhash64("id")
    df = spark.range(0, 6000, 1, 3).select(
        "id", (h / 1e9).alias("wide"), (h % 90).alias("whole"), F.lit(3.5).alias("same"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, -0.0).otherwise(h % 5 / 10.0).alias("crowded"),
        F.when(F.col("id") == 17, float("inf")).when(F.col("id") < 40, (h % 100) * 1e-300).alias("far")).persist()
    names, qs, seeds = df.columns[1:], [0.0, 0.1, 0.25, 0.5, 0.77, 0.9], (1, 2, 3)
    exprs = {c: F.col(c) for c in names}
    samples = [F.xxhash64("id", F.lit(s)) for s in seeds]
    want = [rank.quantiles(M.bootstrap(df, s), exprs, qs) for s in seeds]
    for finish_rows, hist_bytes in ((rank.FINISH_ROWS, rank.HIST_BYTES), (0, 4000), (50, 1 << 20)):
        assert rank.weighted_quantiles(df, exprs, samples, M.times_drawn, qs, finish_rows, hist_bytes) == want
    nobody = rank.weighted_quantiles(df, exprs, samples[:1], np.zeros_like, qs)
    assert nobody == [dict.fromkeys(names)]
    df.unpersist()
