"""The forest: the same trees however its rows are dealt, few jobs, a plain tree by definition."""

import numpy as np
from pyspark.sql import functions as F

from featureforge.ml import forest
from featureforge.ml import models as M
from featureforge.ml.forest import RandomForest, forest_scores, unpacked


def _rows(spark, n=900, parts=4):
    x = [(F.xxhash64(F.col("id"), F.lit(k)) % 1000).cast("double") for k in range(4)]
    df = spark.range(0, n, 1, parts).select("id", *[v.alias(f"x{k}") for k, v in enumerate(x)])
    return df.withColumn("label", ((F.col("x0") > 100) != (F.col("x1") > 300)).cast("int")).withColumn(
        "x3", F.when(F.col("id") % 7 > 0, F.col("x3"))).withColumn("fold", (F.col("id") % 3).cast("int"))


FEATURES = ["x0", "x1", "x2", "x3"]


def _arrays(df, **params):
    return unpacked(RandomForest(FEATURES, "f", **params).fit(df).fitted["nodes"])


def test_partitions_and_passes_do_not_change_the_forest(spark, monkeypatch):
    """A forest finished from the roots on, and one split by passes over the blocks down to small nodes."""
    one = _arrays(_rows(spark), n_estimators=6, max_depth=7)
    several = _arrays(_rows(spark, parts=1), n_estimators=6, max_depth=7)
    assert all(np.array_equal(one[f], several[f]) for f in one)
    monkeypatch.setattr(forest, "LOCAL_ROWS", 90)
    monkeypatch.setattr(forest, "PASS_BYTES", 4000)
    passes = _arrays(_rows(spark), n_estimators=6, max_depth=7)
    x = np.random.default_rng(1).integers(-999, 1000, (500, 4)).astype(float)
    x[::9, 3] = np.nan
    assert len(passes["left"]) == len(one["left"])
    assert np.array_equal(np.sort(passes["value"]), np.sort(one["value"]))
    assert np.allclose(forest_scores(passes, x), forest_scores(one, x), atol=1e-12)


def test_a_tree_without_draws_is_the_best_tree(spark):
    """Every split is the best one of the node's rows, by trying all cuts."""
    df = _rows(spark, 300)
    rows = RandomForest(FEATURES, "f").rows(df)
    model = RandomForest(FEATURES, "f", n_estimators=1, max_depth=3, max_features="all", bootstrap=False, min_samples_leaf=5).grown(rows)
    cuts = rows.cuts
    rows.release()
    (tree,) = model.trees
    told = df.select(*FEATURES, "label").toPandas()
    x, y = told[FEATURES].to_numpy(float), told["label"].to_numpy()

    def check(node, own, depth):
        assert tree.cover[node] == len(own) and abs(tree.value[node] - y[own].mean()) < 1e-12
        best = 0.0
        gini = lambda r: 2 * y[r].sum() * (len(r) - y[r].sum()) / len(r) if len(r) else 0.0
        for f, cut in enumerate(cuts):
            for c in cut:
                left, right = own[x[own, f] <= c], own[~(x[own, f] <= c)]
                if min(len(left), len(right)) >= 5:
                    best = max(best, gini(own) - gini(left) - gini(right))
        if depth == 3 or best < 1e-9:
            assert tree.left[node] < 0
            return
        assert abs(tree.gain[node] - best) < 1e-9
        goes = x[own, tree.feature[node]] <= tree.threshold[node]
        check(tree.left[node], own[goes], depth + 1)
        check(tree.right[node], own[~goes], depth + 1)

    check(0, np.arange(len(y)), 0)


def test_a_deep_forest_takes_few_jobs(spark):
    """The number of jobs does not grow with the depth (before: a job and more a level)."""
    df, sc = _rows(spark).persist(), spark.sparkContext

    def jobs(depth):
        group = f"forest-{depth}"
        sc.setJobGroup(group, group)
        try:
            model = M.make_pipeline("random_forest", FEATURES, n_estimators=30, max_depth=depth).fit(df)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group)), model

    df.count()
    (few, _), (many, model) = jobs(2), jobs(14)
    assert many <= few + 2
    told = M.predictions(model, df, "random_forest").agg(F.avg((F.col("prediction") == F.col("label")).cast("int")), F.min("p1"), F.max("p1"))
    share, low, high = told.first()
    df.unpersist()
    assert share > 0.95 and 0 <= low < high <= 1


def test_trials_bin_the_rows_once(spark, monkeypatch):
    """What does not depend on the parameters is done once a fold, not once a trial."""
    made, init = [], forest.ForestRows.__init__
    monkeypatch.setattr(forest.ForestRows, "__init__", lambda self, *a, **k: (made.append(1), init(self, *a, **k))[1])
    df = _rows(spark, 300).persist()
    space = {"n_estimators": M.Range(2, 6, whole=True), "max_depth": M.Range(2, 5, whole=True)}
    model, trials, best = M.tune(df, FEATURES, "random_forest", n_trials=4, startup=2, space=space)
    assert trials.count() == 4 and len(made) == 3 + 1
    assert len(model.stages[-1].trees) == best["n_estimators"]
    df.unpersist()
