"""Boosting, target statistics, tree explanations and search against direct computations."""

import heapq
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.ml import models as M
from featureforge.ml.boosting import NB, BoostedTrees, Tree, best_split, settings
from featureforge.ml.search import Choice, Range, search
from featureforge.ml.target_stats import full_target_stats, ordered_target_stats
from featureforge.ml.treeshap import ensemble_values, explain_trees

COLS = ["a", "b", "c"]


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def points():
    """(2000 x 3, labels): ties, a few distinct values, missing values."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=2000), rng.integers(0, 9, 2000).astype(float), np.round(rng.exponential(size=2000), 1)])
    y = (x[:, 0] + 0.5 * (x[:, 1] > 4) - 0.7 * x[:, 2] * (x[:, 0] > 0) + rng.normal(scale=0.5, size=2000) > 0).astype(float)
    x[rng.random(2000) < 0.1, 1] = np.nan
    return x, y


@pytest.fixture(scope="module")
def frame(spark, points):
    x, y = points
    rows = [(i, *(None if math.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(3).persist()


def cuts_of(x, max_bins):
    out = []
    for j in range(x.shape[1]):
        v = x[:, j][~np.isnan(x[:, j])]
        q = np.quantile(v, [i / max_bins for i in range(1, max_bins)])
        out.append(sorted(set(q[q < v.max()])))
    return out


def brute_tree(x, y, margin, cuts, p, growth):
    """Leaf weight of each row, by trying every cut on the rows of every leaf."""
    q = 1 / (1 + np.exp(-margin))
    g, h = q - y, q * (1 - q)

    def score(a, b):
        t = max(abs(a) - p["reg_alpha"], 0)
        return t * t / (b + p["reg_lambda"]) if b + p["reg_lambda"] > 0 else 0.0

    def best(rows):
        top = (-math.inf,)
        for j, own in enumerate(cuts):
            v = x[rows, j]
            for cut in own:
                for side in (True, False) if np.isnan(v).any() else (True,):
                    left = np.where(np.isnan(v), side, v <= cut)
                    a, b = rows[left], rows[~left]
                    if min(len(a), len(b)) < p["min_samples_leaf"] or min(h[a].sum(), h[b].sum()) < p["min_child_weight"]:
                        continue
                    gain = 0.5 * (score(g[a].sum(), h[a].sum()) + score(g[b].sum(), h[b].sum()) - score(g[rows].sum(), h[rows].sum()))
                    if gain > top[0] + 1e-9:
                        top = (gain, a, b)
        return top

    leaves, out = [], np.zeros(len(y))
    start = np.arange(len(y))
    if growth == "level":
        level = [start]
        for _ in range(p["max_depth"]):
            following = []
            for rows in level:
                b = best(rows)
                following += [b[1], b[2]] if b[0] > 1e-12 else []
                leaves += [] if b[0] > 1e-12 else [rows]
            level = following
        leaves += level
    else:
        first = best(start)
        queue, n = [(-first[0], 0, start, first)], 1
        while queue and len(queue) + len(leaves) < p["max_leaves"]:
            _, _, rows, b = heapq.heappop(queue)
            if b[0] <= 1e-12:
                leaves.append(rows)
                continue
            for child in b[1:]:
                heapq.heappush(queue, (-best(child)[0], n, child, best(child)))
                n += 1
        leaves += [rows for _, _, rows, _ in queue]
    for rows in leaves:
        s = g[rows].sum()
        out[rows] = -p["learning_rate"] * math.copysign(max(abs(s) - p["reg_alpha"], 0), s) / (h[rows].sum() + p["reg_lambda"])
    return out


def test_counting_both_children_gives_the_same_trees(frame, monkeypatch):
    """Without kept histograms no sibling is taken from its parent."""
    import featureforge.ml.boosting as B
    a = BoostedTrees("lightgbm", COLS, n_estimators=1, max_leaves=9).fit(frame)
    monkeypatch.setattr(B, "KEEP_BYTES", 0)
    assert BoostedTrees("lightgbm", COLS, n_estimators=1, max_leaves=9).fit(frame).fitted == a.fitted


@pytest.mark.parametrize("kind, params", [
    ("xgboost", {"max_depth": 3}), ("xgboost", {"max_depth": 3, "reg_alpha": 2.0, "reg_lambda": 5.0, "min_child_weight": 20.0}),
    ("lightgbm", {"max_leaves": 12}), ("lightgbm", {"max_leaves": 7, "min_samples_leaf": 200})])
def test_trees_equal_direct_growth(frame, points, kind, params):
    x, y = points
    p = settings(kind, {"max_bins": 16, "n_estimators": 2, **params})
    model = BoostedTrees(kind, COLS, max_bins=16, n_estimators=2, **params).fit(frame)
    margin = np.full(len(y), model.base)
    for tree in model.trees:
        want = brute_tree(x, y, margin, cuts_of(x, 16), p, p["growth"])
        t = tree.arrays()
        got = t.value[t.leaves(x)]
        assert np.allclose(got, want, atol=1e-6)
        margin += got
    rows = {r["id"]: r["p"] for r in model.transform(frame).select("id", M.p1(kind).alias("p")).collect()}
    assert np.allclose([rows[i] for i in range(len(y))], 1 / (1 + np.exp(-margin)), atol=1e-9)


def test_symmetric_trees(frame, points):
    x, y = points
    model = BoostedTrees("catboost", COLS, max_bins=16, n_estimators=2, max_depth=3).fit(frame)
    margin, cuts = np.zeros(len(y)), cuts_of(x, 16)
    for tree in model.trees:
        q = 1 / (1 + np.exp(-margin))
        g, h, leaf = q - y, q * (1 - q), np.zeros(len(y), int)
        for _ in range(3):
            def gain(j, cut):
                own = leaf * 2 + ~(np.isnan(x[:, j]) | (x[:, j] <= cut))
                return sum(g[own == k].sum() ** 2 / (h[own == k].sum() + 3.0) for k in set(own))
            _, j, cut = max((gain(j, cut), -j, -cut) for j in range(3) for cut in cuts[j])
            leaf = leaf * 2 + ~(np.isnan(x[:, -j]) | (x[:, -j] <= -cut))
        want = np.zeros(len(y))
        for k in set(leaf):
            want[leaf == k] = -0.1 * g[leaf == k].sum() / (h[leaf == k].sum() + 3.0)
        t = tree.arrays()
        assert np.allclose(t.value[t.leaves(x)], want, atol=1e-6)
        assert len(set(zip(tree.feature, tree.bin)) - {(-1, -1)}) <= 3
        margin += want


@pytest.mark.parametrize("kind", M.BOOSTED)
def test_loss_falls_and_partitions_do_not_matter(frame, kind):
    params = {"n_estimators": 3, "max_depth": 2, "subsample": 0.8, "colsample_bytree": 0.7, "max_bins": 32}
    a = BoostedTrees(kind, COLS, **params).fit(frame)
    b = BoostedTrees(kind, COLS, **params).fit(frame.repartition(7, "c"))
    assert a.fitted["trees"] == b.fitted["trees"]
    losses = [x for x, _ in BoostedTrees(kind, COLS, n_estimators=11, max_depth=2).fit(frame).losses]  # margins are stored once
    assert len(losses) == 12 and all(x > y for x, y in zip(losses, losses[1:]))


def test_early_stopping_keeps_the_best_round(frame):
    noise = frame.withColumn("label", (F.xxhash64("id") % 2 == 0).cast("double")).withColumn("is_valid", F.col("id") % 3 == 0)
    model = M.fit_with_early_stopping(noise, COLS, "xgboost", rounds=3, max_depth=2).stages[-1]
    valid = [v for _, v in model.losses]
    assert len(model.trees) == int(np.argmin(valid[:-1] if len(valid) > len(model.trees) + 1 else valid))
    assert len(model.trees) < 30


def test_empty_and_constant_tables(spark, frame):
    model = BoostedTrees("lightgbm", COLS, n_estimators=2).fit(frame.where("id < 0"))
    assert model.trees == [] and model.transform(frame).count() == 2000
    one = frame.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double")).withColumn("c", F.lit(2.0))
    for kind in M.BOOSTED:
        trees = BoostedTrees(kind, COLS, n_estimators=2).fit(one).trees
        assert all(len(t.left) <= 3 for t in trees)


def test_unknown_parameters_raise():
    with pytest.raises(ValueError):
        settings("xgboost", {"depthh": 3})


def test_split_of_a_histogram_with_missing_rows():
    hist = np.zeros((3, NB), np.int64)
    hist[:, 0], hist[:, 1], hist[:, 255] = (-10, 10, 10), (10, 10, 10), (10, 10, 10)
    b = best_split(hist, settings("xgboost", {}), 1.0)
    assert (b["bin"], b["missing_left"], b["left"].tolist(), b["right"].tolist()) == (0, False, [-10, 10, 10], [20, 20, 20])


# ------------------------------------------------------------------ target statistics
def test_ordered_target_stats(spark):
    import hashlib
    rows = [(i, ["hot", "hot", None, f"c{i % 5}"][i % 4], float(i % 3 == 0)) for i in range(400)]
    got = {r["id"]: r["cat_ots"] for r in ordered_target_stats(
        spark.createDataFrame(rows, "id long, cat string, label double"), ["cat"]).collect()}
    mean, seen = sum(r[2] for r in rows) / len(rows), {}
    for i, cat, y in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|42".encode()).hexdigest()):
        s, n = seen.get(cat, (0.0, 0))
        assert got[i] == pytest.approx((s + mean) / (n + 1), abs=1e-12)
        seen[cat] = (s + y, n + 1)
    full = full_target_stats(spark.createDataFrame(rows, "id long, cat string, label double"), ["cat"])["cat"]
    assert full["hot"] == pytest.approx((seen["hot"][0] + mean) / (seen["hot"][1] + 1)) and full[""] == pytest.approx(mean)


def test_ordered_target_stats_do_not_leak(spark):
    """A category of its own for every second row and labels by chance: no signal in training."""
    df = spark.range(3000).select("id", F.concat(F.lit("c"), F.col("id") % 1500).alias("cat"),
                                  (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2))).cast("double").alias("label"))
    rows = ordered_target_stats(df, ["cat"]).select("cat_ots", "label").collect()
    v, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    order = np.argsort(np.argsort(v))
    ranks = np.array([order[v == x].mean() for x in np.unique(v)])[np.searchsorted(np.unique(v), v)]
    n1 = y.sum()
    auc = (ranks[y == 1].sum() - n1 * (n1 - 1) / 2) / n1 / (len(y) - n1)
    assert abs(auc - 0.5) < 0.04
    model = BoostedTrees("catboost", ["cat"], n_estimators=5, cat_features=("cat",)).fit(df)
    assert model.transform(df.withColumn("cat", F.lit("new"))).select(M.p1("catboost").alias("p")).distinct().count() == 1


# ------------------------------------------------------------------ explanations
def enumerated(tree: Tree, x):
    """Shapley values of one row from the expectations over all subsets of features."""
    names = sorted({f for f in tree.feature if f >= 0})
    m = x.shape[0]

    def expect(node, known):
        if tree.left[node] < 0:
            return tree.value[node]
        l, r = tree.left[node], tree.right[node]
        if tree.feature[node] in known:
            v = x[tree.feature[node]]
            return expect(l if (tree.missing_left[node] if math.isnan(v) else v <= tree.threshold[node]) else r, known)
        total = tree.cover[l] + tree.cover[r]
        return (tree.cover[l] * expect(l, known) + tree.cover[r] * expect(r, known)) / total

    out = np.zeros(m)
    for f in names:
        others = [o for o in names if o != f]
        for k in range(len(others) + 1):
            w = math.factorial(k) * math.factorial(len(names) - k - 1) / math.factorial(len(names))
            out[f] += w * sum(expect(0, {*s, f}) - expect(0, set(s)) for s in itertools.combinations(others, k))
    return out


def test_tree_values_equal_the_enumeration(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] - x[:, 3] * x[:, 4] + x[:, 5:].sum(1)) > 0).astype(float)
    x[rng.random(x.shape) < 0.05] = np.nan
    cols = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *(None if math.isnan(v) else float(v) for v in r), float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "id long, " + ", ".join(f"{c} double" for c in cols) + ", label double")
    model = M.make_pipeline("lightgbm", cols, n_estimators=3, max_leaves=20, min_samples_leaf=5).fit(df)
    trees = model.stages[-1].trees
    values, base = ensemble_values(trees, x[:12], model.stages[-1].base)
    want = sum(np.array([enumerated(t, row) for row in x[:12]]) for t in trees)
    assert np.allclose(values, want, atol=1e-10)
    told, base2 = explain_trees(model, df, cols)
    sums = {r["id"]: r["s"] for r in told.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    p = {r["id"]: r["p"] for r in model.transform(df).select("id", M.p1("lightgbm").alias("p")).collect()}
    assert base2 == pytest.approx(base)
    assert all(1 / (1 + math.exp(-(base + sums[i]))) == pytest.approx(p[i], abs=1e-9) for i in p)


def test_paths_with_more_features_than_the_table(monkeypatch):
    import featureforge.ml.treeshap as S
    tree = Tree()
    tree.add(10.0)
    node = 0
    for f in range(6):
        left, right = tree.split(node, {"feature": f, "bin": 0, "missing_left": f % 2 == 0, "gain": 1.0, "hl": 7 - f, "hr": 1 + f}, 0.1 * f, 1.0)
        tree.value[left], tree.value[right], node = f - 2.0, f * 0.5, left
    x = np.random.default_rng(1).normal(size=(20, 6))
    want = np.array([enumerated(tree, row) for row in x])
    assert np.allclose(ensemble_values([tree], x)[0], want)
    monkeypatch.setattr(S, "TABLE_FEATURES", 2)
    assert np.allclose(ensemble_values([tree], x)[0], want)


def test_forest_values_add_up(frame):
    rows = frame.fillna(0.0)
    model = M.make_pipeline("random_forest", COLS, n_estimators=4, max_depth=4).fit(rows)
    told, base = explain_trees(model, rows, COLS)
    sums = {r["id"]: r["s"] for r in told.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    for r in model.transform(rows).select("id", M.p1("random_forest").alias("p")).collect():
        assert base + sums[r["id"]] == pytest.approx(r["p"], abs=1e-9)


# ------------------------------------------------------------------ search
SPACE = {"x": Range(-5.0, 5.0), "n": Range(1, 50, whole=True), "rate": Range(1e-4, 1.0, log=True), "how": Choice(("a", "b", "c"))}


def planted(p):
    return -((p["x"] - 2) ** 2) - ((p["n"] - 30) / 10) ** 2 - (math.log10(p["rate"]) + 2) ** 2 + (p["how"] == "b")


def test_search_repeats_and_beats_random_draws():
    a, b = search(SPACE, planted, 40, seed=1), search(SPACE, planted, 40, seed=1)
    assert a.trials == b.trials
    assert all(isinstance(t["n"], int) and 1 <= t["n"] <= 50 and 1e-4 <= t["rate"] <= 1 for t, _ in a.trials)
    better = [search(SPACE, planted, 50, seed=s).best[1] for s in range(30)]
    random = [search(SPACE, planted, 50, seed=s, startup=50).best[1] for s in range(30)]
    assert np.mean(better) > np.mean(random) and sum(x > y for x, y in zip(better, random)) >= 20


def test_every_kind_has_a_space_that_its_model_takes():
    for kind, space in M.SEARCH_SPACES.items():
        sampler = search(space, lambda p: 0.0, 12)
        for params, _ in sampler.trials:
            M.make_pipeline(kind, COLS, n_rows=100, **params)


def test_tuned_model_is_the_best_trial(frame):
    rows = frame.fillna(0.0).withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(2)))
    model, trials, params = M.tune(rows, COLS, "catboost", n_trials=3, startup=2, parallelism=3,
                           space={"depth": Range(2, 3, whole=True), "l2_leaf_reg": Range(1.0, 10.0), "iterations": Range(2, 4, whole=True)})
    got = trials.collect()
    assert len(got) == 3 and all(0.6 < r["cv_auc"] <= 1 for r in got)
    best = eval(max(got, key=lambda r: r["cv_auc"])["params"])
    assert len(model.stages[-1].trees) == best["iterations"] == params["iterations"]


def test_blocks_keep_the_partitions_of_the_rows(spark):
    """Small blocks are not packed into fewer tasks than the rows had."""
    from featureforge.ml import boosting
    df = spark.range(0, 600, 1, 6).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("label"))
    rows = boosting.Rows(df, ["x"], [[100.0, 300.0]], boosting.settings("xgboost", {}))
    assert rows.n == 600 and rows.blocks.rdd.getNumPartitions() == 6
    rows.release()
