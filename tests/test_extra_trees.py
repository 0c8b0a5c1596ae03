"""Extra trees: direct growth, seeds, partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.ml import models as M
from featureforge.ml.boosting import uniforms
from featureforge.ml.extratrees import TREE_NODES, ExtraTrees, drawn_features, scores
from featureforge.ml.treeshap import explain_trees

COLS = ["a", "b", "c", "d"]


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 5, 700), np.full(700, 3.0), rng.exponential(size=700)])
    y = (x[:, 0] + (x[:, 1] > 2) - x[:, 3] + rng.normal(scale=0.4, size=700) > 0).astype(int)
    x[rng.random(700) < 0.1, 3] = np.nan
    return x, y


@pytest.fixture(scope="module")
def frame(spark, points):
    x, y = points
    rows = [(i, *(None if np.isnan(v) else float(v) for v in r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label int").repartition(3).persist()


def grown(x, y, t, depth, take, seed):
    """{node number: (feature, threshold)} of tree ``t``, numbered as the forest numbers them."""
    out, level, n = {}, [(0, np.arange(len(y)))], 1
    for _ in range(depth):
        following = []
        for node, rows in level:
            name = np.array([t * TREE_NODES + node])
            if len(rows) < 2 or y[rows].min() == y[rows].max():
                continue
            best = None
            for f in drawn_features(name, x.shape[1], take, seed)[0]:
                v = x[rows, f][~np.isnan(x[rows, f])]
                if len(v) and v.min() < v.max():
                    cut = min(v.min() + uniforms(name, seed, 2 * int(f) + 1)[0] * (v.max() - v.min()), np.nextafter(v.max(), -np.inf))
                    left = x[rows, f] <= cut
                    parts = [y[rows[left]], y[rows[~left]]]
                    if min(map(len, parts)) > 0:
                        impurity = sum(p.sum() * (len(p) - p.sum()) / len(p) for p in parts)
                        if best is None or (impurity, f) < best[:2]:
                            best = (impurity, f, cut, left)
            if best:
                out[node] = (best[1], best[2])
                following += [(n, rows[best[3]]), (n + 1, rows[~best[3]])]
                n += 2
        level = following
    return out


def test_forest_equals_direct_growth(frame, points):
    x, y = points
    model = ExtraTrees(COLS, n_estimators=3, max_depth=5, max_features=2, seed=7).fit(frame)
    for t, tree in enumerate(model.trees):
        want = grown(x, y, t, 5, 2, 7)
        got = {k: (tree.feature[k], tree.threshold[k]) for k in range(len(tree.left)) if tree.left[k] >= 0}
        assert {k: f for k, (f, _) in got.items()} == {k: f for k, (f, _) in want.items()}
        assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-12) for k in want)
        leaf = tree.arrays().leaves(x)
        assert all(tree.value[k] * 3 == pytest.approx(y[leaf == k].mean()) for k in set(leaf))
    p = {r["id"]: r["p"] for r in model.transform(frame).select("id", M.p1("extra_trees").alias("p")).collect()}
    assert np.allclose([p[i] for i in range(len(y))], scores(model.trees, x))


def test_seeds_and_partitions(frame):
    a = ExtraTrees(COLS, n_estimators=4, max_depth=4, seed=1).fit(frame)
    assert a.fitted == ExtraTrees(COLS, n_estimators=4, max_depth=4, seed=1).fit(frame.repartition(6, "b")).fitted
    assert a.fitted != ExtraTrees(COLS, n_estimators=4, max_depth=4, seed=2).fit(frame).fitted
    assert a.featureImportances.toArray().sum() == pytest.approx(1.0) and a.featureImportances[2] == 0


def test_in_a_pipeline_with_explanations(frame):
    model = M.make_pipeline("extra_trees", COLS, n_estimators=5, max_depth=4).fit(frame)
    told, base = explain_trees(model, frame, COLS)
    sums = {r["id"]: r["s"] for r in told.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    for r in M.predictions(model, frame, "extra_trees").collect():
        assert base + sums[r["id"]] == pytest.approx(r["p1"], abs=1e-9)


def test_empty_and_single_class(frame):
    assert ExtraTrees(COLS, n_estimators=2).fit(frame.where("id < 0")).trees == []
    trees = ExtraTrees(COLS, n_estimators=2).fit(frame.where("label = 1")).trees
    assert all(len(t.left) == 1 and t.value[0] == 0.5 for t in trees)


def test_blocks_keep_partitions_and_the_open_node_of_each_row(frame, points, monkeypatch):
    """Every partition of the rows works on the levels, and rows are not walked from the root again."""
    from featureforge.ml import extratrees
    seen = []

    class Watched(extratrees.ExtraForest):
        def level(self):
            seen.append((self.blocks.rdd.getNumPartitions(), sorted(self.open)))
            super().level()
            if len(seen) == 3:
                seen.append([(r["n"], r["x"], r["at"]) for r in self.blocks.collect()])

    monkeypatch.setattr(extratrees, "ExtraForest", Watched)
    model = ExtraTrees(COLS, n_estimators=2, max_depth=3, max_features=2, seed=7).fit(frame.repartition(6, "id"))
    *levels, blocks = seen
    assert [n for n, _ in levels] == [6, 6, 6] and sum(n for n, _, _ in blocks) == 700
    for t, tree in enumerate(model.trees):
        opened = [k - t * TREE_NODES for k in levels[2][1] if k // TREE_NODES == t]
        walked = tree.arrays()
        below = {c: k for k in opened for c in (walked.left[k], walked.right[k]) if c >= 0}
        for n, x, at in blocks:
            leaf = walked.leaves(np.frombuffer(x, float).reshape(len(COLS), n).T).tolist()
            at = np.frombuffer(at, np.uint16).reshape(2, n)[t].tolist()
            assert [below.get(k, k) for k in leaf] == [opened[a] if a < 65535 else k for a, k in zip(at, leaf)]
