"""Ranking metrics against direct computations on crowded and tied scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.operators import evaluate as V


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def direct(ids, y, p):
    """AUC, average precision, top-decile lift and top-quintile gain by sorting."""
    order = np.lexsort((ids, -p))
    y, p = y[order], p[order]
    cut = np.append(np.flatnonzero(np.diff(p)), len(p) - 1)
    tp, fp = np.cumsum(y)[cut], np.cumsum(1 - y)[cut]
    pos, neg = y.sum(), len(y) - y.sum()
    dtp, dfp = np.diff(tp, prepend=0), np.diff(fp, prepend=0)
    auc = (dtp * (neg - fp + 0.5 * dfp)).sum() / pos / neg
    ap = (dtp / pos * tp / (tp + fp)).sum()
    size = len(y) // 10
    return auc, ap, y[:size].sum() / pos * 10, y[:2 * size].sum() / pos


def crowded(n):
    rng = np.random.default_rng(4)
    p = rng.random(n) * 1e-4
    p[0] = 1.0
    return (rng.random(n) < 0.2 + 4000 * p).astype(int), p


def clumped(n):
    rng = np.random.default_rng(5)
    return (rng.random(n) < 0.3).astype(int), np.where(rng.random(n) < 0.6, 0.25, np.round(rng.random(n), 2))


@pytest.mark.parametrize("make", [crowded, clumped])
@pytest.mark.parametrize("ranked", [20_000, 10])
def test_summary_of_two_models(spark, monkeypatch, make, ranked):
    monkeypatch.setattr(V, "RANKED_ROWS", ranked)
    rows, want = [], {}
    for model, n in (("a", 4000), ("b", 1007)):
        y, p = make(n)
        want[model] = direct(np.arange(n), y, p)
        rows += [(model, i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    pred = spark.createDataFrame(rows, "model string, id long, label int, p1 double").withColumn("prediction", (F.col("p1") > 0.5).cast("int"))
    got = {r["model"]: r for r in V.ranking_summary(pred, ["model"]).collect()}
    for model, (auc, ap, lift, gain) in want.items():
        r = got[model]
        assert (r["roc_auc"], r["precision_recall_auc"], r["top_decile_lift"], r["top_quintile_gain"]) == pytest.approx((auc, ap, lift, gain))
    hist = V.score_histogram(pred, ["model"])
    lift = {r["model"]: r for r in V.lift_summary(V.cumulative_gains(pred, hist, ["model"]), ["model"]).collect()}
    assert all(lift[m]["top_decile_lift"] == pytest.approx(got[m]["top_decile_lift"]) for m in want)


def test_crowded_scores_are_spread_over_ranges(spark):
    """A score far away from all others does not put them in one range."""
    y, p = crowded(5000)
    hist = V.score_histogram(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, p1 double"))
    placed = hist.groupBy(V._range_of(F.col("score"), V.score_cuts(hist)).alias("b")).count().collect()
    assert len(placed) > 200 and max(r["count"] for r in placed) < 5000 / 256 * 3


def test_range_of_counts_points_below(spark):
    points = [float(x) for x in range(0, 100, 2)]
    rows = spark.range(-3, 120).select((F.col("id") / 2).alias("x")).withColumn("b", V._range_of(F.col("x"), points)).collect()
    assert all(r["b"] == sum(p < r["x"] for p in points) for r in rows)
    assert spark.range(1).select(V._range_of(F.lit(None).cast("double"), points).alias("b")).first()["b"] == 0


def test_single_class_and_missing_scores(spark):
    pred = spark.createDataFrame([("a", i, 0, 0.1 * i) for i in range(5)] + [("b", i, i % 2, None) for i in range(4)],
                                 "model string, id long, label int, p1 double").withColumn("prediction", F.lit(0))
    got = {r["model"]: r for r in V.ranking_summary(pred, ["model"]).collect()}
    assert got["a"]["roc_auc"] is None and got["a"]["top_decile_lift"] == 0.0
    assert got["b"]["roc_auc"] == pytest.approx(0.5)


def test_auc_by_key_is_the_window_form(spark):
    """One pass over ranges of scores gives what the running sums give: ties, missing scores, a key of one class."""
    rows = [(f"m{i % 3}", 0 if i % 3 == 2 else int((i * 7919) % 5 > 1), None if i % 23 == 0 else (i * 31 % 40) / 40 + (i % 5 > 1) * 0.1)
            for i in range(600)]
    pred = spark.createDataFrame(rows, "model string, label int, p1 double").repartition(5)
    told = V.auc_by_key(pred, "model")
    want = {r["model"]: r["roc_auc"] for r in V.roc_auc(V.score_histogram(pred, ["model"]), ["model"]).collect()}
    assert want["m2"] is None and told["m2"] is None
    assert set(told) == set(want) and all(abs(told[k] - want[k]) < 1e-12 for k in ("m0", "m1"))
