"""k-nearest-neighbour joins against all distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.ml import knn


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def brute(q, p, k):
    """{query id: [(distance, id)]} by all pairs."""
    out = {}
    for i, v in q:
        if any(x is None or math.isnan(x) for x in v):
            continue
        every = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), j) for j, w in p
                       if not any(x is None or math.isnan(x) for x in w))
        out[i] = every[:k]
    return out


def frames(spark, q, p):
    kind = "id long, " + ", ".join(f"x{j} double" for j in range(len(p[0][1])))
    return (spark.createDataFrame([(i, *v) for i, v in q], kind).repartition(3),
            spark.createDataFrame([(i, *v) for i, v in p], kind).repartition(4))


def clustered(n, d, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(scale=20, size=(6, d))
    return [(i, tuple(map(float, np.round(centre[i % 6] + rng.normal(size=d), 2)))) for i in range(n)]


@pytest.mark.parametrize("block, pivots", [(4096, None), (40, 9), (25, 1)])
def test_join_equals_all_pairs(spark, block, pivots):
    p = clustered(600, 3, 1) + [(1000 + i, (1.0, 1.0, 1.0)) for i in range(120)]  # a hot point
    p += [(2000, (float("nan"), 0.0, 0.0)), (2001, (None, 1.0, 1.0))]
    q = clustered(90, 3, 2) + [(500, (1.0, 1.0, 1.0)), (501, (None, 0.0, 0.0)), (502, (1e6, 0.0, 0.0))]
    left, right = frames(spark, q, p)
    got = {r["qid"]: [(x["distance"], x["id"]) for x in r["near"]] for r in
           knn.knn_join(left, right, ["x0", "x1", "x2"], 7, block=block, n_pivots=pivots).collect()}
    want = brute(q, p, 7)
    assert got.keys() == want.keys()
    for i in want:
        assert [x for _, x in got[i]] == [x for _, x in want[i]] and np.allclose([d for d, _ in got[i]], [d for d, _ in want[i]])


def test_bounds_prune_cells(spark, monkeypatch):
    """On clustered points a query compares with few of them."""
    seen = spark.sparkContext.accumulator(0)
    real = knn._visits

    def counted(*args):
        out = real(*args)
        seen.add(out.count())
        return out

    monkeypatch.setattr(knn, "_visits", counted)
    left, right = frames(spark, clustered(60, 2, 4), clustered(2000, 2, 5))
    assert knn.knn_join(left, right, ["x0", "x1"], 3).count() == 60
    assert seen.value < 60 * 44 / 4  # of 44 cells a query visits fewer than a quarter


def test_few_points_and_none(spark):
    left, right = frames(spark, clustered(5, 2, 1), clustered(2, 2, 2))
    assert all(len(r["near"]) == 2 for r in knn.knn_join(left, right, ["x0", "x1"], 4).collect())
    assert knn.knn_join(left, right.where("id < 0"), ["x0", "x1"], 4).collect() == []
    assert knn.knn_join(left.where("id < 0"), right, ["x0", "x1"], 4).collect() == []


def test_impute_by_pattern(spark):
    rows = [(i, None if i % 7 == 0 else i * 1.0, None if i % 11 == 0 else i * 2.0, float(i % 5)) for i in range(120)] + [(500, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double").withColumn("note", F.lit("kept"))
    got = {r["id"]: r for r in knn.knn_impute(df, ["a", "b", "c"], k=3).collect()}
    cols, means = "abc", [np.mean([r[j] for r in rows if r[j] is not None]) for j in (1, 2, 3)]
    for r in rows:
        have = [j for j in range(3) if r[j + 1] is not None]
        for j in range(3):
            if r[j + 1] is not None:
                want = r[j + 1]
            else:
                donors = sorted((math.sqrt(sum((r[m + 1] - o[m + 1]) ** 2 for m in have)), o[0], o[j + 1]) for o in rows
                                if o[j + 1] is not None and all(o[m + 1] is not None for m in have)) if have else []
                want = np.mean([x for _, _, x in donors[:3]]) if donors else means[j]
            assert got[r[0]][cols[j]] == pytest.approx(want)
    assert {r["note"] for r in got.values()} == {"kept"}


def test_equal_points_and_queries_are_searched_once(spark, monkeypatch):
    """Of 900 equal points only k can be found, and 300 equal queries have one answer."""
    seen = []
    real = knn._nearest

    def counted(visits, points, *args):
        seen.append((visits.count(), points.count()))
        return real(visits, points, *args)

    monkeypatch.setattr(knn, "_nearest", counted)
    p = [(i, (float(i % 3), 1.0)) for i in range(900)]
    q = [(i, (0.25, 1.0)) for i in range(300)] + [(900, (1.0, 1.0))]
    left, right = frames(spark, q, p)
    got = {r["qid"]: [(x["distance"], x["id"]) for x in r["near"]] for r in knn.knn_join(left, right, ["x0", "x1"], 4).collect()}
    assert got == {i: [(abs(v[0]), 3 * j) for j in range(4)] if i < 900 else [(0.0, 3 * j + 1) for j in range(4)] for i, v in q}
    assert all(n <= 3 * 4 for _, n in seen) and seen[0][0] == 2


def test_nearest_places_of_rows_with_ties():
    far = np.random.default_rng(3).integers(0, 6, (50, 40)).astype(float)
    for take in (1, 5, 40):
        assert (knn.nearest_of(far, take) == np.argsort(far, axis=1, kind="stable")[:, :take]).all()
