"""Isolation-forest outlier flag as a Spark job.

fit: ONE scan assigns each row to the trees whose deterministic hash draw
falls below 1.5 x 256 / n (``explode(filter(sequence))``), then
``groupBy(tree_id).applyInPandas`` builds every tree from at most 256 of its
rows (each group is bounded by the sub-sample size); the trees (<= 2 x 256
nodes each, n_trees of them: a proven bound) come back to the driver.
transform: ``mapInPandas`` scores every partition against the broadcast
trees; the threshold is the (1 - contamination) quantile of the training
scores (``percentile_approx``, one aggregate).
"""

from __future__ import annotations

import json
import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.ml.base import StatsEstimator, StatsModel

SAMPLE = 256


def _c(n: float) -> float:
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _build(X: np.ndarray, rng: np.random.Generator, max_depth: int) -> list:
    nodes = []

    def grow(idx, depth):
        nid = len(nodes)
        nodes.append(None)
        sub = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[nid] = [-1, 0.0, -1, -1, len(idx)]
            return nid
        spans = sub.max(axis=0) - sub.min(axis=0)
        cand = np.flatnonzero(spans > 0)
        if len(cand) == 0:
            nodes[nid] = [-1, 0.0, -1, -1, len(idx)]
            return nid
        f = int(rng.choice(cand))
        t = float(rng.uniform(sub[:, f].min(), sub[:, f].max()))
        left = idx[sub[:, f] < t]
        right = idx[sub[:, f] >= t]
        li = grow(left, depth + 1)
        ri = grow(right, depth + 1)
        nodes[nid] = [f, t, li, ri, len(idx)]
        return nid
    grow(np.arange(len(X)), 0)
    return nodes


def _paths(nodes: list, X: np.ndarray) -> np.ndarray:
    """Path length of every row of X in one tree (vectorised, depth by depth)."""
    a = np.asarray(nodes, dtype=float)
    feat, thr = a[:, 0].astype(int), a[:, 1]
    left, right, size = a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]
    leaf_adj = np.array([_c(s) for s in size])
    node = np.zeros(len(X), dtype=int)
    depth = np.zeros(len(X))
    rows = np.arange(len(X))
    active = feat[node] >= 0
    while active.any():
        idx = rows[active]
        f = feat[node[idx]]
        go_left = X[idx, f] < thr[node[idx]]
        node[idx] = np.where(go_left, left[node[idx]], right[node[idx]])
        depth[idx] += 1
        active = feat[node] >= 0
    return depth + leaf_adj[node]


class IsolationModel(StatsModel):
    def apply(self, df, cfg, st):
        feats, trees, thr = cfg["features"], st["trees"], st["threshold"]
        cn = _c(st["psi"])
        fill = st["fill"]

        def score(it):
            for pdf in it:
                X = pdf[feats].astype(float).fillna(pd.Series(fill)).to_numpy()
                h = (np.mean([_paths(t, X) for t in trees], axis=0) if len(X) else np.array([]))
                s = np.power(2.0, -h / cn) if cn > 0 else np.zeros(len(X))
                pdf["outlier_score"] = s
                pdf["is_outlier"] = (s >= thr).astype("int32")
                yield pdf
        from pyspark.sql import types as T
        schema = T.StructType(df.schema.fields + [T.StructField("outlier_score", T.DoubleType()),
                                                  T.StructField("is_outlier", T.IntegerType())])
        return df.mapInPandas(score, schema)


class IsolationForestFlag(StatsEstimator):
    """Adds ``outlier_score`` and ``is_outlier`` (no capping)."""

    model_class = IsolationModel

    def __init__(self, features: Sequence[str], id_col: str, n_trees: int = 100,
                 contamination: float = 0.1, seed: int = 42):
        super().__init__(features=list(features), id_col=id_col, n_trees=n_trees,
                         contamination=contamination, seed=seed)

    def compute(self, df, cfg):
        feats, T, seed = cfg["features"], cfg["n_trees"], cfg["seed"]
        stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f, 0.5).alias(f) for f in feats]).first()
        n = stats["n"]
        fill = {f: float(stats[f]) if stats[f] is not None else 0.0 for f in feats}
        p = min(1.0, 1.5 * SAMPLE / max(n, 1))
        picks = F.filter(F.sequence(F.lit(0), F.lit(T - 1)),
                         lambda t: F.pmod(F.xxhash64(F.col(cfg["id_col"]), F.lit(seed), t), F.lit(1 << 50)) < int(p * (1 << 50)))
        sampled = df.select(*feats, cfg["id_col"]).withColumn("tree_id", F.explode(picks))
        psi = min(SAMPLE, n)
        depth = int(math.ceil(math.log2(max(psi, 2))))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            tid = int(pdf["tree_id"].iloc[0])
            rng = np.random.default_rng(seed + tid)
            X = pdf[feats].astype(float).fillna(pd.Series(fill)).to_numpy()
            if len(X) > SAMPLE:
                X = X[rng.choice(len(X), SAMPLE, replace=False)]
            return pd.DataFrame({"tree_id": [tid], "nodes": [json.dumps(_build(X, rng, depth))]})
        built = sampled.groupBy("tree_id").applyInPandas(build, "tree_id int, nodes string").collect()
        trees = [json.loads(r["nodes"]) for r in sorted(built, key=lambda r: r["tree_id"])]
        st = {"trees": trees, "psi": psi, "fill": fill, "threshold": 2.0}
        scored = IsolationModel(json.dumps(cfg), json.dumps(st)).transform(df.select(*feats, cfg["id_col"]))
        st["threshold"] = float(scored.agg(F.percentile_approx("outlier_score", 1 - cfg["contamination"],
                                                               10000)).first()[0])
        return st
