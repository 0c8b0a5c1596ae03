"""Extra trees (M9): a forest whose thresholds are drawn at random.

Every node draws some features and, for each, a threshold between the smallest
and largest value of its own rows; the best of these splits is taken.  All
trees grow together, level by level, in two passes: one finds the limits of every
(node, feature), one counts what lies left of the drawn thresholds.  Both are
keyed aggregates; rows stay in their partitions as packed blocks, with the open
node of each row and tree, which the first pass of a level brings one split
further.  A block's rows are ordered by node once a pass and tree, so its cost
grows with rows, trees and drawn features, not with nodes.  Draws are functions
of (seed, tree, node, feature) and counts are whole numbers, so the forest does
not depend on partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.ml.base import StatsEstimator, StatsModel
from featureforge.ml.boosting import BLOCK_ROWS, Tree, margin_udf, uniforms
from featureforge.session import cut_lineage

#: A node's number within the forest is tree * TREE_NODES + its place in the tree.
TREE_NODES = 1 << 24


def forest_blocks(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` rows: values (features x rows, null is NaN) and labels."""
    picked = df.where(F.col(label_col).isNotNull()).select(
        *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)], F.col(label_col).cast("double").alias("_y"))

    def pack(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        x = np.stack([table.column(i).to_numpy() for i in range(len(features))]).astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array([table.num_rows], pa.int32()), pa.array([x.tobytes()], pa.binary()),
                                           pa.array([table.column("_y").to_numpy().astype(np.uint8).tobytes()], pa.binary())], ["n", "x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK_ROWS - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == BLOCK_ROWS:
                    yield pack(held)
                    held, n = [], 0
        if held:
            yield pack(held)

    return picked.mapInArrow(run, "n int, x binary, y binary")


def drawn_features(nodes: np.ndarray, n_features: int, take: int, seed: int) -> np.ndarray:
    """(nodes x take) features of each node."""
    u = np.stack([uniforms(nodes, seed, 2 * f) for f in range(n_features)], axis=1)
    return np.argsort(u, axis=1, kind="stable")[:, :take]


def _ordered(batch: pa.RecordBatch, k: int, n_trees: int, kind: type) -> Iterator[tuple]:
    """(tree, values, labels, rows of open nodes ordered by node, their nodes, each node's first row) of a block."""
    n = batch.column("n")[k].as_py()
    x = np.frombuffer(batch.column("x")[k].as_buffer(), np.float64)
    y = np.frombuffer(batch.column("y")[k].as_buffer(), np.uint8) > 0
    at = np.frombuffer(batch.column("at")[k].as_buffer(), kind).reshape(n_trees, n)
    for t in range(n_trees):
        rows = np.flatnonzero(at[t] != np.iinfo(kind).max)
        if len(rows):
            own = at[t][rows]
            order = np.argsort(own, kind="stable")
            own = own[order].astype(np.int64)
            yield t, x, y, rows[order], own, np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))


class ExtraForest:
    """Grows the forest on ``blocks``."""

    def __init__(self, blocks: DataFrame, n_features: int, p: dict):
        self.blocks, self.n_features, self.p = blocks, n_features, p
        m = p["max_features"]
        self.take = {"sqrt": max(1, int(math.sqrt(n_features))), "log2": max(1, int(math.log2(n_features))),
                     "all": n_features, None: n_features}.get(m, m)
        self.trees = []
        first = blocks.mapInArrow(_counts, "rows long, ones long").agg(F.sum("rows"), F.sum("ones")).first()
        self.n, self.ones = first[0] or 0, first[1] or 0
        #: rows and ones of each node that may be split
        self.open: dict[int, tuple[int, int]] = {}
        #: open nodes and their splits of the level before: feature, cut, the children's nodes
        self.before: tuple | None = None
        for t in range(p["n_estimators"] if self.n else 0):
            tree = Tree()
            tree.add(float(self.n))
            self.trees.append(tree)
            self._settle(t, 0, self.n, self.ones)

    def _settle(self, t: int, node: int, n: int, ones: int) -> None:
        self.trees[t].value[node] = ones / n / self.p["n_estimators"]
        if 0 < ones < n and n >= max(2, 2 * self.p["min_samples_leaf"]):
            self.open[t * TREE_NODES + node] = (n, ones)

    def _stepped(self, nodes: np.ndarray, starts: np.ndarray) -> tuple[DataFrame, type]:
        """The blocks with each row's open node, counted within its tree (the highest number: none)."""
        n_trees, before = len(self.trees), self.before
        kind = np.uint16 if np.diff(starts).max() < np.iinfo(np.uint16).max else np.uint32
        none = np.iinfo(kind).max
        if before is not None:
            was, was_starts, was_kind, feature, cut, children = before
            tree = children // TREE_NODES
            place = np.minimum(np.searchsorted(nodes, children), len(nodes) - 1)
            following = np.where(nodes[place] == children, place - starts[tree], none).astype(kind)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    n = batch.column("n")[k].as_py()
                    at = np.full((n_trees, n), none, kind)
                    if before is None:
                        at[:] = 0
                    else:
                        for t, x, _, rows, own, _ in _ordered(batch, k, n_trees, was_kind):
                            i = own + was_starts[t]
                            right = ~(x[feature[i] * n + rows] <= cut[i])  # missing values go right
                            at[t, rows] = following[i, right.astype(np.int64)]
                    yield batch.slice(k, 1).set_column(batch.schema.get_field_index("at"), "at", pa.array([at.tobytes()], pa.binary()))

        return self.blocks.mapInArrow(run, self.blocks.schema).persist(), kind

    def level(self) -> None:
        nodes = np.array(sorted(self.open), np.int64)
        own, self.open = self.open, {}
        n_trees, take, seed = len(self.trees), self.take, self.p["seed"]
        picks = drawn_features(nodes, self.n_features, take, seed)
        take = picks.shape[1]
        starts = np.searchsorted(nodes, np.arange(n_trees + 1) * TREE_NODES)
        stepped, kind = self._stepped(nodes, starts)

        def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = np.full(picks.shape, np.inf), np.full(picks.shape, -np.inf)
            for batch in batches:
                for k in range(batch.num_rows):
                    n = batch.column("n")[k].as_py()
                    for t, x, _, rows, node, first in _ordered(batch, k, n_trees, kind):
                        node = node + starts[t]
                        i = node[first]
                        for j in range(take):
                            v = x[picks[node, j] * n + rows]
                            low[i, j] = np.fmin(low[i, j], np.fmin.reduceat(v, first))
                            high[i, j] = np.fmax(high[i, j], np.fmax.reduceat(v, first))
            i, j = np.nonzero(low <= high)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(picks[i, j].astype(np.int32)), pa.array(low[i, j]),
                                              pa.array(high[i, j])], ["node", "feature", "low", "high"])

        found = stepped.mapInArrow(limits, "node long, feature int, low double, high double").groupBy("node", "feature").agg(
            F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").toArrow()  # a row per node and drawn feature
        self.blocks.unpersist()
        self.blocks = stepped
        cut = np.full(picks.shape, np.nan)
        which = np.searchsorted(nodes, found.column("node").to_numpy())
        feature = found.column("feature").to_numpy().astype(np.int64)
        low, high = found.column("low").to_numpy(), found.column("high").to_numpy()
        col = (picks[which] == feature[:, None]).argmax(1) if len(which) else np.zeros(0, np.int64)
        u = np.concatenate([uniforms(nodes[which[feature == f]], seed, 2 * f + 1) for f in range(self.n_features)] or [np.zeros(0)])
        at = np.concatenate([np.flatnonzero(feature == f) for f in range(self.n_features)] or [np.zeros(0, np.int64)])
        t = np.empty(len(which))
        t[at] = low[at] + u * (high[at] - low[at])
        cut[which, col] = np.minimum(t, np.nextafter(high, -np.inf))  # the largest value stays on the right

        def left_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, ones = np.zeros(cut.shape, np.int64), np.zeros(cut.shape, np.int64)
            for batch in batches:
                for k in range(batch.num_rows):
                    n = batch.column("n")[k].as_py()
                    for t, x, y, rows, node, first in _ordered(batch, k, n_trees, kind):
                        node = node + starts[t]
                        i, label = node[first], y[rows]
                        for j in range(take):
                            left = x[picks[node, j] * n + rows] <= cut[node, j]  # missing values go right
                            count[i, j] += np.add.reduceat(left, first, dtype=np.int64)
                            ones[i, j] += np.add.reduceat(left & label, first, dtype=np.int64)
            i, j = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(picks[i, j].astype(np.int32)), pa.array(count[i, j]),
                                              pa.array(ones[i, j])], ["node", "feature", "n", "ones"])

        counts = stepped.mapInArrow(left_counts, "node long, feature int, n long, ones long").groupBy("node", "feature").agg(
            F.sum("n").alias("n"), F.sum("ones").alias("ones")).toArrow()
        which = np.searchsorted(nodes, counts.column("node").to_numpy())
        feature, ln, l1 = (counts.column(c).to_numpy().astype(np.int64) for c in ("feature", "n", "ones"))
        n, ones = np.array([own[x] for x in nodes.tolist()], np.int64).T
        ok = np.minimum(ln, n[which] - ln) >= max(1, self.p["min_samples_leaf"])
        which, feature, ln, l1 = which[ok], feature[ok], ln[ok], l1[ok]
        rn, r1 = n[which] - ln, ones[which] - l1
        impurity = l1 * (ln - l1) / ln + r1 * (rn - r1) / rn  # weighted Gini impurity of the children, without constants
        order = np.lexsort((feature, impurity, which))
        best = order[np.unique(which[order], return_index=True)[1]]  # the first feature wins ties
        split_feature, split_cut = np.zeros(len(nodes), np.int64), np.zeros(len(nodes))
        children = np.full((len(nodes), 2), -1, np.int64)
        for i, f, a, a1, worth in zip(*(v[best].tolist() for v in (which, feature, ln, l1, impurity))):
            t, k = divmod(int(nodes[i]), TREE_NODES)
            n, ones = own[int(nodes[i])]
            gain = 2 * (ones * (n - ones) / n - worth) / self.n
            split_feature[i], split_cut[i] = f, cut[i, int((picks[i] == f).argmax())]
            left, right = self.trees[t].split(k, {"feature": f, "bin": 0, "missing_left": False, "gain": gain, "hl": a, "hr": n - a},
                                              float(split_cut[i]), 1.0)
            children[i] = t * TREE_NODES + left, t * TREE_NODES + right
            self._settle(t, left, a, a1)
            self._settle(t, right, n - a, ones - a1)
        self.before = nodes, starts, kind, split_feature, split_cut, children


def _counts(batches):
    for batch in batches:
        y = [np.frombuffer(x, np.uint8) for x in batch.column("y").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in y], pa.int64()), pa.array([int(x.sum()) for x in y], pa.int64())],
                                         ["rows", "ones"])


class ExtraTreesModel(StatsModel):
    """Fitted forest; adds ``<name>_raw``, ``<name>_probability`` and ``<name>_prediction``."""

    def apply(self, df, cfg, st):
        name, features = cfg["name"], cfg["features"]
        p = f"_{name}_p"
        out = df.withColumn(p, margin_udf(st["trees"], 0.0, {})(
            F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)])))
        both = array_to_vector(F.array(1 - F.col(p), F.col(p)))
        return (out.withColumn(f"{name}_raw", both).withColumn(f"{name}_probability", both)
                .withColumn(f"{name}_prediction", (F.col(p) > 0.5).cast("double")).drop(p))

    @property
    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in self.fitted["trees"]]

    base = 0.0

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import DenseVector
        total = np.zeros(len(self._cfg()["features"]))
        for t in self.fitted["trees"]:
            for f, g in zip(t["feature"], t["gain"]):
                if f >= 0:
                    total[f] += g
        return DenseVector(total / total.sum() if total.sum() else total)


class ExtraTrees(StatsEstimator):
    """``n_estimators``, ``max_depth``, ``max_features`` (sqrt, log2, all or a number), ``min_samples_leaf``, ``seed``."""

    model_class = ExtraTreesModel
    DEFAULTS = dict(n_estimators=100, max_depth=12, max_features="sqrt", min_samples_leaf=1, seed=42, label_col="label")

    def __init__(self, features=(), name: str = "extra_trees", **params):
        if unknown := set(params) - set(self.DEFAULTS):
            raise ValueError(f"unknown parameters {sorted(unknown)}")
        super().__init__(features=list(features), name=name, params=params)

    def compute(self, df, cfg):
        p = {**self.DEFAULTS, **cfg["params"]}
        # a checkpoint keeps the partitions of the rows, where files read back may be packed into a few
        blocks = cut_lineage(forest_blocks(df, cfg["features"], p["label_col"])).withColumn("at", F.lit(None).cast("binary"))
        forest = ExtraForest(blocks, len(cfg["features"]), p)
        try:
            for _ in range(p["max_depth"]):
                if not forest.open:
                    break
                forest.level()
        finally:
            forest.blocks.unpersist()
        return {"trees": [t.doc() for t in forest.trees]}


def scores(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """Probability of class 1 of rows x features."""
    out = np.zeros(len(x))
    for t in trees:
        a = t.arrays()
        out += a.value[a.leaves(x)]
    return out

