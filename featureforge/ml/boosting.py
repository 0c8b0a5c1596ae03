"""Second-order gradient boosting over binned features.

Rows are binned once (at most 255 bins a feature, cut at exact quantiles; the
last bin holds missing values) and kept as blocks of packed arrays that never
leave their partition.  A tree is grown by passes over the blocks: each task
adds up gradients and hessians per (node, feature, bin), the histograms are
summed by a shuffle on (node, feature), and only the best split of each node
and feature comes back.  Gradients are rounded to a fixed grid and summed as
integers, so the sums, and with them the trees, do not depend on partitioning
and a sibling's histogram is exactly its parent's less its own.

Three ways to grow a tree:

* ``level`` (M3): all nodes of a level at a time, L1 and L2 terms, a minimum
  hessian and a minimum gain;
* ``leaf`` (M4): best-first from a queue of leaves up to ``max_leaves``; rows of
  the smaller child are counted only, the larger child is parent minus child;
* ``symmetric`` (M5): one split per level for all nodes of the level.

The model is a JSON document; scoring is one Arrow pass over the feature columns.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.rank import quantiles
from featureforge.ml import target_stats
from featureforge.ml.base import StatsEstimator, StatsModel
from featureforge.session import cut_lineage

MISSING = 255
NB = 256
BLOCK_ROWS = 1 << 16
#: Trees after which the rows' margins are stored anew; bytes of histograms of a pass.
REFRESH = 10
PASS_BYTES = 64 << 20
#: Histograms of a tree's leaves that the driver keeps at most to take siblings from; above, both children are counted.
KEEP_BYTES = 64 << 20

PRESETS = {
    "xgboost": dict(growth="level", n_estimators=100, max_depth=6, learning_rate=0.3, reg_lambda=1.0, reg_alpha=0.0,
                    gamma=0.0, min_child_weight=1.0, min_samples_leaf=1, max_bins=255, from_average=False),
    "lightgbm": dict(growth="leaf", n_estimators=100, max_depth=64, max_leaves=31, learning_rate=0.1, reg_lambda=0.0,
                     reg_alpha=0.0, gamma=0.0, min_child_weight=1e-3, min_samples_leaf=20, max_bins=255, from_average=True),
    "catboost": dict(growth="symmetric", n_estimators=100, max_depth=6, learning_rate=0.1, reg_lambda=3.0, reg_alpha=0.0,
                     gamma=0.0, min_child_weight=0.0, min_samples_leaf=1, max_bins=254, from_average=False),
}
COMMON = dict(subsample=1.0, colsample_bytree=1.0, seed=42, valid_col=None, early_stopping_rounds=50, id_col="id", label_col="label",
              cat_features=())
#: Other names of the parameters.
ALIASES = {"iterations": "n_estimators", "depth": "max_depth", "l2_leaf_reg": "reg_lambda", "num_leaves": "max_leaves",
           "validationIndicatorCol": "valid_col"}


# ------------------------------------------------------------------ trees
class Tree:
    """Arrays over nodes; node 0 is the root, a leaf has ``left`` -1."""

    FIELDS = ("feature", "bin", "threshold", "missing_left", "left", "right", "value", "cover", "gain")

    def __init__(self, **arrays):
        for f in self.FIELDS:
            setattr(self, f, list(arrays.get(f, ())))

    def add(self, cover: float) -> int:
        for f, x in zip(self.FIELDS, (-1, -1, 0.0, True, -1, -1, 0.0, cover, 0.0)):
            getattr(self, f).append(x)
        return len(self.left) - 1

    def split(self, node: int, best: dict, threshold: float, scale: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node] = best["feature"], best["bin"], threshold
        self.missing_left[node], self.gain[node] = best["missing_left"], best["gain"]
        self.left[node], self.right[node] = self.add(best["hl"] / scale), self.add(best["hr"] / scale)
        return self.left[node], self.right[node]

    def doc(self) -> dict:
        return {f: getattr(self, f) for f in self.FIELDS}

    def arrays(self) -> "Arrays":
        return Arrays(self)


class Arrays:
    """A tree as numpy arrays, for walking many rows at a time."""

    def __init__(self, tree: Tree):
        self.feature, self.bin = np.array(tree.feature), np.array(tree.bin)
        self.threshold, self.value = np.array(tree.threshold, float), np.array(tree.value, float)
        self.missing_left = np.array(tree.missing_left, bool)
        self.left, self.right = np.array(tree.left), np.array(tree.right)

    def leaves_of_bins(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row; ``bins`` is features x rows."""
        def below(node, rows):
            b = bins[self.feature[node], rows]
            return np.where(b == MISSING, self.missing_left[node], b <= self.bin[node])
        return self._walk(bins.shape[1], below)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row; ``x`` is rows x features, NaN is missing."""
        def below(node, rows):
            v = x[rows, self.feature[node]]
            return np.where(np.isnan(v), self.missing_left[node], v <= self.threshold[node])
        return self._walk(len(x), below)

    def _walk(self, n: int, below) -> np.ndarray:
        node = np.zeros(n, np.int64)
        rows = np.arange(n)
        while len(rows := rows[self.left[node[rows]] >= 0]):
            own = node[rows]
            node[rows] = np.where(below(own, rows), self.left[own], self.right[own])
        return node


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def uniforms(keys: np.ndarray, *salt: int) -> np.ndarray:
    """A number in [0, 1) for each 64-bit key, by bit mixing."""
    x = keys.astype(np.uint64)
    for s in salt:
        x = x + np.uint64((s * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


# ------------------------------------------------------------------ split search
def weight(g, h, alpha: float, lam: float):
    """The leaf weight that minimises g w + (h + lam) w^2 / 2 + alpha |w|."""
    return -np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0) / np.maximum(h + lam, 1e-16)


def score(g, h, alpha: float, lam: float):
    t = np.maximum(np.abs(g) - alpha, 0.0)
    return t * t / np.maximum(h + lam, 1e-16)


def best_split(hist: np.ndarray, p: dict, scale: float) -> dict:
    """The best cut of one feature's histogram (3 x bins: gradient, hessian,
    rows), missing rows on either side; the lowest bin wins ties."""
    total, missing = hist.sum(1), hist[:, MISSING]
    left = np.cumsum(hist[:, :MISSING], axis=1)[:, :-1]
    out = {"gain": -math.inf, "bin": -1, "missing_left": True, "left": total, "right": total * 0}
    whole = score(total[0] / scale, total[1] / scale, p["reg_alpha"], p["reg_lambda"])
    for side in ((True,) if missing[2] == 0 or p["growth"] == "symmetric" else (True, False)):
        a = left + missing[:, None] if side else left
        b = total[:, None] - a
        gain = 0.5 * (score(a[0] / scale, a[1] / scale, p["reg_alpha"], p["reg_lambda"])
                      + score(b[0] / scale, b[1] / scale, p["reg_alpha"], p["reg_lambda"]) - whole) - p["gamma"]
        ok = (a[2] >= p["min_samples_leaf"]) & (b[2] >= p["min_samples_leaf"]) & (a[2] > 0) & (b[2] > 0)
        ok &= (a[1] >= p["min_child_weight"] * scale) & (b[1] >= p["min_child_weight"] * scale)
        gain = np.where(ok, gain, -math.inf)
        k = int(np.argmax(gain))
        if gain[k] > out["gain"]:
            out = {"gain": float(gain[k]), "bin": k, "missing_left": side, "left": a[:, k], "right": b[:, k]}
    return out


def best_common_split(hists: np.ndarray, p: dict, scale: float) -> tuple[float, int, np.ndarray]:
    """Gain and bin of the best cut that all nodes (nodes x 3 x bins) share, and the sums left of it."""
    total = hists.sum(2)
    left = np.cumsum(hists[:, :, :MISSING], axis=2)[:, :, :-1] + hists[:, :, MISSING:]
    right = total[:, :, None] - left
    gain = sum(score(x[:, 0] / scale, x[:, 1] / scale, p["reg_alpha"], p["reg_lambda"]).sum(0) for x in (left, right))
    gain = 0.5 * (gain - score(total[:, 0] / scale, total[:, 1] / scale, p["reg_alpha"], p["reg_lambda"]).sum()) - p["gamma"]
    used = (left[:, 2].sum(0) > 0) & (right[:, 2].sum(0) > 0)
    gain = np.where(used, gain, -math.inf)
    k = int(np.argmax(gain))
    return float(gain[k]), k, left[:, :, k]


SPLIT = "node int, feature int, gain double, bin int, missing_left boolean, gl long, hl long, nl long, gr long, hr long, nr long, hist binary"
SPLIT_NAMES = [x.split()[0] for x in SPLIT.split(", ")]
SPLIT_TYPES = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_()] + [pa.int64()] * 6 + [pa.binary()]
HIST = "node int, feature int, hist binary"


# ------------------------------------------------------------------ rows
def cut_points(df: DataFrame, features: list[str], max_bins: int) -> list[list[float]]:
    """Ascending cuts of each feature: distinct exact quantiles below its maximum."""
    grid = [i / max_bins for i in range(1, max_bins)] + [1.0]
    found = quantiles(df, {f: F.col(f) for f in features}, grid)
    out = []
    for f in features:
        q = found[f] or []
        out.append(sorted({float(x) for x in q if x < q[-1]}))
    return out


def to_blocks(df: DataFrame, features: list[str], cuts: list[list[float]], p: dict) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` rows: bins (features x rows), labels, keys and validation flags."""
    key = F.xxhash64(p["id_col"]) if p["id_col"] in df.columns else F.xxhash64(*features, p["label_col"])
    valid = F.coalesce(F.col(p["valid_col"]).cast("boolean"), F.lit(False)) if p["valid_col"] else F.lit(False)
    picked = df.where(F.col(p["label_col"]).isNotNull()).select(
        *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)],
        F.col(p["label_col"]).cast("double").alias("_y"), key.alias("_key"), valid.alias("_valid"))

    def pack(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        bins = np.empty((len(features), table.num_rows), np.uint8)
        for i, cut in enumerate(cuts):
            x = table.column(i).to_numpy()  # null becomes NaN
            bins[i] = np.where(np.isnan(x), MISSING, np.searchsorted(cut, x, "left"))
        y = table.column("_y").to_numpy().astype(np.float32)
        return pa.RecordBatch.from_arrays(
            [pa.array([table.num_rows], pa.int32()), pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
             pa.array([table.column("_key").to_numpy().tobytes()], pa.binary()),
             pa.array([table.column("_valid").to_numpy().astype(np.uint8).tobytes()], pa.binary())],
            ["n", "bins", "y", "key", "valid"])

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

    return picked.mapInArrow(run, "n int, bins binary, y binary, key binary, valid binary")


class Rows:
    """The training rows as blocks with their margins, and passes over them."""

    def __init__(self, df: DataFrame, features: list[str], cuts: list[list[float]], p: dict):
        # a checkpoint keeps the partitions of the rows, where files read back may be packed into a few
        stored = cut_lineage(to_blocks(df, features, cuts, p))
        self.p, self.features, self.cuts, self.pending = p, features, cuts, []
        facts = stored.mapInArrow(_label_sums, "rows long, ones long").agg(F.sum("rows"), F.sum("ones")).first()
        self.n, ones = facts[0] or 0, facts[1] or 0
        self.scale = float(2 ** min(36, 62 - max(1, math.ceil(math.log2(self.n + 1)))))
        rate = ones / self.n if self.n else 0.5
        self.base = math.log(rate / (1 - rate)) if p["from_average"] and 0 < rate < 1 else 0.0
        self.blocks = stored.withColumn("margin", F.lit(None).cast("binary")).persist()

    def store(self, tree: Tree) -> None:
        """The tree counts from now on."""
        self.pending.append(tree.arrays())
        if len(self.pending) >= REFRESH:
            base, trees = self.base, self.pending

            def run(batches):
                for batch in batches:
                    made = []
                    for k in range(batch.num_rows):
                        b = Block(batch, k, base, trees)
                        made.append(b.margin.tobytes())
                    yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(made, pa.binary()))

            fresh = self.blocks.mapInArrow(run, self.blocks.schema).persist()
            fresh.count()
            self.blocks.unpersist()
            self.blocks, self.pending = fresh, []

    def histograms(self, tree: Tree, nodes: list[int], round_: int, columns: list[int], losses: bool) -> DataFrame:
        """Partial histograms of ``nodes`` (leaves of the tree so far) from every partition."""
        base, trees, partial, p, scale = self.base, self.pending, tree.arrays(), self.p, self.scale
        place = np.full(len(tree.left), -1)
        place[nodes] = np.arange(len(nodes))
        several = len(tree.left) > 1

        def run(batches):
            total = np.zeros((len(columns), 3, len(nodes) * NB), np.int64)
            loss = np.zeros(4, np.int64)
            for batch in batches:
                for k in range(batch.num_rows):
                    b = Block(batch, k, base, trees)
                    q = sigmoid(b.margin)
                    if losses:
                        each = np.round(np.logaddexp(0.0, np.where(b.y > 0, -b.margin, b.margin)) * (1 << 20)).astype(np.int64)
                        loss += [each[~b.valid].sum(), (~b.valid).sum(), each[b.valid].sum(), b.valid.sum()]
                    use = ~b.valid
                    if p["subsample"] < 1:
                        use &= uniforms(b.key, p["seed"], round_) < p["subsample"]
                    at = place[partial.leaves_of_bins(b.bins)] if several else np.zeros(b.n, np.int64)
                    rows = np.flatnonzero(use & (at >= 0))
                    # whole numbers: their sums in a block are exact in a double
                    g = np.round((q - b.y)[rows] * scale)
                    h = np.round((q * (1 - q))[rows] * scale)
                    start = at[rows] * NB
                    for i, f in enumerate(columns):
                        where = start + b.bins[f][rows]
                        for j, w in enumerate((g, h, None)):
                            total[i, j] += np.bincount(where, w, len(nodes) * NB).astype(np.int64)
            made = [(node, f, np.ascontiguousarray(total[i, :, a * NB:(a + 1) * NB]).tobytes())
                    for a, node in enumerate(nodes) for i, f in enumerate(columns)]
            if losses:
                made.append((-1, -1, loss.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), (
                pa.int32(), pa.int32(), pa.binary()))], ["node", "feature", "hist"])

        return self.blocks.mapInArrow(run, HIST)

    def release(self) -> None:
        self.blocks.unpersist()


def _label_sums(batches):
    for batch in batches:
        y = [np.frombuffer(x, np.float32)[np.frombuffer(v, np.uint8) == 0]  # validation labels are no training facts
             for x, v in zip(batch.column("y").to_pylist(), batch.column("valid").to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in y], pa.int64()),
                                          pa.array([int((x > 0).sum()) for x in y], pa.int64())], ["rows", "ones"])


class Block:
    def __init__(self, batch: pa.RecordBatch, k: int, base: float, trees: list[Arrays]):
        def raw(name, kind):
            return np.frombuffer(batch.column(name)[k].as_buffer(), kind)

        self.n = batch.column("n")[k].as_py()
        self.bins = raw("bins", np.uint8).reshape(-1, self.n)
        self.y, self.key, self.valid = raw("y", np.float32).astype(float), raw("key", np.int64), raw("valid", np.uint8) > 0
        stored = batch.column("margin")[k]
        margin = np.full(self.n, base) if not stored.is_valid else np.frombuffer(stored.as_buffer(), np.float64).copy()
        for tree in trees:
            margin += tree.value[tree.leaves_of_bins(self.bins)]
        self.margin = margin


def summed(rows: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
    """Histograms of a partition by (node, feature)."""
    out: dict[tuple[int, int], np.ndarray] = {}
    for batch in rows:
        for node, f, hist in zip(*(batch.column(c).to_pylist() for c in ("node", "feature", "hist"))):
            x = np.frombuffer(hist, np.int64)
            out[node, f] = out[node, f] + x if (node, f) in out else x
    return out


def split_rows(made: list[tuple]) -> Iterator[pa.RecordBatch]:
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*made), SPLIT_TYPES)], SPLIT_NAMES)


def split_row(node: int, f: int, hist: np.ndarray, p: dict, scale: float, keep: bool) -> tuple:
    b = best_split(hist.reshape(3, NB), p, scale)
    return (node, f, b["gain"], b["bin"], b["missing_left"], *(int(x) for x in (*b["left"], *b["right"])),
            hist.tobytes() if keep else None)


class Grower:
    """Grows one tree after another on ``Rows``."""

    def __init__(self, rows: Rows, p: dict):
        self.rows, self.p, self.scale = rows, p, rows.scale
        self.losses: list[tuple[float, float | None]] = []

    def tree(self, round_: int) -> Tree:
        n = len(self.rows.features)
        take = max(1, round(self.p["colsample_bytree"] * n))
        columns = sorted(np.argsort(uniforms(np.arange(n), self.p["seed"] + 1, round_), kind="stable")[:take].tolist())
        tree = Tree()
        tree.add(0.0)
        {"level": self._by_level, "leaf": self._by_leaf, "symmetric": self._symmetric}[self.p["growth"]](tree, round_, columns)
        return tree

    # -- one pass
    def _reducers(self, keys: int) -> int:
        return max(1, -(-keys * 3 * NB * 8 // (16 << 20)))

    def _groups(self, nodes: list[int], columns: list[int]) -> list[list[int]]:
        size = max(1, PASS_BYTES // (len(columns) * 3 * NB * 8))
        return [nodes[a:a + size] for a in range(0, len(nodes), size)]

    def _best(self, tree: Tree, nodes: list[int], round_: int, columns: list[int], losses: bool,
              kept: dict | None = None) -> dict[int, dict]:
        """Best split of each node, from histograms of all of them, which go
        into ``kept`` if it is given."""
        p, scale, keep = self.p, self.scale, kept is not None

        def settle(batches):
            yield from split_rows([(-1, -1, 0.0, 0, False, *(int(x) for x in hist), 0, 0, None) if node < 0 else
                                   split_row(node, f, hist, p, scale, keep) for (node, f), hist in summed(batches).items()])

        found = []
        for k, own in enumerate(self._groups(nodes, columns)):
            parts = self.rows.histograms(tree, own, round_, columns, losses and k == 0)
            found += parts.repartition(self._reducers(len(own) * len(columns)), "node", "feature").mapInArrow(
                settle, SPLIT).collect()  # a row per node and feature
        if keep:
            kept.update({(r["node"], r["feature"]): np.frombuffer(r["hist"], np.int64) for r in found if r["node"] >= 0})
        return self._pick(found)

    def _pick(self, found: list) -> dict[int, dict]:
        """The best row of each node; the first feature wins ties."""
        best: dict[int, dict] = {}
        for r in found:
            if r["node"] < 0:
                self._note_loss(r["gl"], r["hl"], r["nl"], r["gr"])
                continue
            x = {c: r[c] for c in SPLIT_NAMES[:-1]}
            now = best.get(x["node"])
            if now is None or (-x["gain"], x["feature"]) < (-now["gain"], now["feature"]):
                best[x["node"]] = x
        return best

    def _note_loss(self, train, n, valid, n_valid) -> None:
        self.losses.append((train / n / (1 << 20) if n else 0.0, valid / n_valid / (1 << 20) if n_valid else None))

    def _leaf(self, tree: Tree, node: int, g: int, h: int) -> None:
        tree.value[node] = float(self.p["learning_rate"] * weight(g / self.scale, h / self.scale, self.p["reg_alpha"],
                                                                 self.p["reg_lambda"]))
        tree.cover[node] = h / self.scale

    def _threshold(self, best: dict) -> float:
        return self.rows.cuts[best["feature"]][best["bin"]]

    def _useful(self, best: dict) -> bool:
        return best["gain"] > 1e-12 and best["bin"] < len(self.rows.cuts[best["feature"]])

    # -- M3
    def _by_level(self, tree: Tree, round_: int, columns: list[int]) -> None:
        active = [0]
        for depth in range(self.p["max_depth"]):
            best = self._best(tree, active, round_, columns, depth == 0)
            if depth == 0:
                self._leaf(tree, 0, best[0]["gl"] + best[0]["gr"], best[0]["hl"] + best[0]["hr"])
            following = []
            for node in active:
                b = best[node]
                if self._useful(b):
                    left, right = tree.split(node, b, self._threshold(b), self.scale)
                    for child, s in ((left, "l"), (right, "r")):
                        self._leaf(tree, child, b["g" + s], b["h" + s])
                        if b["n" + s] >= 2 * self.p["min_samples_leaf"] and b["h" + s] >= 2 * self.p["min_child_weight"] * self.scale:
                            following.append(child)
            active = following
            if not active:
                break

    # -- M4
    def _by_leaf(self, tree: Tree, round_: int, columns: list[int]) -> None:
        """Leaves are split best first.  The children of all leaves that may be
        split next are looked at in one pass, which does not change the order."""
        p, scale = self.p, self.scale
        full = Tree(**{k: list(v) for k, v in tree.doc().items()})  # with all children that were looked at
        kept: dict | None = {} if 2 * p["max_leaves"] * len(columns) * 3 * NB * 8 <= KEEP_BYTES else None
        best, depth = self._best(full, [0], round_, columns, True, kept), {0: 0}
        self._leaf(full, 0, best[0]["gl"] + best[0]["gr"], best[0]["hl"] + best[0]["hr"])

        def order() -> tuple[list[int], list[int]]:
            """Nodes in the order of their splits as far as children are known, and the leaves that come next."""
            done, queue = [], [(-best[0]["gain"], 0)]
            while queue and len(done) < p["max_leaves"] - 1:
                gain, node = queue[0]
                if not self._useful(best[node]):
                    heapq.heappop(queue)
                    continue
                if full.left[node] < 0:
                    return done, [k for g, k in heapq.nsmallest(p["max_leaves"] - 1 - len(done), queue)
                                  if full.left[k] < 0 and self._useful(best[k])]
                heapq.heappop(queue)
                done.append(node)
                for child in (full.left[node], full.right[node]):
                    heapq.heappush(queue, (-best[child]["gain"], child))
            return done, []

        while True:
            done, asked = order()
            if not asked:
                break
            small, large = [], {}
            for node in asked:
                b = best[node]
                children = full.split(node, b, self._threshold(b), scale)
                for child, s in zip(children, "lr"):
                    self._leaf(full, child, b["g" + s], b["h" + s])
                    depth[child] = depth[node] + 1
                first = children[b["nl"] > b["nr"]]  # the child with fewer rows
                small.append(first)
                large[sum(children) - first] = (node, first)
            if kept is None:
                best.update(self._best(full, sorted([*small, *large]), round_, columns, False))
            else:
                best.update(self._best(full, small, round_, columns, False, kept))
                for child, (node, first) in large.items():
                    rows = []
                    for f in columns:
                        kept[child, f] = kept[node, f] - kept[first, f]
                        rows.append(dict(zip(SPLIT_NAMES, split_row(child, f, kept[child, f], p, scale, False))))
                        del kept[node, f]
                    best.update(self._pick(rows))
            for child in (*small, *large):
                if depth[child] >= p["max_depth"]:
                    best[child]["gain"] = -math.inf
        # the tree: only the splits that were taken
        self._leaf(tree, 0, best[0]["gl"] + best[0]["gr"], best[0]["hl"] + best[0]["hr"])
        name = {0: 0}
        for node in done:
            left, right = tree.split(name[node], best[node], self._threshold(best[node]), scale)
            for child, own in ((left, full.left[node]), (right, full.right[node])):
                name[own] = child
                tree.value[child], tree.cover[child] = full.value[own], full.cover[own]

    # -- M5
    def _symmetric(self, tree: Tree, round_: int, columns: list[int]) -> None:
        p, scale = self.p, self.scale
        nodes = [0]
        for depth in range(p["max_depth"]):
            own = list(nodes)

            def settle(batches):
                fresh = summed(batches)
                made = [(-1, -1, 0.0, 0, False, *(int(x) for x in hist), 0, 0, None)
                        for (node, _), hist in fresh.items() if node < 0]
                for f in sorted({f for node, f in fresh if node >= 0}):
                    hists = np.stack([fresh[node, f] for node in own]).reshape(len(own), 3, NB)
                    gain, k, left = best_common_split(hists, p, scale)
                    both = np.stack([left, hists.sum(2) - left])
                    made.append((0, f, gain, k, True, 0, 0, 0, 0, 0, 0, both.tobytes()))
                yield from split_rows(made)

            parts = self.rows.histograms(tree, own, round_, columns, depth == 0)
            # a feature's histograms of all nodes meet; the losses have a feature of their own
            rows = parts.repartition(self._reducers(len(own) * len(columns)), "feature").mapInArrow(settle, SPLIT).collect()
            hist = {r["feature"]: r["hist"] for r in rows}
            b = self._pick(rows)[0]
            left, right = np.frombuffer(hist[b["feature"]], np.int64).reshape(2, len(own), 3)
            if depth == 0:
                self._leaf(tree, 0, *(int(x) for x in (left + right)[0, :2]))
            if not self._useful(b):
                break
            nodes = []
            for i, node in enumerate(own):
                for child, s in zip(tree.split(node, {**b, "gain": b["gain"] / len(own), "hl": int(left[i, 1]), "hr": int(right[i, 1])},
                                               self._threshold(b), scale), (left, right)):
                    self._leaf(tree, child, int(s[i, 0]), int(s[i, 1]))
                    nodes.append(child)


def settings(kind: str, given: dict) -> dict:
    """Parameters of a preset with the given ones; unknown names raise."""
    p = {**PRESETS[kind], **COMMON}
    for name, value in given.items():
        name = ALIASES.get(name, name)
        if name not in p and name != "max_leaves":
            raise ValueError(f"unknown boosting parameters {sorted(given)}: {name}")
        p[name] = value
    return p


# ------------------------------------------------------------------ estimator
class BoostedTreesModel(StatsModel):
    """Fitted trees; adds ``<name>_raw``, ``<name>_probability`` and ``<name>_prediction``."""

    def apply(self, df, cfg, st):
        name, features = cfg["name"], cfg["features"]
        stats = st.get("stats") or {}
        score_udf = margin_udf(st["trees"], st["base"], {i: stats[f] for i, f in enumerate(features) if f in stats})
        m = f"_{name}_margin"
        out = df.withColumn(m, score_udf(F.struct(*[(target_stats.category(f) if f in stats else F.col(f).cast("double")).alias(f"x{i}")
                                                    for i, f in enumerate(features)])))
        p = 1 / (1 + F.exp(-F.col(m)))
        return (out.withColumn(f"{name}_raw", array_to_vector(F.array(-F.col(m), F.col(m))))
                .withColumn(f"{name}_probability", array_to_vector(F.array(1 - p, p)))
                .withColumn(f"{name}_prediction", (F.col(m) >= 0).cast("double")).drop(m))

    @property
    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in self.fitted["trees"]]

    @property
    def base(self) -> float:
        return self.fitted["base"]

    @property
    def losses(self) -> list:
        """(training, validation) loss before each round and after the last that was grown."""
        return self.fitted["losses"]

    @property
    def featureImportances(self):
        from pyspark.ml.linalg import DenseVector
        total = np.zeros(len(self._cfg()["features"]))
        for t in self.fitted["trees"]:
            for f, g in zip(t["feature"], t["gain"]):
                if f >= 0:
                    total[f] += g
        return DenseVector(total / total.sum() if total.sum() else total)


def margin_udf(trees: list[dict], base: float, stats: dict[int, dict]):
    """Arrow function: the features of rows to the sum of the trees' leaves;
    ``stats``: the values of categories, by feature number."""
    docs = trees

    @F.pandas_udf("double")
    def margin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        walked = [Tree(**t).arrays() for t in docs]
        for x in batches:
            for i, told in stats.items():
                x[f"x{i}"] = x[f"x{i}"].map(told).fillna(told[""])
            values = x.to_numpy(dtype=float, na_value=np.nan)
            out = np.full(len(values), base)
            for t in walked:
                out += t.value[t.leaves(values)]
            yield pd.Series(out)

    return margin


class BoostedTrees(StatsEstimator):
    """``kind``: xgboost, lightgbm or catboost; see ``PRESETS`` for its
    parameters.  ``cat_features`` are encoded by ordered target statistics."""

    model_class = BoostedTreesModel

    def __init__(self, kind: str = "xgboost", features=(), name: str | None = None, **params):
        settings(kind, params)
        super().__init__(kind=kind, features=list(features), name=name or kind, params=params)

    def compute(self, df, cfg):
        p = settings(cfg["kind"], cfg["params"])
        features, cats = cfg["features"], [f for f in cfg["features"] if f in p["cat_features"]]
        stats = target_stats.full_target_stats(df, cats, p["label_col"]) if cats else {}
        if cats:  # in training a row's category is the mean of earlier rows
            df = target_stats.ordered_target_stats(df, cats, p["label_col"], p["id_col"], p["seed"])
            df = df.drop(*cats).withColumnsRenamed({c + "_ots": c for c in cats})
        cuts = cut_points(df, features, p["max_bins"])
        rows = Rows(df, features, cuts, p)
        grower, trees = Grower(rows, p), []
        try:
            best = (math.inf, 0)
            for r in range(p["n_estimators"] if rows.n else 0):
                trees.append(grower.tree(r))
                rows.store(trees[-1])
                seen = grower.losses[-1][1]  # with the trees before this one
                if seen is not None:
                    best = min(best, (seen, r))
                    if r - best[1] >= p["early_stopping_rounds"]:
                        break
            if rows.n:
                none = Tree()
                none.add(0.0)
                grower._best(none, [0], len(trees), [0], True)  # the loss with all trees
            if p["valid_col"] and grower.losses and grower.losses[-1][1] is not None:
                best = min(best, (grower.losses[-1][1], len(trees)))
                trees = trees[:best[1]]
        finally:
            rows.release()
        return {"trees": [t.doc() for t in trees], "base": rows.base, "losses": grower.losses, "stats": stats}
