"""Exact order statistics of (possibly huge) groups without sorting a group
in one task.  There is one algorithm per question, at every size.

``locate_kth`` finds the k-th smallest key of any orderable type: each round
picks ``PIVOTS`` rows at random, counts the rows between and at the pivots (one
aggregate, at most 2 * PIVOTS + 1 result rows) and goes on with the range that
holds the k-th row.  The pivots only steer the search; the result is exact.

``quantiles`` locates all order statistics of all columns together by bucket
counts over shrinking value ranges and finishes them in one aggregate over
ranges of at most ``FINISH_ROWS`` values.  ``weighted_quantiles`` does so for
many weightings of the same rows (bootstrap samples) in the same few passes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 64
BUCKETS = 4096
FINISH_ROWS = 20_000     # a range this small is sorted as one array
MAX_LEVELS = 6           # bucket levels before the pivot search takes over
HIST_BYTES = 32 << 20    # of the histograms that a task holds in a pass


def pivots(rows: DataFrame, key: str, n: int = PIVOTS) -> list:
    """At most ``n`` distinct keys of random rows, in order."""
    return sorted({r[0] for r in rows.where(F.col(key).isNotNull()).select(key).orderBy(F.rand(7)).limit(n).collect()})


def below_pivots(key, points: list):
    """Number of (sorted) pivots below a key, by a balanced tree of comparisons;
    0 for a null key."""
    def tree(low, high):
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(key > F.lit(points[mid]), tree(mid + 1, high)).otherwise(tree(low, mid))

    return tree(0, len(points))


def locate_kth(rows: DataFrame, key: str, k: int, finish_rows: int = FINISH_ROWS):
    """(v, n_less): v = key of the k-th smallest row (1-based, nulls left out),
    n_less = number of rows with key < v.  Returns (None, n) when k > n."""
    below = 0
    part = rows.where(F.col(key).isNotNull()).select(key)
    c = F.col(key)
    n = part.count()
    if k > n:
        return None, n
    while n > finish_rows:
        points = pivots(part, key)
        at = below_pivots(c, points) * 2 + F.array_contains(F.array(*[F.lit(p) for p in points]), c).cast("int")
        hist = sorted(part.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect())
        cum = 0
        for b, count in hist:
            if cum + count >= k:
                break
            cum += count
        k, below, n = k - cum, below + cum, count
        if b % 2:
            return points[b // 2], below
        low, high = b // 2 - 1, b // 2
        if low >= 0:
            part = part.where(c > F.lit(points[low]))
        if high < len(points):
            part = part.where(c < F.lit(points[high]))
    keys = sorted(r[0] for r in part.collect())          # at most finish_rows
    return keys[k - 1], below + keys.index(keys[k - 1])


def quantiles(df: DataFrame, exprs: dict, qs, buckets: int = BUCKETS, finish_rows: int = FINISH_ROWS) -> dict:
    """Exact linearly-interpolated quantiles (= pandas / DuckDB
    ``quantile_cont``) of several columns or expressions; NaN counts as null.

    ``exprs``: {name: Column}; returns {name: [q-values]} (None for an empty
    column).  One pass for counts and limits, one per bucket level (none for
    columns of at most ``finish_rows`` values, one up to about 4 000 times
    that), and one that sorts the remaining small ranges."""
    names, qs = list(exprs), [float(q) for q in qs]
    spark = df.sparkSession

    def value(n):
        x = exprs[n].cast("double")
        return F.when(~F.isnan(x), x)

    base = df.select(*[value(n).alias(f"_q{i}") for i, n in enumerate(names)])
    st = base.agg(*[e for i in range(len(names)) for e in (
        F.count(f"_q{i}").alias(f"n{i}"), F.min(f"_q{i}").alias(f"lo{i}"), F.max(f"_q{i}").alias(f"hi{i}"))]).first()
    want: dict = {}          # range id -> {"c", "lo", "hi", "n", "ks": {k in range: k in column}}
    for i in range(len(names)):
        n = st[f"n{i}"]
        if n:
            ks = {k for q in qs for k in (math.floor(q * (n - 1)) + 1, min(math.ceil(q * (n - 1)) + 1, n))}
            want[i] = {"c": i, "lo": st[f"lo{i}"], "hi": st[f"hi{i}"], "n": n, "ks": {k: k for k in ks}}
    value_at: dict = {}      # (column, k) -> value

    def settle(ranges):
        out = {}
        for g, r in ranges.items():
            if r["lo"] == r["hi"]:
                value_at.update({(r["c"], k): r["lo"] for k in r["ks"].values()})
            else:
                out[g] = r
        return out

    want = settle(want)
    long = base.select(F.explode(F.array(*[F.struct(F.lit(i).alias("g"), F.col(f"_q{i}").alias("x"))
                                           for i in range(len(names))])).alias("s")).select("s.g", "s.x")
    long = long.where(F.col("x").isNotNull())
    level = 0
    while want and level < MAX_LEVELS and any(r["n"] > finish_rows for r in want.values()):
        level += 1
        # one row per range, bounded by the number of order statistics asked for
        limits = spark.createDataFrame([(g, float(r["lo"]), float(r["hi"]), sorted(r["ks"])) for g, r in want.items()],
                                       "g int, lo double, hi double, ks array<long>")
        step = (F.col("hi") / buckets - F.col("lo") / buckets)
        b = F.greatest(F.least(F.floor((F.col("x") - F.col("lo")) / step), F.lit(buckets - 1)), F.lit(0)).cast("int")
        inside = long.join(F.broadcast(limits.drop("ks")), "g").select("g", "x", b.alias("b"))
        # the histogram stays on the cluster; only buckets that hold a wanted order statistic come back
        counts = inside.groupBy("g", "b").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        upto = counts.withColumn("cum", F.sum("c").over(Window.partitionBy("g").orderBy("b")))  # at most ``buckets`` rows a range
        picked = upto.join(F.broadcast(limits.select("g", "ks")), "g").withColumn(
            "own", F.filter("ks", lambda k: (k > F.col("cum") - F.col("c")) & (k <= F.col("cum")))).where(F.size("own") > 0)
        new, links = {}, []
        for h in picked.select("g", "b", "c", "lo", "hi", "cum", "own").collect():
            r, before = want[h["g"]], h["cum"] - h["c"]
            links.append((h["g"], h["b"], len(new)))
            new[len(new)] = {"c": r["c"], "lo": h["lo"], "hi": h["hi"], "n": h["c"], "ks": {k - before: r["ks"][k] for k in h["own"]}}
        want = settle(new)
        links = spark.createDataFrame([x for x in links if x[2] in want], "g int, b int, g2 int")
        long = inside.join(F.broadcast(links), ["g", "b"]).select(F.col("g2").alias("g"), "x")
    small = {g: r for g, r in want.items() if r["n"] <= finish_rows}
    if small:
        asked = spark.createDataFrame([(g, sorted(r["ks"])) for g, r in small.items()], "g int, ks array<int>")
        found = (long.join(F.broadcast(asked), "g").groupBy("g").agg(F.sort_array(F.collect_list("x")).alias("v"),
                                                                    F.first("ks").alias("ks"))
                 .select("g", "ks", F.transform("ks", lambda k: F.element_at("v", k)).alias("v")))
        for r in found.collect():
            for k, v in zip(r["ks"], r["v"]):
                value_at[small[r["g"]]["c"], small[r["g"]]["ks"][k]] = v
    for g, r in want.items():
        if g not in small:   # values crowded beyond MAX_LEVELS bucket levels
            for k, whole in r["ks"].items():
                value_at[r["c"], whole] = locate_kth(long.where(F.col("g") == g), "x", k, finish_rows)[0]
    out: dict = {}
    for i, name in enumerate(names):
        n = st[f"n{i}"]
        if not n:
            out[name] = None
            continue
        out[name] = []
        for q in qs:
            pos = q * (n - 1)
            k = math.floor(pos)
            v1, v2 = value_at[i, k + 1], value_at[i, min(math.ceil(pos) + 1, n)]
            out[name].append(v1 + (v2 - v1) * (pos - k))
    return out


def _order_keys(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles (-0 is 0); ``_of_key`` goes back."""
    b = (x + 0.0).view(np.int64)
    return b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _of_key(k: int) -> float:
    b = np.array([k], np.int64)
    return float((b ^ ((b >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def weighted_quantiles(df: DataFrame, exprs: dict, samples: Sequence, times: Callable, qs, finish_rows: int = FINISH_ROWS,
                       hist_bytes: int = HIST_BYTES) -> list[dict]:
    """``quantiles`` of several samples of the rows: ``times`` tells from an array of a
    sample's column how often it has each row, and the result is what ``quantiles`` gives
    for the repeated rows.  Exact; the samples are looked at together, none is written out.

    One pass for counts and limits, then passes that narrow the ranges holding a wanted
    order statistic: ranges of more than ``finish_rows`` rows are counted by bucket and
    sample, of smaller ones the distinct values come together by range.  A bucket is a
    share of the range of the doubles' bit patterns, so a few passes reach single values."""
    names, qs, m = list(exprs), [float(q) for q in qs], len(samples)
    base = df.select(*[exprs[n].cast("double").alias(f"_q{i}") for i, n in enumerate(names)],
                     *[s.alias(f"_s{j}") for j, s in enumerate(samples)])

    def columns(batch: pa.RecordBatch, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(column, keys, samples x rows of weights) of the values that are numbers."""
        w = np.stack([times(batch.column(len(names) + j).to_numpy(zero_copy_only=False)) for j in range(m)])
        for c in wanted:
            x = batch.column(c).to_numpy(zero_copy_only=False).astype(float)  # null becomes NaN
            there = ~np.isnan(x)
            yield c, _order_keys(x[there]), w[:, there]

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, top = np.zeros((len(names), m), np.int64), np.iinfo(np.int64)
        lo, hi = np.full(len(names), top.max), np.full(len(names), top.min)
        for batch in batches:
            for c, key, w in columns(batch, range(len(names))):
                if len(key):
                    n[c] += w.sum(1)
                    lo[c], hi[c] = min(lo[c], key.min()), max(hi[c], key.max())
        c, j = (x.ravel() for x in np.indices(n.shape))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (c, j, n.ravel(), lo[c], hi[c])], ["c", "j", "n", "lo", "hi"])

    rows = {}
    asked: dict = {}         # range -> {"c", "lo", "hi", "n", "ks": {sample: {k in range: k in sample's column}}}
    for r in base.mapInArrow(limits, "c long, j long, n long, lo long, hi long").groupBy("c", "j").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
        rows[r["c"], r["j"]] = n = r["n"]
        if n:
            own = asked.setdefault(r["c"], {"c": r["c"], "lo": r["lo"], "hi": r["hi"], "n": 0, "ks": {}})
            own["n"] = max(own["n"], n)
            own["ks"][r["j"]] = {k: k for q in qs for k in (math.floor(q * (n - 1)) + 1, min(math.ceil(q * (n - 1)) + 1, n))}
    value_at: dict = {}      # (column, sample, k) -> value
    while asked:
        for g in [g for g, r in asked.items() if r["lo"] == r["hi"]]:
            r = asked.pop(g)
            value_at.update({(r["c"], j, k): _of_key(r["lo"]) for j, ks in r["ks"].items() for k in ks.values()})
        if asked:
            asked = _narrowed(base, columns, asked, m, finish_rows, hist_bytes)
    out: list[dict] = []
    for j in range(m):
        out.append({})
        for c, name in enumerate(names):
            n = rows.get((c, j), 0)
            out[j][name] = None if not n else []
            for q in qs if n else ():
                pos = q * (n - 1)
                k = math.floor(pos)
                v1, v2 = value_at[c, j, k + 1], value_at[c, j, min(math.ceil(pos) + 1, n)]
                out[j][name].append(v1 + (v2 - v1) * (pos - k))
    return out


def _narrowed(base: DataFrame, columns, asked: dict, m: int, finish_rows: int, hist_bytes: int) -> dict:
    """The buckets, or single values, of the ranges that hold the wanted order statistics."""
    ranges = dict(enumerate(asked.values()))
    of = {c: [g for g, r in ranges.items() if r["c"] == c] for c in sorted({r["c"] for r in ranges.values()})}
    counted = {g for g, r in ranges.items() if r["n"] > finish_rows}
    bits = max(4, min(12, (hist_bytes // max(1, len(counted) * (m + 2) * 8)).bit_length() - 1))
    shift = {g: max(0, (ranges[g]["hi"] - ranges[g]["lo"]).bit_length() - bits) for g in counted}
    top, schema = np.iinfo(np.int64), ["g", "a", "lo", "hi"]

    def told(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.int32()), *[
            pa.array([x[i].astype(np.int64).tobytes() for x in made], pa.binary()) for i in (1, 2, 3)]], schema)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hists = {g: (np.zeros((m, 1 << bits), np.int64), np.full(1 << bits, top.max), np.full(1 << bits, top.min)) for g in counted}
        for batch in batches:
            made = []
            for c, key, w in columns(batch, of):
                for g in of[c]:
                    r = ranges[g]
                    inside = np.flatnonzero((key >= r["lo"]) & (key <= r["hi"]))
                    own, times = key[inside], w[:, inside]
                    if g in counted:
                        hist, lo, hi = hists[g]
                        b = ((own - np.int64(r["lo"])).view(np.uint64) >> np.uint64(shift[g])).astype(np.int64)
                        for j in r["ks"]:
                            hist[j] += np.bincount(b, times[j], 1 << bits).astype(np.int64)
                        np.minimum.at(lo, b, own)
                        np.maximum.at(hi, b, own)
                    elif len(own):
                        own, at = np.unique(own, return_inverse=True)
                        made.append((g, np.stack([np.bincount(at, x, len(own)) for x in times]), own, own[:0]))
            if made:
                yield told(made)
        if hists:
            yield told([(g, *x) for g, x in hists.items()])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            for g, *parts in zip(*(batch.column(c).to_pylist() for c in schema)):
                a, lo, hi = (np.frombuffer(x, np.int64) for x in parts)
                if g not in counted:
                    sums.setdefault(g, []).append((a.reshape(m, -1), lo))
                elif g in sums:
                    sums[g] = sums[g][0] + a, np.minimum(sums[g][1], lo), np.maximum(sums[g][2], hi)
                else:
                    sums[g] = a, lo, hi
        made = []
        for g, x in sums.items():
            if g in counted:
                hist, lo, hi = x[0].reshape(m, -1), x[1], x[2]
            else:
                key = np.concatenate([k for _, k in x])
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))  # a value comes from several batches
                hist = np.add.reduceat(np.concatenate([a for a, _ in x], axis=1)[:, order], first, axis=1)
                lo = hi = key[first]
            for j, ks in ranges[g]["ks"].items():
                upto = np.cumsum(hist[j])
                for k in ks:
                    b = int(np.searchsorted(upto, k, "left"))
                    made.append((g, j, k, int(upto[b] - hist[j, b]), int(hist[j, b]), int(lo[b]), int(hi[b])))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made)], ["g", "j", "k", "before", "n", "lo", "hi"])

    out: dict = {}
    for r in base.mapInArrow(narrow, "g int, a binary, lo binary, hi binary").repartition(min(8, len(ranges)), "g").mapInArrow(
            settle, "g long, j long, k long, before long, n long, lo long, hi long").collect():
        whole = ranges[r["g"]]
        own = out.setdefault((r["g"], r["lo"], r["hi"]), {"c": whole["c"], "lo": r["lo"], "hi": r["hi"], "n": 0, "ks": {}})
        own["n"] = max(own["n"], r["n"])
        own["ks"].setdefault(r["j"], {})[r["k"] - r["before"]] = whole["ks"][r["j"]][r["k"]]
    return out
