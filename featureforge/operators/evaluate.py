"""Evaluation (V1-V21) as aggregations over a prediction table.

Input: one row per scored entity with ``label`` (0/1), ``prediction`` (0/1),
a probability column and optional group keys (e.g. ``model``), so many models
are evaluated in ONE job per metric family (V18).

Counting metrics are one grouped aggregate.  Ranking metrics (AUC, average
precision, ROC, gains, calibration) first reduce the rows to a score
histogram (G5: one row per (keys, distinct score) with positive/negative
counts; partial aggregation map-side).  Cumulative sums run over distinct
scores in two parts, so no task holds all scores of a key: sums per range
bucket (at most ``CUM_BUCKETS`` rows per key) give each bucket's offset, and
windows run inside the buckets, which are cut at quantiles of the distinct scores,
so that crowded scores are spread as well.  Only the rows of the boundary score groups of
the gains curve (at most 10 per key) are ranked individually, split at pivots.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed project's for equal results.
RETENTION_COST = 50
CHURN_COST = 500
AVG_CLV = 1200
LOG_LOSS_EPS = 2.220446049250313e-16     # float64 machine epsilon (probability clip)
# ---------------------------------------------------------------------------
CUM_BUCKETS = 256        # range buckets of a key's scores
RANKED_ROWS = 20_000     # boundary score groups up to this size are ranked as they are
TIE_PIVOTS = 64          # ranges that the ids of boundary score groups are split into


def _div0(a, b) -> Column:
    """a / b, 0 when the divisor is 0 (zero_division=0)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _y(label: str) -> Column:
    return F.col(label).cast("int")


# ------------------------------------------------------------------ V1-V2, V4-V10
def counts(pred: DataFrame, keys: Sequence[str] = (), label: str = "label",
           prediction: str = "prediction", prob: str = "p1") -> DataFrame:
    """V1 + the per-row means needed by V4/V8: one grouped aggregate."""
    y, yh = _y(label), F.col(prediction).cast("int")
    p = F.col(prob).cast("double")
    pc = F.least(F.greatest(p, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    return pred.groupBy(*keys).agg(
        F.count_if((y == 1) & (yh == 1)).alias("tp"), F.count_if((y == 0) & (yh == 0)).alias("tn"),
        F.count_if((y == 0) & (yh == 1)).alias("fp"), F.count_if((y == 1) & (yh == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.avg(-(y * F.log(pc) + (1 - y) * F.log(1 - pc))).alias("log_loss"))


def classification_metrics(pred: DataFrame, keys: Sequence[str] = (), **cols) -> DataFrame:
    """V1, V2, V4, V5, V7, V8, V9, V10 in one row per key."""
    c = counts(pred, keys, **cols)
    tp, tn, fp, fn, n = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn", "n"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    spec = _div0(tn, tn + fp)
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    saved, invest = tp * AVG_CLV, (tp + fp) * RETENTION_COST
    return c.select(
        *keys, "tp", "tn", "fp", "fn", "n",
        _div0(tp + tn, n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        spec.alias("specificity"), recall.alias("sensitivity"),
        ((recall + spec) / 2).alias("balanced_accuracy"),
        _div0(tp * tn - fp * fn, den).alias("matthews_corr_coef"),
        "brier_score", "log_loss",
        (fp * RETENTION_COST + fn * CHURN_COST).alias("total_cost"),
        _div0(fp * RETENTION_COST + fn * CHURN_COST, n).alias("cost_per_customer"),
        saved.alias("revenue_saved"), (fn * AVG_CLV).alias("revenue_lost"),
        recall.alias("churn_detection_rate"), _div0(fp, fp + tn).alias("false_alarm_rate"),
        (_div0(saved - invest, invest) * 100).alias("roi_percentage"),
        (saved - invest).alias("net_benefit"),
        precision.alias("precision_in_targeting"),
        _div0(tp - fp, tp + fn).alias("cost_savings_ratio"))


# ------------------------------------------------------------------ histogram
def score_histogram(pred: DataFrame, keys: Sequence[str] = (), label: str = "label",
                    prob: str = "p1") -> DataFrame:
    """(keys, score, pos, neg, cnt): one row per distinct score; a NaN score
    counts as missing."""
    y = _y(label)
    p = F.col(prob).cast("double")
    return pred.groupBy(*keys, F.when(~F.isnan(p), p).alias("score")).agg(
        F.sum(y).cast("bigint").alias("pos"), F.sum(1 - y).cast("bigint").alias("neg"),
        F.count(F.lit(1)).alias("cnt"))


def score_cuts(h: DataFrame) -> list[float]:
    """At most ``CUM_BUCKETS`` - 1 ascending scores that split the histogram's
    rows into ranges of about equal size (one aggregate, one row)."""
    grid = [i / CUM_BUCKETS for i in range(1, CUM_BUCKETS)]
    return sorted(set(h.agg(F.percentile_approx("score", grid, 10_000)).first()[0] or []))


def _range_of(score: Column, points: list[float]) -> Column:
    """Number of (sorted) points below a score, 0 for a null one: first among
    every sixteenth point, then among the fifteen that follow."""
    if not points:
        return F.lit(0)

    def below(xs: Column) -> Column:
        return F.size(F.filter(xs, lambda x: x < score))

    every = F.array(*[F.lit(x) for x in points])
    coarse = below(F.array(*[F.lit(x) for x in points[15::16]]))
    return coarse * 16 + below(F.slice(every, coarse * 16 + 1, F.lit(15)))


def _cum(h: DataFrame, keys, ascending: bool):
    """Running and total sums in score order.  The plan is the same for both
    orders (descending sums are what the ascending ones leave), so metrics of one
    job share its exchanges."""
    keys = list(keys)
    sums = ("pos", "neg", "cnt")
    whole = (h.groupBy(*keys) if keys else h.groupBy(F.lit(0).alias("_all"))).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("Nn"), F.sum("cnt").alias("total"))
    if not keys:
        whole = whole.drop("_all")
    for i, k in enumerate(keys):
        whole = whole.withColumnRenamed(k, f"_w{i}")
    # one row per key: bounded
    whole = F.broadcast(whole)
    cond = [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(keys)]
    j = h.join(whole, cond) if keys else h.crossJoin(whole)
    j = j.select(*h.columns, "P", "Nn", "total").withColumn("_b", _range_of(F.col("score"), score_cuts(h)))
    g = [*[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")).alias(f"_k{i}") for i, k in enumerate(keys)]]
    names = [f"_k{i}" for i in range(len(keys))]
    j = j.select("*", *g)
    w_b = Window.partitionBy(*names).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (j.groupBy(*names, "_b").agg(*[F.sum(c).alias(f"_o{c}") for c in sums])
               .select(*names, "_b", *[F.coalesce(F.sum(f"_o{c}").over(w_b), F.lit(0)).alias(f"_s{c}") for c in sums]))
    w = Window.partitionBy(*names, "_b").orderBy(F.col("score").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    run = j.select("*", *[F.sum(c).over(w).alias(f"_r{c}") for c in sums]).join(offsets, [*names, "_b"])
    up = {c: F.col(f"_r{c}") + F.col(f"_s{c}") for c in sums}
    if not ascending:
        whole_of = {"pos": "P", "neg": "Nn", "cnt": "total"}
        up = {c: F.col(whole_of[c]) - up[c] + F.col(c) for c in sums}
    return run.select(*h.columns, *[e.alias(f"c{c}") for c, e in up.items()], "P", "Nn", "total")


def auc_by_key(pred: DataFrame, key: str, label: str = "label", prob: str = "p1") -> dict:
    """V3 of each value of ``key`` (few), at once: the histogram is dealt out by
    ranges of (key, score), each task sums up its range, and a row per range and
    key comes back.  The same values as ``roc_auc``."""
    hist = score_histogram(pred, [key], label, prob)
    ranges = hist.repartitionByRange(hist.sparkSession.sparkContext.defaultParallelism, key, F.col("score").asc_nulls_first())

    def sums(batches):
        from pyspark import TaskContext
        seen: dict = {}
        for batch in batches:
            of = np.array(batch.column(key).to_pylist(), object)
            pos, neg = (batch.column(c).to_numpy() for c in ("pos", "neg"))
            for k in dict.fromkeys(of.tolist()):
                own = of == k
                p, n = pos[own], neg[own]
                s = seen.setdefault(k, [0, 0, 0])
                s[2] += int((p * (2 * (s[1] + np.cumsum(n) - n) + n)).sum())  # twice: ties count 1/2
                s[0], s[1] = s[0] + int(p.sum()), s[1] + int(n.sum())
        if seen:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(seen), batch.schema.field(key).type), pa.array([TaskContext.get().partitionId()] * len(seen), pa.int32()),
                *[pa.array([s[i] for s in seen.values()], pa.int64()) for i in range(3)]], [key, "part", "pos", "neg", "twice"])

    kind = hist.schema[key].dataType.simpleString()
    told = ranges.sortWithinPartitions(key, F.col("score").asc_nulls_first()).mapInArrow(
        sums, f"`{key}` {kind}, part int, pos long, neg long, twice long").collect()
    out: dict = {}
    for r in sorted(told, key=lambda r: r["part"]):
        pos, neg, twice = out.get(r[key], (0, 0, 0))
        out[r[key]] = (pos + r["pos"], neg + r["neg"], twice + r["twice"] + 2 * r["pos"] * neg)
    return {k: twice / 2 / (pos * neg) if pos and neg else None for k, (pos, neg, twice) in out.items()}


def roc_auc(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """V3: Mann-Whitney AUC, ties count 1/2; V13 Gini = 2 AUC - 1."""
    c = _cum(hist, keys, ascending=True)
    below = F.col("cneg") - F.col("neg")
    auc = F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))),
                       F.first("P").cast("double") * F.first("Nn"))
    return (c.groupBy(*keys).agg(auc.alias("roc_auc"))
            .withColumn("gini_coefficient", 2 * F.col("roc_auc") - 1))


def average_precision(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """V6: sum over distinct thresholds (descending) of (R_n - R_n-1) P_n."""
    c = _cum(hist, keys, ascending=False)
    prec = F.col("cpos") / F.col("ccnt")
    return c.groupBy(*keys).agg(F.try_divide(F.sum(F.col("pos") * prec), F.first("P").cast("double"))
                                .alias("precision_recall_auc"))


def roc_curve(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending."""
    c = _cum(hist, keys, ascending=False)
    return c.select(*keys, F.col("score").alias("threshold"),
                    F.try_divide(F.col("cneg"), F.col("Nn").cast("double")).alias("fpr"),
                    F.try_divide(F.col("cpos"), F.col("P").cast("double")).alias("tpr"))


def ks_statistic(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """KS = max(tpr - fpr)."""
    return roc_curve(hist, keys).groupBy(*keys).agg(F.max(F.col("tpr") - F.col("fpr")).alias("ks"))


def calibration_by_decile(hist: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Deciles of the ascending score order (a tie group stays in the
    decile of its first row): mean score, observed rate, count."""
    c = _cum(hist, keys, ascending=True)
    before = F.col("ccnt") - F.col("cnt")
    dec = F.least(F.floor(before * 10 / F.col("total")), F.lit(9)).cast("int")
    return (c.withColumn("decile", dec + 1).groupBy(*keys, "decile")
            .agg(F.sum("cnt").alias("n"), (F.sum(F.col("score") * F.col("cnt")) / F.sum("cnt")).alias("mean_score"),
                 (F.sum("pos") / F.sum("cnt")).alias("observed_rate")))


def cumulative_gains(pred: DataFrame, hist: DataFrame, keys: Sequence[str] = (), id_col: str = "id",
                     label: str = "label", prob: str = "p1", deciles: int = 10) -> DataFrame:
    """Rows ordered by (score desc, id asc); size = n div 10; gain_i =
    positives among the first i * size rows / all positives.  Each histogram
    row generates exactly the deciles whose cut m = i * size falls inside it
    (explode of a sequence, <= ``deciles`` rows per key in total); only the
    rows of those boundary score groups are ranked by id."""
    keys = list(keys)
    c = _cum(hist, keys, ascending=False)
    size = F.floor(F.col("total") / deciles)
    before = F.col("ccnt") - F.col("cnt")
    lo = F.floor(before / size) + 1
    hi = F.least(F.floor(F.col("ccnt") / size), F.lit(deciles))
    b = (c.where(size > 0).withColumn("_lo", lo).withColumn("_hi", hi).where(F.col("_lo") <= F.col("_hi"))
         .select(*keys, "score", "P", (F.col("cpos") - F.col("pos")).alias("pos_before"),
                 before.alias("cnt_before"), size.alias("size"),
                 F.explode(F.sequence(F.col("_lo").cast("int"), F.col("_hi").cast("int"))).alias("decile"))
         .withColumn("need", F.col("decile") * F.col("size") - F.col("cnt_before")))
    partial = _tie_parts(pred, b.select(*keys, "score", "decile", "need"), keys, id_col, label, prob, True)
    tot = hist.groupBy(*keys).agg(F.sum("pos").alias("P_all")) if keys else hist.agg(F.sum("pos").alias("P_all"))
    cuts = tot.select(*keys, "P_all", F.explode(F.sequence(F.lit(1), F.lit(deciles))).alias("decile"))
    g = (cuts.join(b.select(*keys, "decile", "pos_before"), [*keys, "decile"], "left")
         .join(partial, [*keys, "decile"], "left"))
    hits = F.coalesce(F.col("pos_before"), F.lit(0)) + F.coalesce(F.col("part"), F.lit(0))
    return g.select(*keys, F.col("decile").cast("int").alias("decile"),
                    _div0(hits.cast("double"), F.col("P_all").cast("double")).alias("gain"))


def _tie_parts(pred: DataFrame, groups: DataFrame, keys: list[str], id_col: str, label: str, prob: str, split: bool) -> DataFrame:
    """(keys, decile, part): positives among the first ``need`` rows, by id, of
    the score groups (keys, score, decile, need), at most ``deciles`` per key.
    ``split``: a group may hold most rows; its ids are split at pivots, whole
    ranges are summed, and only the range with the cut is ranked."""
    from featureforge.functions.rank import below_pivots, pivots
    scores = groups.select(*keys, "score").distinct()
    rows = pred.select(*keys, F.col(prob).cast("double").alias("score"), F.col(id_col).alias("_id"),
                       _y(label).alias("_y")).join(F.broadcast(scores), [*keys, "score"])
    if not split:
        ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "score").orderBy("_id")))
        return (ranked.join(F.broadcast(groups), [*keys, "score"]).where(F.col("_r") <= F.col("need"))
                .groupBy(*keys, "decile").agg(F.sum("_y").alias("part")))
    rows = rows.withColumn("_p", below_pivots(F.col("_id"), pivots(pred, id_col, TIE_PIVOTS)))
    ranges = rows.groupBy(*keys, "score", "_p").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"))
    w = Window.partitionBy(*keys, "score").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*keys, "score", "_p", "_n", "_s", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    cut = groups.join(ranges, [*keys, "score"]).withColumn("_left", F.col("need") - F.col("_before"))
    whole = (cut.where(F.col("_left") >= F.col("_n")).groupBy(*keys, "decile").agg(F.sum("_s").alias("part")))
    inner = cut.where((F.col("_left") > 0) & (F.col("_left") < F.col("_n"))).select(*keys, "score", "_p", "decile", "_left")
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "score", "_p").orderBy("_id")))
    some = (ranked.join(F.broadcast(inner), [*keys, "score", "_p"]).where(F.col("_r") <= F.col("_left"))
            .groupBy(*keys, "decile").agg(F.sum("_y").alias("part")))
    return whole.unionByName(some).groupBy(*keys, "decile").agg(F.sum("part").alias("part"))


def lift_summary(gains: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Top-decile lift = gain_1 x 10 (0 when no gain), top-quintile gain = gain_2."""
    return gains.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("decile") == 1, F.col("gain") * 10)), F.lit(0.0)).alias("top_decile_lift"),
        F.coalesce(F.max(F.when(F.col("decile") == 2, F.col("gain"))), F.lit(0.0)).alias("top_quintile_gain"))


# ------------------------------------------------------------------ V14, V16
def revenue_metrics(pred: DataFrame, monthly: str, keys: Sequence[str] = (), label: str = "label",
                    prediction: str = "prediction") -> DataFrame:
    """Monthly revenue at risk / potentially saved / false-alarm cost and capture rate."""
    y, yh, m = _y(label) == 1, F.col(prediction).cast("int") == 1, F.col(monthly).cast("double")
    agg = pred.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(y, m)), F.lit(0.0)).alias("total_revenue_at_risk"),
        F.coalesce(F.sum(F.when(y & yh, m)), F.lit(0.0)).alias("revenue_potentially_saved"),
        F.coalesce(F.sum(F.when(~y & yh, m)), F.lit(0.0)).alias("false_alarm_cost"))
    return agg.withColumn("revenue_capture_rate",
                          F.when(F.col("total_revenue_at_risk") > 0,
                                 F.col("revenue_potentially_saved") / F.col("total_revenue_at_risk"))
                          .otherwise(F.lit(0.0)))


def per_class_report(pred: DataFrame, keys: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Precision / recall / F1 / support per class (0 and 1)."""
    y, yh = _y(label), F.col(prediction).cast("int")
    agg = pred.groupBy(*keys).agg(*[e for c in (0, 1) for e in (
        F.count_if((y == c) & (yh == c)).alias(f"hit{c}"), F.count_if(yh == c).alias(f"pred{c}"),
        F.count_if(y == c).alias(f"sup{c}"))])
    parts = []
    for c in (0, 1):
        p = _div0(F.col(f"hit{c}").cast("double"), F.col(f"pred{c}"))
        r = _div0(F.col(f"hit{c}").cast("double"), F.col(f"sup{c}"))
        parts.append(agg.select(*keys, F.lit(c).alias("class"), p.alias("precision"), r.alias("recall"),
                                _div0(2 * F.col(f"hit{c}").cast("double"),
                                      F.col(f"pred{c}") + F.col(f"sup{c}")).alias("f1_score"),
                                F.col(f"sup{c}").alias("support")))
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ V18-V20
_LONG_METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "log_loss", "specificity",
                 "sensitivity", "balanced_accuracy", "precision_recall_auc", "matthews_corr_coef",
                 "brier_score", "gini_coefficient", "top_decile_lift", "top_quintile_gain",
                 "churn_detection_rate", "precision_in_targeting", "cost_savings_ratio",
                 "tp", "tn", "fp", "fn"]


def ranking_summary(pred: DataFrame, keys: Sequence[str], id_col: str = "id", label: str = "label",
                    prob: str = "p1", deciles: int = 10) -> DataFrame:
    """V3, V6, V12, V13 of every key from one cumulated table: AUC, average
    precision and the score groups at the decile cuts come out of one grouped
    aggregate (a row per key, with at most ``deciles`` groups each)."""
    keys = list(keys)
    hist = score_histogram(pred, keys, label, prob).persist()
    try:
        c = _cum(hist, keys, ascending=True)
        below = F.col("cneg") - F.col("neg")
        down_n, down_pos = F.col("total") - F.col("ccnt") + F.col("cnt"), F.col("P") - F.col("cpos") + F.col("pos")
        size = F.floor(F.col("total") / deciles)
        before = down_n - F.col("cnt")
        lo, hi = F.floor(before / size) + 1, F.least(F.floor(down_n / size), F.lit(deciles))
        at = F.when((size > 0) & (lo <= hi), F.transform(F.sequence(lo.cast("int"), hi.cast("int")), lambda d: F.struct(
            d.alias("decile"), "score", (down_pos - F.col("pos")).alias("pos_before"), (d * size - before).alias("need"), "cnt", "pos")))
        rows = c.groupBy(*keys).agg(
            F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))), F.first("P").cast("double") * F.first("Nn")).alias("auc"),
            F.try_divide(F.sum(F.col("pos") * (down_pos / down_n)), F.first("P").cast("double")).alias("ap"),
            F.first("P").alias("positives"), F.flatten(F.collect_list(at)).alias("cuts")).collect()
    finally:
        hist.unpersist()
    # a cut that takes a whole score group needs no ranking
    open_ = [(*[r[k] for k in keys], x["score"], x["decile"], x["need"]) for r in rows for x in r["cuts"] if 0 < x["need"] < x["cnt"]]
    most = max((x["cnt"] for r in rows for x in r["cuts"] if 0 < x["need"] < x["cnt"]), default=0)
    fields = ", ".join(f"`{k}` {pred.schema[k].dataType.simpleString()}" for k in keys)
    parts = {}
    if open_:
        groups = pred.sparkSession.createDataFrame(open_, f"{fields}, score double, decile int, need long")
        parts = {(*[r[k] for k in keys], r["decile"]): r["part"] for r in
                 _tie_parts(pred, groups, keys, id_col, label, prob, most > RANKED_ROWS).collect()}
    told = []
    for r in rows:
        key = [r[k] for k in keys]
        gain = {x["decile"]: (x["pos_before"] + (x["pos"] if x["need"] == x["cnt"] else parts.get((*key, x["decile"]), 0)))
                / r["positives"] if r["positives"] else 0.0 for x in r["cuts"]}
        told.append((*key, r["auc"], None if r["auc"] is None else 2 * r["auc"] - 1, r["ap"], gain.get(1, 0.0) * 10, float(gain.get(2, 0.0))))
    return pred.sparkSession.createDataFrame(told, f"{fields}, roc_auc double, gini_coefficient double, precision_recall_auc double, "
                                                   "top_decile_lift double, top_quintile_gain double")


def evaluate_all(pred: DataFrame, model_col: str = "model", id_col: str = "id", label: str = "label",
                 prediction: str = "prediction", prob: str = "p1") -> DataFrame:
    """Long (model, metric, value) for every model of a unioned
    prediction table: one grouped aggregate of counts, one cumulated table."""
    keys = [model_col]
    cm = classification_metrics(pred, keys, label=label, prediction=prediction, prob=prob)
    # a row per model
    wide = cm.join(F.broadcast(ranking_summary(pred, keys, id_col, label, prob)), keys)
    return wide.select(model_col, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in _LONG_METRICS])))


def best_model(long: DataFrame, metric: str = "roc_auc", model_col: str = "model") -> DataFrame:
    """The model with the highest value of ``metric`` (missing -> 0; ties: name)."""
    models = long.select(model_col).distinct()
    vals = long.where(F.col("metric") == metric).select(model_col, "value")
    j = models.join(vals, model_col, "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    return j.orderBy(F.desc("value"), F.asc(model_col)).limit(1).select(
        model_col, F.lit(metric).alias("metric"), "value")


def comparison_table(long: DataFrame, model_col: str = "model") -> DataFrame:
    """One row per model, type from the name, ordered by AUC descending."""
    cols = {"roc_auc": "AUC", "precision": "Precision", "recall": "Recall", "f1_score": "F1_Score",
            "accuracy": "Accuracy", "specificity": "Specificity", "log_loss": "Log_Loss",
            "tp": "True_Positives", "fp": "False_Positives", "tn": "True_Negatives", "fn": "False_Negatives"}
    wide = long.groupBy(model_col).agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(a)
                                         for m, a in cols.items()])
    name = F.initcap(F.regexp_replace(F.col(model_col), "_", " "))
    typ = (F.when(F.col(model_col).contains("optimized"), "Optimized")
           .when(F.col(model_col).contains("ensemble"), "Ensemble").otherwise("Baseline"))
    return wide.select(name.alias("Model"), typ.alias("Type"), *cols.values()).orderBy(F.desc("AUC"))
