"""Validation and profiling (Q1-Q18) and exploration reports.

Reports are small tidy DataFrames.  Wide per-column statistics are computed
by ONE fused aggregate (G1) and turned into rows with ``inline(array(struct))``;
per-value statistics (distinct counts, top values) go through long format
(G6): unpivot -> partial aggregate per (column, value) -> small result, so no
``count(distinct)`` Expand over the raw rows and no hot key in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureforge.functions.exprs import (long_format, numeric_cols, safe_div,
                                          string_cols)
from featureforge.functions.stats import attach, safe_corr
from featureforge.roles import Roles

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed project's for equal results.
HIGH_CARDINALITY_ISSUE = 50        # categorical columns above this are an issue
HIGH_CARDINALITY_PROFILE = 20      # categorical profile flag
TOP_VALUES = 10
HIGH_CORRELATION = 0.7
IQR_K = 1.5
Z_LIMIT = 3.0
MOD_Z_LIMIT = 3.5
MOD_Z_FACTOR = 0.6745
REC_MISSING = "Address missing values - consider imputation strategies"
REC_IMBALANCE = "Handle class imbalance using SMOTE, class weights, or ensemble methods"
REC_MULTICOLLINEARITY = "Address multicollinearity - consider feature selection or regularization"
# ---------------------------------------------------------------------------


def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One-row frame of per-column structs -> one row per struct."""
    return df.select(F.inline(F.array(*structs)))


def _kind(dt) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                       T.DoubleType, T.DecimalType)):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "categorical"
    return "other"


# ------------------------------------------------------------------ Q1-Q3
def validate_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Q1: missing and extra columns; valid <=> nothing missing."""
    have, want = list(df.columns), list(expected)
    missing = sorted(set(want) - set(have))
    extra = sorted(set(have) - set(want))
    spark = df.sparkSession
    return spark.createDataFrame(
        [(len(missing), len(extra), ",".join(missing), ",".join(extra), not missing)],
        "n_missing int, n_extra int, missing string, extra string, schema_valid boolean")


def quality_gate(df: DataFrame, max_missing: float = 0.3, min_rows: int = 1000) -> DataFrame:
    """Q2: rows >= min_rows, missing cells / all cells <= max_missing (a
    FRACTION), non-empty; overall = AND.  One aggregate."""
    n_cols = len(df.columns)
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total_missing = nulls[0] if nulls else F.lit(0)
    for e in nulls[1:]:
        total_missing = total_missing + e
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), total_missing.alias("_miss"))
    ratio = safe_div(F.col("_miss").cast("double"), F.col("total_rows") * F.lit(n_cols))
    return agg.select(
        "total_rows",
        F.lit(min_rows).alias("min_rows_required"),
        (F.col("total_rows") >= min_rows).alias("has_enough_rows"),
        ratio.alias("missing_fraction"),
        F.lit(float(max_missing)).alias("max_missing_allowed"),
        F.coalesce(ratio <= max_missing, F.lit(False)).alias("acceptable_missing"),
        (F.col("total_rows") > 0).alias("is_not_empty"),
    ).withColumn("overall_valid", F.col("has_enough_rows") & F.col("acceptable_missing")
                 & F.col("is_not_empty"))


def validation_report(df: DataFrame, expected: Sequence[str], max_missing: float = 0.3,
                      min_rows: int = 1000) -> DataFrame:
    """Q3: schema and quality results as one report row."""
    return validate_schema(df, expected).crossJoin(quality_gate(df, max_missing, min_rows))


# ------------------------------------------------------------------ Q4-Q10
def schema_profile(df: DataFrame) -> DataFrame:
    """Q4 + Q6: position, name, dtype and kind (numeric / categorical) of
    every column, with the row count."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), _kind(f.dataType))
            for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(rows, "position int, column string, dtype string, kind string")
    return meta.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("total_records"))))


def null_counts(df: DataFrame) -> DataFrame:
    """Per-column null counts and row count: one aggregate, tidy rows."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    return _rows(agg, [F.struct(F.lit(c).alias("column"),
                                F.col(f"_m{i}").alias("missing_count"),
                                F.col("_n").alias("total_rows"))
                       for i, c in enumerate(cols)])


def missing_profile(df: DataFrame) -> DataFrame:
    """Q5: columns with at least one null: count and % of rows."""
    nc = null_counts(df)
    return (nc.where(F.col("missing_count") > 0)
            .select("column", "missing_count",
                    (F.col("missing_count") * 100.0 / F.col("total_rows")).alias("missing_pct")))


def missing_summary(df: DataFrame) -> DataFrame:
    """Q5 totals: missing cells and % of all cells."""
    nc = null_counts(df)
    n_cols = len(df.columns)
    return nc.agg(F.sum("missing_count").alias("total_missing_cells"),
                  (F.sum("missing_count") * 100.0
                   / (F.max("total_rows") * F.lit(n_cols))).alias("pct_missing_cells"))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Q7: rows equal to an earlier row (nulls compare equal) = n - distinct.
    groupBy(all columns) with partial aggregation: a hot duplicate group is
    collapsed map-side before the shuffle."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg((F.sum(F.col("_c") - 1)).cast("bigint").alias("duplicate_count"),
                  (F.sum(F.col("_c") - 1) * 100.0 / F.sum("_c")).alias("duplicate_pct"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count) over non-null values, via long format."""
    long = long_format(df, cols, "column", "value", cast="string")
    return (long.where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))


def unique_profile(df: DataFrame, cols: Sequence[str] | None = None,
                   approx: bool = False) -> DataFrame:
    """Q8: distinct non-null values per column and % of rows.  Exact via
    long-format value counts (one shuffle of distinct pairs), or
    ``approx=True``: HyperLogLog in a single aggregate."""
    cols = list(cols) if cols is not None else df.columns
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    if approx:
        agg = df.agg(*[F.approx_count_distinct(c).alias(f"_d{i}") for i, c in enumerate(cols)])
        per = _rows(agg, [F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("unique_count"))
                          for i, c in enumerate(cols)])
    else:
        vc = value_counts(df, cols)
        found = vc.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
        names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
        per = names.join(found, "column", "left").select(
            "column", F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"))
    return attach(per, n).select("column", "unique_count",
                                 safe_div(F.col("unique_count") * 100.0, F.col("_n")).alias("unique_pct"))


def issue_list(df: DataFrame, max_categories: int = HIGH_CARDINALITY_ISSUE) -> DataFrame:
    """Q9: all-null columns and categorical columns with > 50 distinct values."""
    nc = null_counts(df)
    all_null = (nc.where((F.col("missing_count") == F.col("total_rows")) & (F.col("total_rows") > 0))
                .select(F.lit("all_missing").alias("issue"), "column"))
    cats = string_cols(df)
    if not cats:
        return all_null
    from featureforge.operators.encode import plausible_columns
    borderline, approx = plausible_columns(df, cats, max_categories)
    sure = [c for c in cats if c not in borderline]        # HLL says far above the limit
    spark = df.sparkSession
    high = spark.createDataFrame([("high_cardinality", c) for c in sure], "issue string, column string")
    if borderline:
        up = unique_profile(df, borderline)
        high = high.unionByName(up.where(F.col("unique_count") > max_categories)
                                .select(F.lit("high_cardinality").alias("issue"), "column"))
    return all_null.unionByName(high)


def completeness(df: DataFrame) -> DataFrame:
    """Q10: % non-null cells, # columns with nulls, # rows with any null."""
    cols = df.columns
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    agg = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(any_null).alias("records_with_missing_data"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    miss = [F.col(f"_m{i}") for i in range(len(cols))]
    total = miss[0]
    for m in miss[1:]:
        total = total + m
    with_null = F.lit(0)
    for m in miss:
        with_null = with_null + (m > 0).cast("int")
    return agg.select(
        safe_div((F.col("_n") * len(cols) - total) * 100.0, F.col("_n") * len(cols)).alias("overall_completeness"),
        with_null.alias("columns_with_missing_data"),
        "records_with_missing_data")


# ------------------------------------------------------------------ Q11-Q12
def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None,
                        top: int = TOP_VALUES) -> DataFrame:
    """Q11: per categorical column: distinct count, the top ``top`` values
    with count and % of rows (ties: value ascending), high-cardinality flag.
    ``row_number() <= top`` is planned as a WindowGroupLimit: each map task
    keeps only its local top values before the shuffle."""
    cols = list(cols) if cols is not None else string_cols(df)
    vc = value_counts(df, cols)
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    topv = vc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    card = vc.groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    out = topv.join(card, "column")
    return attach(out, n).select(
        "column", "rank", "value", "count",
        (F.col("count") * 100.0 / F.col("_n")).alias("pct"),
        "unique_values",
        (F.col("unique_values") > HIGH_CARDINALITY_PROFILE).alias("is_high_cardinality"))


def target_distribution(df: DataFrame, roles: Roles) -> DataFrame:
    """Q12 (per class): count and % of all rows, per target value."""
    t = F.col(roles.target)
    g = df.where(t.isNotNull()).groupBy(t.cast("string").alias("target")).agg(
        F.count(F.lit(1)).alias("count"))
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    return attach(g, n).select("target", "count", (F.col("count") * 100.0 / F.col("_n")).alias("pct"))


def class_balance(df: DataFrame, roles: Roles, ratio_limit: float = 1.5) -> DataFrame:
    """Q12 (summary): total, missing count/%, number of classes; for a binary
    target minority, majority, ratio and imbalanced (ratio > 1.5)."""
    t = F.col(roles.target)
    g = df.where(t.isNotNull()).groupBy(t).agg(F.count(F.lit(1)).alias("c"))
    s = g.agg(F.count(F.lit(1)).alias("n_classes"), F.min("c").alias("mn"), F.max("c").alias("mx"))
    m = df.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if(t.isNull()).alias("missing_count"))
    binary = F.col("n_classes") == 2
    ratio = F.when(binary, F.col("mx") / F.col("mn"))
    return m.crossJoin(s).select(
        "total_samples", "missing_count",
        safe_div(F.col("missing_count") * 100.0, F.col("total_samples")).alias("missing_pct"),
        "n_classes",
        F.when(binary, F.col("mn")).alias("minority_class_count"),
        F.when(binary, F.col("mx")).alias("majority_class_count"),
        ratio.alias("imbalance_ratio"),
        (ratio > ratio_limit).alias("is_imbalanced"))


# ------------------------------------------------------------------ Q13-Q14
def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q13: Pearson r for every ordered pair (diagonal included), pairwise
    complete.  ONE aggregate computes per column (count, population sd) and per
    pair (covar_pop, both-present count); a pair whose both-present count
    equals both column counts has r = covar / (sd_a sd_b) exactly.  Only
    pairs touched by unmatched nulls get a second, masked aggregate.  The
    n x n result (a bounded one-row collect) comes back as a small table."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    x = {c: F.col(c).cast("double") for c in cols}
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    exprs = []
    for i, c in enumerate(cols):
        exprs += [F.count(x[c]).alias(f"n{i}"), F.stddev_pop(x[c]).alias(f"s{i}")]
    for i, j in pairs:
        a, b = x[cols[i]], x[cols[j]]
        exprs += [F.covar_pop(a, b).alias(f"c{i}_{j}"),
                  F.count_if(a.isNotNull() & b.isNotNull()).alias(f"n{i}_{j}")]
    row = df.agg(*exprs).first() if exprs else None
    r = {}
    masked = []
    for i, j in pairs:
        if row[f"n{i}_{j}"] == row[f"n{i}"] == row[f"n{j}"]:
            si, sj, cv = row[f"s{i}"], row[f"s{j}"], row[f"c{i}_{j}"]
            r[(i, j)] = (cv / (si * sj)) if (si and sj and cv is not None) else None
        else:
            masked.append((i, j))
    if masked:
        row2 = df.agg(*[safe_corr(cols[i], cols[j]).alias(f"r{i}_{j}") for i, j in masked]).first()
        for i, j in masked:
            v = row2[f"r{i}_{j}"]
            r[(i, j)] = None if v is None or v != v else v
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                v = 1.0 if row[f"s{i}"] else None
            else:
                v = r[(min(i, j), max(i, j))]
            rows.append((i, j, a, b, v))
    return df.sparkSession.createDataFrame(
        rows, "i int, j int, feature1 string, feature2 string, correlation double")


def correlation_summary(corr: DataFrame) -> DataFrame:
    """Q13 summary: max abs(r) and mean abs(r) (diagonal included), the mean
    taken per column then over columns, skipping nulls."""
    per_col = corr.groupBy("j").agg(F.avg(F.abs("correlation")).alias("m"),
                                    F.max(F.abs("correlation")).alias("x"))
    return per_col.agg(F.max("x").alias("max_correlation"), F.avg("m").alias("mean_correlation"))


def high_correlations(corr: DataFrame, threshold: float = HIGH_CORRELATION) -> DataFrame:
    """Q14: pairs i < j with abs(r) > threshold."""
    return (corr.where((F.col("i") < F.col("j")) & (F.abs("correlation") > threshold))
            .select("feature1", "feature2", "correlation"))


# ------------------------------------------------------------------ Q15
def outlier_report(df: DataFrame, roles: Roles | None = None, cols: Sequence[str] | None = None,
                   k: float = IQR_K) -> DataFrame:
    """Q15: per numeric column (id excluded), on non-null values: IQR rule
    (strict), z > 3 with population sd, modified z > 3.5 with the MAD
    (MAD = 0: any value off the median is an outlier).  Quartiles, medians
    and MADs are exact (``rank.quantiles``: no per-value map in one task on
    large inputs); moments and the three counts are one aggregate each."""
    from featureforge.functions.rank import quantiles
    exclude = [roles.id] if roles else []
    cols = list(cols) if cols is not None else numeric_cols(df, exclude)
    x = {c: F.col(c).cast("double") for c in cols}
    q = quantiles(df, dict(x), [0.25, 0.5, 0.75])
    mom = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(x[c]).alias(f"mu{i}"), F.stddev_pop(x[c]).alias(f"sd{i}"), F.count(x[c]).alias(f"n{i}"))]).first()
    have = [c for c in cols if q[c] is not None]
    mad = quantiles(df, {c: F.abs(x[c] - F.lit(q[c][1])) for c in have}, [0.5]) if have else {}
    counts = []
    for i, c in enumerate(cols):
        if q[c] is None:
            continue
        q1, med, q3 = q[c]
        lo, hi = q1 - (q3 - q1) * k, q3 + (q3 - q1) * k
        mu, sd, m = mom[f"mu{i}"], mom[f"sd{i}"], mad[c][0]
        xi = x[c]
        z = F.abs(xi - F.lit(mu)) / F.lit(sd) > Z_LIMIT if sd else F.lit(False)
        modz = (xi != F.lit(med)) if m == 0 else (F.abs(F.lit(MOD_Z_FACTOR) * (xi - F.lit(med)) / F.lit(m)) > MOD_Z_LIMIT)
        counts += [F.count_if(xi.isNotNull() & ((xi < lo) | (xi > hi))).alias(f"iqr{i}"),
                   F.count_if(xi.isNotNull() & z).alias(f"z{i}"),
                   F.count_if(xi.isNotNull() & modz).alias(f"mz{i}")]
    cnt = df.agg(*counts).first() if counts else None
    rows = []
    for i, c in enumerate(cols):
        n = mom[f"n{i}"]
        if q[c] is None:
            rows.append((c, n, None, None, 0, None, 0, None, 0, None))
            continue
        q1, _, q3 = q[c]
        pct = (lambda v: v * 100.0 / n if n else None)
        rows.append((c, n, q1 - (q3 - q1) * k, q3 + (q3 - q1) * k,
                     cnt[f"iqr{i}"], pct(cnt[f"iqr{i}"]), cnt[f"z{i}"], pct(cnt[f"z{i}"]),
                     cnt[f"mz{i}"], pct(cnt[f"mz{i}"])))
    return df.sparkSession.createDataFrame(rows, "column string, n bigint, iqr_lower double, iqr_upper double, "
                                                 "iqr_outliers bigint, iqr_pct double, zscore_outliers bigint, "
                                                 "zscore_pct double, modified_zscore_outliers bigint, "
                                                 "modified_zscore_pct double")


# ------------------------------------------------------------------ Q16-Q18
def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Q16: equal-width counts over [min, max]; bins are [a, b) except the
    last, which is closed.  Empty bins reported with 0."""
    x = F.col(column).cast("double")
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    b = F.least(F.floor(safe_div(F.col("_x") - F.col("_mn"), w)) + 1, F.lit(bins))
    b = F.coalesce(b, F.lit(1)).cast("int")
    counted = (attach(df.select(x.alias("_x")).where(F.col("_x").isNotNull()), mm)
               .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    allb = mm.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "_mn", "_mx")
    return (allb.join(counted, "bin", "left")
            .select(F.col("bin").cast("int").alias("bin"),
                    (F.col("_mn") + (F.col("bin") - 1) * (F.col("_mx") - F.col("_mn")) / bins).alias("lower"),
                    (F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / bins).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def box_stats(df: DataFrame, column: str, by: str, k: float = IQR_K, max_groups: int = 100) -> DataFrame:
    """Q17: per class quartiles, IQR and whiskers (most extreme values inside
    Q1 - k IQR / Q3 + k IQR).  Classes are few (guarded by ``max_groups``);
    each class's quartiles are exact (``rank.quantiles``), the whiskers are one
    grouped aggregate with the bounds as a small broadcast table."""
    from featureforge.functions.rank import quantiles
    x = F.col(column).cast("double")
    base = df.select(F.col(by).alias("group"), x.alias("_x")).where(F.col("_x").isNotNull())
    groups = [r[0] for r in base.select("group").distinct().limit(max_groups + 1).collect()]
    if len(groups) > max_groups:
        raise ValueError(f"{by} has more than {max_groups} classes")
    rows = []
    for g in groups:
        part = base.where(F.col("group").eqNullSafe(F.lit(g)))
        q = quantiles(part, {"x": F.col("_x")}, [0.25, 0.5, 0.75])["x"]
        rows.append((g, q[0], q[1], q[2], q[0] - (q[2] - q[0]) * k, q[2] + (q[2] - q[0]) * k))
    gtype = dict(base.dtypes)["group"]
    qt = df.sparkSession.createDataFrame(rows, f"group {gtype}, q1 double, median double, q3 double, "
                                               "lo double, hi double")
    j = base.join(F.broadcast(qt), base["group"].eqNullSafe(qt["group"])).drop(qt["group"])
    return j.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(F.col("_x") >= F.col("lo"), F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= F.col("hi"), F.col("_x"))).alias("whisker_high"))


def dtype_distribution(before: DataFrame, after: DataFrame) -> DataFrame:
    """Q18: columns per dtype and their filled (non-null) cells, before and
    after a transformation: one aggregate of a count per column for each side,
    summed by dtype."""
    def cells(df, tag):
        kinds = {f"c{i}": f.dataType.simpleString() for i, f in enumerate(df.schema.fields)}
        counted = df.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(kinds, df.columns)]).agg(*[F.count(k).alias(k) for k in kinds])
        long = counted.select(F.inline(F.array(*[F.struct(F.lit(t).alias("dtype"), F.col(k).alias("k")) for k, t in kinds.items()])))
        return long.groupBy("dtype").agg(F.count("k").cast("int").alias(f"n_{tag}"), F.sum("k").alias(f"filled_{tag}"))

    both = cells(before, "before").join(cells(after, "after"), "dtype", "full")
    return both.fillna(0).select("dtype", "n_before", "n_after", "filled_before", "filled_after")


# ------------------------------------------------------------------ R5
def recommendations(df: DataFrame, roles: Roles, numeric: Sequence[str] | None = None,
                    corr: DataFrame | None = None) -> DataFrame:
    """Rule rows over the profile: missing cells > 5 %, imbalanced
    target, any high correlation pair."""
    ms = missing_summary(df).select((F.col("pct_missing_cells") > 5).alias("fire"))
    cb = class_balance(df, roles).select(F.coalesce("is_imbalanced", F.lit(False)).alias("fire"))
    if corr is None:
        corr = correlation_matrix(df, numeric if numeric is not None else numeric_cols(df, [roles.id]))
    hc = high_correlations(corr).agg((F.count(F.lit(1)) > 0).alias("fire"))
    parts = [ms.select(F.lit(1).alias("rule"), F.lit("missing_values").alias("check"),
                       F.lit(REC_MISSING).alias("recommendation"), "fire"),
             cb.select(F.lit(2).alias("rule"), F.lit("class_imbalance").alias("check"),
                       F.lit(REC_IMBALANCE).alias("recommendation"), "fire"),
             hc.select(F.lit(3).alias("rule"), F.lit("multicollinearity").alias("check"),
                       F.lit(REC_MULTICOLLINEARITY).alias("recommendation"), "fire")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.where("fire").drop("fire")
