"""Catalogued queries: imputation, outliers, encoding, scaling (I, O, E, C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.functions.exprs import as_double
from featureforge.operators import encode as E
from featureforge.operators import impute as I
from featureforge.operators import outlier as O
from featureforge.operators import scale as C
from featureforge.plans.registry import register
from featureforge.roles import CUSTOMER_360_ROLES as R
from featureforge.sources.tables import customer_360, customer_360_dirty, table, with_c360

NUM = ["senior", "tenure", "monthly_charges", "total_charges"]
CAT = ["partner", "dependents", "svc_online_urgent", "svc_streaming_low", "svc_device_final",
       "svc_tech_pending", "contract", "payment"]


def _mode_sql(col, src):
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} ASC LIMIT 1)")


# ------------------------------------------------------------------ I
def _imputed(spark, sf, numeric, categorical):
    d = customer_360_dirty(spark, sf)
    out = I.Imputer(numeric, categorical, exclude=[R.id, R.target]).fit(d).transform(d)
    return out.select(R.id, "tenure", "monthly_charges", "contract")


def _impute_sql(num_stat, cat_fill):
    return with_c360(f"""
SELECT customer_id,
  round(coalesce(CAST(tenure AS DOUBLE), ({num_stat.format(c='tenure')})), 6) AS tenure,
  round(coalesce(monthly_charges, ({num_stat.format(c='monthly_charges')})), 6) AS monthly_charges,
  coalesce(contract, {cat_fill}) AS contract
FROM c360_dirty
""")


_MEDIAN = "SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM c360_dirty"
_MEAN = "SELECT avg(CAST({c} AS DOUBLE)) FROM c360_dirty"
_MODE = ("SELECT CAST({c} AS DOUBLE) FROM c360_dirty WHERE {c} IS NOT NULL GROUP BY {c} "
         "ORDER BY count(*) DESC, {c} ASC LIMIT 1")


@register("i1_i2_impute_median_mode", sql=_impute_sql(_MEDIAN, _mode_sql("contract", "c360_dirty")))
def q_imp_median(spark, sf):
    """I1 median (exact, interpolated) for numeric nulls, I2 mode for categorical."""
    return _imputed(spark, sf, "median", "mode")


@register("i1_impute_mean", sql=_impute_sql(_MEAN, _mode_sql("contract", "c360_dirty")))
def q_imp_mean(spark, sf):
    return _imputed(spark, sf, "mean", "mode")


@register("i1_i3_impute_mode_unknown", sql=_impute_sql(_MODE, "'Unknown'"))
def q_imp_mode(spark, sf):
    """I1 most frequent (ties -> smallest) and I3 the literal 'Unknown'."""
    return _imputed(spark, sf, "most_frequent", "unknown")


@register("i7_fallback_fill", sql=with_c360("""
SELECT customer_id, round(coalesce(monthly_charges, TRY_CAST(trim(total_charges) AS DOUBLE)), 6) AS monthly_charges
FROM c360_dirty
"""))
def q_fallback(spark, sf):
    d = customer_360_dirty(spark, sf).withColumn("total_numeric", as_double(R.total))
    return I.fallback_fill(d, "monthly_charges", "total_numeric").select(R.id, "monthly_charges")


@register("i8_drop_missing", sql=with_c360("""
SELECT customer_id FROM c360_dirty WHERE tenure IS NOT NULL AND contract IS NOT NULL AND monthly_charges IS NOT NULL
"""))
def q_dropna(spark, sf):
    return I.drop_missing(customer_360_dirty(spark, sf), ["tenure", "contract", "monthly_charges"]).select(R.id)


@register("i9_interpolate_events", sql="""
WITH e AS (
  SELECT event_id, user_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS x,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
w AS (
  SELECT *,
    last_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    last_value(CASE WHEN x IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    last_value(x IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nv,
    last_value(CASE WHEN x IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS np
  FROM e)
SELECT event_id, round(CASE WHEN x IS NOT NULL THEN x WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
                      ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END, 6) AS value
FROM w
""")
def q_interp(spark, sf):
    """I9 on events: value blanked for every 7th event id, refilled linearly
    per user in (ts, event_id) order."""
    ev = table(spark, sf, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")).alias("value"))
    return I.interpolate_numeric(ev, "value", ["ts", "event_id"], ["user_id"]).select("event_id", "value")


# ------------------------------------------------------------------ O
def _cap_sql(cols, k=1.5):
    items = []
    for c in cols:
        q = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) FROM c360)"
        items.append(f"""round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest(CAST({c} AS DOUBLE),
            {q}[1] - {k} * ({q}[2] - {q}[1])), {q}[2] + {k} * ({q}[2] - {q}[1])) END, 6) AS {c}""")
    return items


@register("o1_cap_iqr", sql=with_c360(
    "SELECT customer_id, senior, " + ", ".join(_cap_sql(["tenure", "monthly_charges", "total_charges"])) + " FROM c360"))
def q_cap_iqr(spark, sf):
    """O1 with the 0/1 guard on: senior is left alone."""
    c = customer_360(spark, sf).select(R.id, *NUM)
    return O.OutlierCapper("iqr", exclude=[R.id]).fit(c).transform(c)


@register("o1_cap_iqr_compat", sql=with_c360(
    "SELECT customer_id, " + ", ".join(_cap_sql(NUM)) + " FROM c360"))
def q_cap_iqr_compat(spark, sf):
    """O1 exactly as the surveyed pipeline: 0/1 senior (Q1 = Q3 = 0) is
    flattened to 0."""
    c = customer_360(spark, sf).select(R.id, *NUM)
    return O.OutlierCapper("iqr", exclude=[R.id], skip_binary=False).fit(c).transform(c)


def _cap_z_sql(cols):
    items = []
    for c in cols:
        s = f"(SELECT avg(CAST({c} AS DOUBLE)) AS m, stddev_samp(CAST({c} AS DOUBLE)) AS s FROM c360)"
        items.append(f"""round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest(CAST({c} AS DOUBLE),
            (SELECT m - 3.0 * s FROM {s})), (SELECT m + 3.0 * s FROM {s})) END, 6) AS {c}""")
    return items


@register("o2_cap_zscore", sql=with_c360(
    "SELECT customer_id, senior, " + ", ".join(_cap_z_sql(["tenure", "monthly_charges", "total_charges"])) + " FROM c360"))
def q_cap_z(spark, sf):
    """O2: clip to mean +- 3 sample sd."""
    c = customer_360(spark, sf).select(R.id, *NUM)
    return O.OutlierCapper("zscore", exclude=[R.id]).fit(c).transform(c)


@register("o3_filter_zscore", sql=with_c360("""
SELECT customer_id FROM s2
""", extra_ctes="""
s0 AS (SELECT * FROM c360),
s1 AS (SELECT * FROM s0 WHERE abs(CAST(tenure AS DOUBLE) - (SELECT avg(CAST(tenure AS DOUBLE)) FROM s0))
                           / (SELECT stddev_pop(CAST(tenure AS DOUBLE)) FROM s0) < 3),
s2 AS (SELECT * FROM s1 WHERE abs(monthly_charges - (SELECT avg(monthly_charges) FROM s1))
                           / (SELECT stddev_pop(monthly_charges) FROM s1) < 3)
"""))
def q_filter_z(spark, sf):
    """O3: sequential |z| < 3 filter, tenure then monthly charge (survivors)."""
    c = customer_360(spark, sf)
    return O.filter_zscore(c, ["tenure", "monthly_charges"]).select(R.id)


@register("o4_outlier_audit", sql=with_c360("""
SELECT "column", 'IQR' AS method, CAST(o AS BIGINT) AS outliers_detected, round(o * 100.0e0 / n, 6) AS outlier_pct,
       round(lo, 6) AS lower, round(hi, 6) AS upper, 'capped' AS action
FROM (
  SELECT "column", count(*) FILTER (WHERE x < lo OR x > hi) AS o, count(*) AS n, lo, hi
  FROM (SELECT u."column", u.x, q[1] - 1.5 * (q[2] - q[1]) AS lo, q[2] + 1.5 * (q[2] - q[1]) AS hi
        FROM (UNPIVOT (SELECT CAST(tenure AS DOUBLE) AS tenure, monthly_charges, total_charges FROM c360)
              ON tenure, monthly_charges, total_charges INTO NAME "column" VALUE x) u
        JOIN (UNPIVOT (SELECT quantile_cont(CAST(tenure AS DOUBLE), [0.25, 0.75]) AS tenure,
                              quantile_cont(monthly_charges, [0.25, 0.75]) AS monthly_charges,
                              quantile_cont(total_charges, [0.25, 0.75]) AS total_charges FROM c360)
              ON tenure, monthly_charges, total_charges INTO NAME "column" VALUE q) b USING ("column"))
  GROUP BY "column", lo, hi)
"""))
def q_audit(spark, sf):
    """The capper's audit (count and % beyond the bounds, bounds, action).
    The UNPIVOT in the oracle drops null values, so rows with a null value are
    outside both counts; the customer_360 numerics have none at sf0.01."""
    c = customer_360(spark, sf).select(R.id, *NUM)
    model = O.OutlierCapper("iqr", exclude=[R.id]).fit(c)
    return O.outlier_audit(model, spark)


# ------------------------------------------------------------------ E
def _onehot_sql(levels: dict, src="c360", key="customer_id"):
    items = []
    for c, vals in levels.items():
        for v in vals:
            items.append(f"CAST(coalesce(CAST({c} AS VARCHAR) = '{v}', false) AS INTEGER) AS \"{c}_{v}\"")
    return f"SELECT {key}, " + ", ".join(items) + f" FROM {src}"


_YN = ["Yes"]
_SEG = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRI = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_ONEHOT_LEVELS = {"partner": _YN, "dependents": _YN, "svc_online_urgent": _YN, "svc_streaming_low": _YN,
                  "svc_device_final": _YN, "svc_tech_pending": _YN, "contract": _SEG, "payment": _PRI}


@register("e1_one_hot_drop_first", sql=with_c360(_onehot_sql(_ONEHOT_LEVELS)))
def q_onehot(spark, sf):
    """Dummies in sorted order, first level dropped; target excluded."""
    c = customer_360(spark, sf).select(R.id, *CAT)
    return E.OneHotEncoder(exclude=[R.id, R.target], drop_first=True).fit(c).transform(c)


@register("e1_one_hot_guarded", sql=_onehot_sql(
    {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]},
    src="customer", key="c_custkey, c_name"))
def q_onehot_guard(spark, sf):
    """E1 with the G3 id guard on ``customer``: the id-like c_name is left as
    is (no 1500 dummies), the segment gets all five dummies."""
    cu = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return E.OneHotEncoder(exclude=["c_custkey"], drop_first=False).fit(cu).transform(cu)


def _label_sql(col, values, src):
    whens = " ".join(f"WHEN coalesce(CAST({col} AS VARCHAR), 'nan') = '{v}' THEN {i}"
                     for i, v in enumerate(values))
    return f"CAST(CASE {whens} END AS INTEGER) AS {col}"


_SEG_ALL = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_PRI_ALL = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("e2_label_encode", sql=with_c360(
    "SELECT customer_id, " + _label_sql("contract", _SEG_ALL + ["nan"], "c360_dirty") + ", "
    + _label_sql("payment", _PRI_ALL, "c360_dirty") + ", total_charges FROM c360_dirty"))
def q_label(spark, sf):
    """E2 on the dirty table: null contract -> 'nan' class (sorted last);
    the near-unique total_charges text is guarded (left as is)."""
    d = customer_360_dirty(spark, sf).select(R.id, "contract", "payment", "total_charges")
    return E.LabelEncoder(exclude=[R.id]).fit(d).transform(d)


@register("e2_label_encode_wide", sql="""
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name,
       CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment FROM customer
""")
def q_label_wide(spark, sf):
    """E2 without a category limit: customer names (all distinct) and segments."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return E.LabelEncoder(max_categories=None).fit(c).transform(c)


@register("e3_target_encode_wide", sql="""
WITH t AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_orderpriority AS priority,
                  CAST(o_orderstatus = 'F' AS DOUBLE) AS y FROM orders),
g AS (SELECT avg(y) AS gm FROM t),
c AS (SELECT cust, avg(y) AS m, count(*) AS n FROM t GROUP BY cust),
p AS (SELECT priority, avg(y) AS m, count(*) AS n FROM t GROUP BY priority)
SELECT o_orderkey, round((c.m * c.n + gm * 10) / (c.n + 10), 6) AS cust_target_encoded,
       round((p.m * p.n + gm * 10) / (p.n + 10), 6) AS priority_target_encoded
FROM t JOIN c USING (cust) JOIN p USING (priority) CROSS JOIN g
""")
def q_target_wide(spark, sf):
    """E3 without a category limit: customers (thousands of values) and priorities of orders."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"),
                                          F.col("o_orderpriority").alias("priority"),
                                          (F.col("o_orderstatus") == "F").cast("double").alias("y"))
    out = E.TargetEncoder("y", None, exclude=["o_orderkey"], max_categories=None).fit(o).transform(o)
    return out.drop("y")


def _bits_sql(col, values, bits):
    code = "CASE " + " ".join(f"WHEN {col} = '{v}' THEN {i + 1}" for i, v in enumerate(values)) + " ELSE 0 END"
    return [f"CAST(({code} >> {bits - 1 - b}) & 1 AS INTEGER) AS {col}_{b}" for b in range(bits)]


@register("e4_binary_encode", sql=with_c360(
    "SELECT customer_id, " + ", ".join(_bits_sql("contract", _SEG_ALL, 3) + _bits_sql("payment", _PRI_ALL, 3))
    + " FROM c360"))
def q_binary(spark, sf):
    """Label code + 1 in ceil(log2(k+1)) bit columns, MSB first."""
    c = customer_360(spark, sf).select(R.id, "contract", "payment")
    return E.LabelEncoder(exclude=[R.id], binary=True).fit(c).transform(c)


def _te_sql(col):
    return f"""round((SELECT (avg(y) * count(*) + g.gm * 10) / (count(*) + 10) FROM t t2
                       WHERE t2.{col} = t.{col}), 6) AS {col}_target_encoded"""


@register("e3_target_encode", sql=with_c360(
    "SELECT customer_id, " + ", ".join(_te_sql(c) for c in ["contract", "payment", "partner"])
    + " FROM t CROSS JOIN g",
    extra_ctes="""t AS (SELECT customer_id, contract, payment, partner, CAST(churn = 'Yes' AS DOUBLE) AS y FROM c360),
g AS (SELECT avg(y) AS gm FROM t)"""))
def q_target_enc(spark, sf):
    """Smoothed (m = 10) positive rate per category, originals dropped."""
    c = customer_360(spark, sf).select(R.id, "contract", "payment", "partner", R.target)
    out = E.TargetEncoder(R.target, R.positive, exclude=[R.id]).fit(c).transform(c)
    return out.drop(R.target)


# ------------------------------------------------------------------ C
def _scale_sql(kind):
    items = []
    for c in ["tenure", "monthly_charges", "total_charges"]:
        x = f"CAST({c} AS DOUBLE)"
        if kind == "standard":
            center = f"(SELECT avg({x}) FROM c360)"
            scale = f"(SELECT CASE WHEN stddev_pop({x}) > 0 THEN stddev_pop({x}) ELSE 1 END FROM c360)"
        elif kind == "minmax":
            center = f"(SELECT min({x}) FROM c360)"
            scale = f"(SELECT CASE WHEN max({x}) <> min({x}) THEN max({x}) - min({x}) ELSE 1 END FROM c360)"
        else:
            center = f"(SELECT quantile_cont({x}, 0.5) FROM c360)"
            iqr = f"(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))"
            scale = f"(SELECT CASE WHEN {iqr} <> 0 THEN {iqr} ELSE 1 END FROM c360)"
        items.append(f"round(({x} - {center}) / {scale}, 6) AS {c}")
    return with_c360("SELECT customer_id, senior, " + ", ".join(items) + " FROM c360")


def _scaled(spark, sf, method):
    c = customer_360(spark, sf).select(R.id, *NUM)
    return C.Scaler(method, exclude=[R.id]).fit(c).transform(c)


@register("c1_c5_scale_standard", sql=_scale_sql("standard"))
def q_std(spark, sf):
    """C1 population-sd standardisation; C5 skips the 0/1 senior column."""
    return _scaled(spark, sf, "standard")


@register("c2_scale_minmax", sql=_scale_sql("minmax"))
def q_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@register("c3_scale_robust", sql=_scale_sql("robust"))
def q_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@register("c6_scale_dispatch_unknown", sql=_scale_sql("standard"))
def q_dispatch(spark, sf):
    """An unknown method name falls back to standard scaling."""
    return _scaled(spark, sf, "no-such-method")


def _c4_sql(k: int = 1000):
    fr = "[" + ", ".join(f"{repr(j / (k - 1))}e0" if "e" not in repr(j / (k - 1)) else repr(j / (k - 1))
                         for j in range(k)) + "]"
    n = k - 1
    cols = ["tenure", "monthly_charges", "total_charges"]
    qq = "qq AS (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {fr}) AS q_{c}" for c in cols) + " FROM c360)"

    def interp(c, cnt):
        i = f"greatest(least({cnt}, {n}), 1)"
        lo, hi = f"q_{c}[{i}]", f"q_{c}[{i} + 1]"
        return (f"(({i} - 1) + CASE WHEN {hi} > {lo} THEN (CAST({c} AS DOUBLE) - {lo}) / ({hi} - {lo}) "
                f"ELSE 0.0 END) / {n}")
    items = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        below = f"len(list_filter(q_{c}, lambda v: v <= {x}))"
        above = f"len(list_filter(q_{c}, lambda v: v < {x}))"
        items.append(f"round(CASE WHEN {c} IS NULL THEN NULL WHEN {x} <= q_{c}[1] THEN 0.0 "
                     f"WHEN {x} >= q_{c}[{k}] THEN 1.0 ELSE ({interp(c, below)} + {interp(c, above)}) / 2 END, 6) AS {c}")
    return with_c360("SELECT customer_id, senior, " + ", ".join(items) + " FROM c360 CROSS JOIN qq", extra_ctes=qq)


@register("c4_scale_quantile", sql=_c4_sql())
def q_quantile(spark, sf):
    """C4: uniform quantile transform through 1000 exact quantiles (piecewise
    linear, ties averaged up/down); senior (0/1) skipped."""
    return _scaled(spark, sf, "quantile")
