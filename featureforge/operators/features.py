"""Business features (F1-F18), binning (B1-B7) and interactions.

Row-wise features are plain column expressions (one projection, inside
whole-stage codegen).  The few that need a global statistic (mean or max of a
column) read it from a one-row aggregate attached by a broadcast cross join
(its size is one row by construction) so the result stays lazy and
SQL-visible; no un-keyed window ever pulls the rows into one partition.
Schema decisions that depend on the data (ratio gates, top-variance columns)
are taken by one bounded aggregate at plan time.
"""

from __future__ import annotations

import itertools
import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import (as_double, cut, flag, is_value, numeric_cols,
                                          safe_div, sum_cols)
from featureforge.functions.stats import attach, collect_stats
from featureforge.roles import Roles

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed project's for equal results.
ADVANCED_SERVICE_KEYWORDS = ("service", "streaming", "online", "device", "tech")
ADVANCED_PREMIUM_KEYWORDS = ("streaming", "tech", "device")
BASIC_SERVICE_SUBSTRINGS = ("Service", "Streaming")        # case-sensitive
PRICE_TIER_BINS = (0, 35, 65, 89, math.inf)
PRICE_TIER_LABELS = ("Low", "Medium", "High", "Premium")
LIFECYCLE_BINS = (0, 6, 24, 48, math.inf)
LIFECYCLE_LABELS = ("New", "Growing", "Mature", "Loyal")
TENURE_GROUP_BINS = (0, 12, 24, 36, 48, 100)
TENURE_GROUP_LABELS = ("0-1yr", "1-2yr", "2-3yr", "3-4yr", "4+yr")
CHARGES_GROUP_BINS = (0, 35, 65, 89, 200)
CHARGES_GROUP_LABELS = ("Low", "Medium", "High", "Premium")
EPS = 1e-8
FE_MANUAL_PAIRS = (("tenure", "MonthlyCharges"), ("total_services", "MonthlyCharges"),
                   ("contract_risk_score", "payment_risk_score"),
                   ("family_score", "total_services"))
ADVANCED_MANUAL_PAIRS = (("tenure", "MonthlyCharges"), ("tenure", "total_services"),
                         ("MonthlyCharges", "total_services"),
                         ("contract_risk_score", "payment_risk_score"))
# ---------------------------------------------------------------------------


def _c(name: str) -> Column:
    return F.col(name)


# ----------------------------------------------------------------- F1 - F4
def clv_estimate(roles: Roles) -> Column:
    """tenure x monthly charge."""
    return _c(roles.tenure) * _c(roles.monthly)


def clv_per_month(roles: Roles) -> Column:
    """CLV / (tenure + 1)."""
    return safe_div(clv_estimate(roles), _c(roles.tenure) + 1)


def arpu(roles: Roles, fallback: bool = True) -> Column:
    """numeric(total) / (tenure + 1); unparsable/null -> monthly charge
    (``fallback=False``: the basic variant, no coercion fallback)."""
    v = safe_div(as_double(roles.total), _c(roles.tenure) + 1)
    return F.coalesce(v, _c(roles.monthly).cast("double")) if fallback else v


def revenue_momentum(roles: Roles) -> Column:
    """monthly / (numeric(total)/(tenure+1) + 1e-8)."""
    return safe_div(_c(roles.monthly), safe_div(as_double(roles.total), _c(roles.tenure) + 1) + EPS)


# ----------------------------------------------------------------- F5 - F8
def service_columns(df: DataFrame, roles: Roles, variant: str = "fe",
                    premium: bool = False) -> list[str]:
    """Columns picked by name: lower-cased keyword containment (fe/advanced),
    or case-sensitive substrings (basic).  The target and id never count."""
    skip = {roles.target, roles.id}
    cols = [c for c in df.columns if c not in skip]
    if variant == "basic":
        return [c for c in cols if any(s in c for s in BASIC_SERVICE_SUBSTRINGS)]
    kws = roles.service_keywords if variant == "fe" else ADVANCED_SERVICE_KEYWORDS
    picked = [c for c in cols if any(k in c.lower() for k in kws)]
    if premium:
        pk = roles.premium_keywords if variant == "fe" else ADVANCED_PREMIUM_KEYWORDS
        picked = [c for c in picked if any(k in c.lower() for k in pk)]
    return picked


def count_yes(cols: Sequence[str], roles: Roles) -> Column:
    """number of listed columns equal to the 'yes' value."""
    return sum_cols([is_value(c, roles.yes) for c in cols])


# ----------------------------------------------------------------- F9 - F17
def map_score(c: str, mapping: dict, default: int | None) -> Column:
    """literal lookup; unmapped or null -> default (None = null)."""
    e = None
    for k, v in mapping.items():
        cond = _c(c) == F.lit(k)
        e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
    if e is None:
        return F.lit(default).cast("int")
    return e.otherwise(F.lit(default).cast("int")) if default is not None else e


def tenure_risk_score(roles: Roles) -> Column:
    """tenure <= 6 -> 3, <= 24 -> 2, else 1 (null -> 1)."""
    t = _c(roles.tenure)
    return F.when(t <= 6, 3).when(t <= 24, 2).otherwise(1)


def is_new_customer(roles: Roles, months: int = 6) -> Column:
    return flag(_c(roles.tenure) <= months)


def is_loyal_customer(roles: Roles, months: int = 48) -> Column:
    return flag(_c(roles.tenure) >= months)


def has_internet(roles: Roles) -> Column:
    """internet != 'No' (a null counts as having it, like pandas)."""
    return (~_c(roles.internet).eqNullSafe(F.lit(roles.no))).cast("int")


def fiber_optic_user(roles: Roles, value: str = "Fiber optic") -> Column:
    return is_value(roles.internet, value)


def phone_service_complexity(roles: Roles) -> Column:
    """phone Yes + multiple lines Yes (0-2)."""
    return is_value(roles.phone, roles.yes) + is_value(roles.multiple_lines, roles.yes)


def family_score(roles: Roles) -> Column:
    """F16: partner Yes + dependents Yes (0-2)."""
    return is_value(roles.partner, roles.yes) + is_value(roles.dependents, roles.yes)


def life_stage(roles: Roles) -> Column:
    """later rule wins: Single < Couple < Family < Senior."""
    return (F.when(_c(roles.senior) == 1, "Senior")
            .when(_c(roles.dependents) == roles.yes, "Family")
            .when((_c(roles.partner) == roles.yes) & (_c(roles.dependents) == roles.no), "Couple")
            .otherwise("Single"))


# ----------------------------------------------------------------- B1 - B7
def tenure_category(roles: Roles) -> Column:
    return cut(roles.tenure, roles.tenure_bins, roles.tenure_labels, include_lowest=True)


def charges_category(roles: Roles) -> Column:
    return cut(roles.monthly, roles.charges_bins, roles.charges_labels, include_lowest=True)


def price_tier(roles: Roles) -> Column:
    return cut(roles.monthly, PRICE_TIER_BINS, PRICE_TIER_LABELS)


def lifecycle_stage(roles: Roles) -> Column:
    return cut(roles.tenure, LIFECYCLE_BINS, LIFECYCLE_LABELS)


def tenure_group(roles: Roles) -> Column:
    return cut(roles.tenure, TENURE_GROUP_BINS, TENURE_GROUP_LABELS)


def charges_group(roles: Roles) -> Column:
    return cut(roles.monthly, CHARGES_GROUP_BINS, CHARGES_GROUP_LABELS)


def log_sqrt_transform(df: DataFrame, log_cols: Sequence[str] = (),
                       sqrt_cols: Sequence[str] = ()) -> DataFrame:
    """log1p / sqrt of listed columns; out-of-domain -> NULL."""
    out = df
    for c in log_cols:
        out = out.withColumn(f"{c}_log", F.when(_c(c) > -1, F.log1p(_c(c))))
    for c in sqrt_cols:
        out = out.withColumn(f"{c}_sqrt", F.when(_c(c) >= 0, F.sqrt(_c(c))))
    return out


def binned_features(df: DataFrame, roles: Roles) -> DataFrame:
    """B5-B6 (``create_binned_features``)."""
    out = df
    if roles.tenure in df.columns:
        out = out.withColumn("tenure_group", tenure_group(roles))
    if roles.monthly in df.columns:
        out = out.withColumn("charges_group", charges_group(roles))
    return out


# ----------------------------------------------------------------- pipelines
def business_features(df: DataFrame, roles: Roles, clv: bool = True, arpu_: bool = True,
                      services: bool = True, risk: bool = True, stats: dict | None = None) -> DataFrame:
    """The full business-feature step (F1-F3, F5-F7, F9, F10, B1, F12, B2,
    F13-F18).  A feature is added only when its inputs exist; each group has
    a switch.  Global mean/max come from ONE one-row aggregate attached by a
    broadcast cross join, or from ``stats`` frozen at fit time (literals)."""
    cols = set(df.columns)
    ref = (lambda n: F.lit(stats.get(n))) if stats is not None else _c
    new: list[tuple[str, Column]] = []
    has = lambda *names: all(getattr(roles, n) in cols for n in names)
    if clv and has("tenure", "monthly"):
        new += [("CLV_estimate", clv_estimate(roles)), ("CLV_per_month", clv_per_month(roles))]
    if arpu_ and has("total", "tenure"):
        new.append(("ARPU", arpu(roles, fallback=roles.monthly in cols)))
    svc = service_columns(df, roles) if services else []
    if svc:
        prem = service_columns(df, roles, premium=True)
        new += [("total_services", count_yes(svc, roles)),
                ("premium_services", count_yes(prem, roles)),
                ("service_adoption_rate", count_yes(svc, roles) / F.lit(float(len(svc))))]
    if risk:
        if has("contract"):
            new.append(("contract_risk_score",
                        map_score(roles.contract, roles.contract_risk, roles.risk_default)))
        if has("payment"):
            new.append(("payment_risk_score",
                        map_score(roles.payment, roles.payment_risk, roles.risk_default)))
    if has("tenure"):
        new += [("tenure_category", tenure_category(roles)),
                ("is_new_customer", is_new_customer(roles)),
                ("is_loyal_customer", is_loyal_customer(roles))]
    stat_exprs = []
    if has("monthly"):
        new.append(("charges_category", charges_category(roles)))
        stat_exprs.append(F.avg(_c(roles.monthly)).alias("_mean_monthly"))
        new.append(("above_avg_charges", flag(_c(roles.monthly) > ref("_mean_monthly"))))
    if has("internet"):
        new += [("has_internet", has_internet(roles)), ("fiber_optic_user", fiber_optic_user(roles))]
    if has("phone", "multiple_lines"):
        new.append(("phone_service_complexity", phone_service_complexity(roles)))
    if has("senior", "partner", "dependents"):
        new += [("family_score", family_score(roles)), ("life_stage", life_stage(roles))]
    names = [n for n, _ in new]
    if "CLV_estimate" in names and "total_services" in names:
        stat_exprs += [F.max(clv_estimate(roles)).alias("_max_clv"),
                       F.max(count_yes(svc, roles)).alias("_max_svc")]
        new.append(("customer_value_score",
                    safe_div(clv_estimate(roles), ref("_max_clv")) * 0.7
                    + safe_div(count_yes(svc, roles), ref("_max_svc")) * 0.3))
    if stats is not None or not stat_exprs:
        return df.select(*df.columns, *[e.alias(n) for n, e in new])
    base = attach(df, df.agg(*stat_exprs))
    return base.select(*df.columns, *[e.alias(n) for n, e in new])


def business_feature_stats(df: DataFrame, roles: Roles) -> dict:
    """Fit-time statistics of ``business_features`` (one aggregate)."""
    svc = service_columns(df, roles)
    exprs = []
    if roles.monthly in df.columns:
        exprs.append(F.avg(_c(roles.monthly)).alias("_mean_monthly"))
    if roles.tenure in df.columns and roles.monthly in df.columns and svc:
        exprs += [F.max(clv_estimate(roles)).alias("_max_clv"),
                  F.max(count_yes(svc, roles)).alias("_max_svc")]
    return df.agg(*exprs).first().asDict() if exprs else {}


def advanced_business_features(df: DataFrame, roles: Roles, create_clv: bool = True,
                               create_service_metrics: bool = True,
                               create_risk_scores: bool = True,
                               create_customer_segments: bool = True,
                               stats: dict | None = None) -> DataFrame:
    """The business transformer with four switches (advanced variant:
    revenue momentum, no 'multiple' keyword, tenure risk, price tier,
    lifecycle stage, family size score)."""
    cols = set(df.columns)
    has = lambda *names: all(getattr(roles, n) in cols for n in names)
    new: list[tuple[str, Column]] = []
    stat_exprs = []
    if create_clv and has("tenure", "monthly"):
        new += [("CLV_estimate", clv_estimate(roles)), ("CLV_per_month", clv_per_month(roles))]
        if has("total"):
            new.append(("revenue_momentum", revenue_momentum(roles)))
    if create_service_metrics:
        svc = service_columns(df, roles, "advanced")
        if svc:
            new += [("total_services", count_yes(svc, roles)),
                    ("service_adoption_rate", count_yes(svc, roles) / F.lit(float(len(svc))))]
            prem = service_columns(df, roles, "advanced", premium=True)
            if prem:
                new += [("premium_services", count_yes(prem, roles)),
                        ("premium_adoption_rate", count_yes(prem, roles) / F.lit(float(len(prem))))]
    if create_risk_scores:
        if has("contract"):
            new.append(("contract_risk_score",
                        map_score(roles.contract, roles.contract_risk, roles.risk_default)))
        if has("payment"):
            new.append(("payment_risk_score",
                        map_score(roles.payment, roles.payment_risk, roles.risk_default)))
        if has("tenure"):
            new.append(("tenure_risk_score", tenure_risk_score(roles)))
    if create_customer_segments:
        if has("monthly"):
            stat_exprs.append(F.avg(_c(roles.monthly)).alias("_mean_monthly"))
            mean = F.lit(stats.get("_mean_monthly")) if stats is not None else _c("_mean_monthly")
            new += [("price_tier", price_tier(roles)),
                    ("above_avg_spender", flag(_c(roles.monthly) > mean))]
        if has("tenure"):
            new.append(("lifecycle_stage", lifecycle_stage(roles)))
        if has("partner", "dependents"):
            new.append(("family_size_score", family_score(roles)))
    base = attach(df, df.agg(*stat_exprs)) if stat_exprs and stats is None else df
    return base.select(*df.columns, *[e.alias(n) for n, e in new])


def basic_business_features(df: DataFrame, roles: Roles) -> DataFrame:
    """Basic variant: CLV, ARPU without coercion fallback, case-sensitive
    service count, risk maps without default (unmapped -> null)."""
    cols = set(df.columns)
    out = []
    if roles.tenure in cols and roles.monthly in cols:
        out.append(clv_estimate(roles).alias("CLV_estimate"))
    if roles.total in cols and roles.tenure in cols:
        out.append(arpu(roles, fallback=False).alias("ARPU"))
    svc = service_columns(df, roles, "basic")
    if svc:
        out.append(count_yes(svc, roles).alias("total_services"))
    if roles.contract in cols:
        out.append(map_score(roles.contract, roles.contract_risk, None).alias("contract_risk_score"))
    if roles.payment in cols:
        out.append(map_score(roles.payment, roles.payment_risk, None).alias("payment_risk_score"))
    return df.select(*df.columns, *out)


# ----------------------------------------------------------------- X1 - X5
def pairwise_products(df: DataFrame, cols: Sequence[str], degree: int = 2,
                      sep: str = "_x_", keep_existing: bool = False) -> DataFrame:
    """Interaction-only products of every 2..degree subset, named by
    joining the column names with ``sep``.  A product whose name already
    exists overwrites it (unless ``keep_existing``)."""
    out = df
    for d in range(2, degree + 1):
        for combo in itertools.combinations(cols, d):
            name = sep.join(combo)
            if keep_existing and name in out.columns:
                continue
            e = _c(combo[0]).cast("double")
            for c in combo[1:]:
                e = e * _c(c).cast("double")
            out = out.withColumn(name, e)
    return out


def polynomial_features(df: DataFrame, cols: Sequence[str], degree: int = 2,
                        drop_original: bool = True) -> DataFrame:
    """All monomials of degree 1..d (powers named ``a^2``, products
    ``a b``); the degree-1 originals are dropped from the new block."""
    exprs = []
    for d in range(2, degree + 1):
        for combo in itertools.combinations_with_replacement(cols, d):
            parts, e = [], None
            for c, grp in itertools.groupby(combo):
                k = len(list(grp))
                parts.append(c if k == 1 else f"{c}^{k}")
                term = _c(c).cast("double")
                for _ in range(k - 1):
                    term = term * _c(c).cast("double")
                e = term if e is None else e * term
            exprs.append(e.alias(" ".join(parts)))
    keep = [c for c in df.columns if not (drop_original and c in cols)]
    return df.select(*keep, *exprs)


def top_variance_columns(df: DataFrame, k: int = 10, exclude: Sequence[str] = ()) -> list[str]:
    """X4 fit: numeric columns with sample variance > 0, highest first (one agg)."""
    cols = numeric_cols(df, exclude)
    if not cols:
        return []
    row = df.agg(*[F.var_samp(_c(c).cast("double")).alias(c) for c in cols]).collect()[0]
    scored = [(c, row[c]) for c in cols if row[c] is not None and not math.isnan(row[c]) and row[c] > 0]
    scored.sort(key=lambda t: -t[1])
    return [c for c, _ in scored[:k]]


def manual_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], variant: str = "fe",
                 gates: dict | None = None) -> DataFrame:
    """Multiplicative pair always; ratio a/(b+1e-8) only when the gate
    holds on the whole column (fit-time, one aggregate):
    fe: every value of a and b > 0 (a null fails); advanced: no zero in b."""
    present = [(a, b) for a, b in pairs if a in df.columns and b in df.columns]
    if not present:
        return df
    row = gates if gates is not None else pair_gates(df, present, variant)
    sep_mult = "_x_" if variant == "fe" else "_mult_"
    out = df
    for i, (a, b) in enumerate(present):
        out = out.withColumn(f"{a}{sep_mult}{b}", _c(a) * _c(b))
        if row[f"g{i}"]:
            out = out.withColumn(f"{a}_div_{b}", safe_div(_c(a), _c(b) + EPS))
    return out


def pair_gates(df: DataFrame, present, variant: str = "fe") -> dict:
    """The ratio gates of X5, decided by one aggregate."""
    gates = []
    for i, (a, b) in enumerate(present):
        if variant == "fe":
            g = (F.count_if(~(_c(a) > 0) | _c(a).isNull() | ~(_c(b) > 0) | _c(b).isNull()) == 0)
        else:
            g = F.count_if(_c(b) == 0) == 0
        gates.append(g.alias(f"g{i}"))
    return collect_stats(df, [], extra=gates)


def fe_pairs(roles: Roles) -> list[tuple[str, str]]:
    sub = {"tenure": roles.tenure, "MonthlyCharges": roles.monthly}
    return [(sub.get(a, a), sub.get(b, b)) for a, b in FE_MANUAL_PAIRS]


def interaction_features(df: DataFrame, roles: Roles, degree: int = 2, gates: dict | None = None) -> DataFrame:
    """The FE interaction step: products of the key numerics (tenure,
    monthly, CLV, services) then the four manual pairs."""
    key = [c for c in (roles.tenure, roles.monthly, "CLV_estimate", "total_services")
           if c in df.columns]
    out = pairwise_products(df, key, degree) if len(key) >= 2 else df
    return manual_pairs(out, fe_pairs(roles), "fe", gates)


def advanced_interactions(df: DataFrame, roles: Roles, degree: int = 2,
                          max_features: int = 10, exclude: Sequence[str] = ()) -> DataFrame:
    """X4 + advanced X5: products of the top-variance numerics, then the
    advanced manual pairs (``_mult_`` / ``_div_``)."""
    top = top_variance_columns(df, max_features, exclude)
    out = pairwise_products(df, top, degree) if len(top) > 1 else df
    sub = {"tenure": roles.tenure, "MonthlyCharges": roles.monthly}
    pairs = [(sub.get(a, a), sub.get(b, b)) for a, b in ADVANCED_MANUAL_PAIRS]
    return manual_pairs(out, pairs, "advanced")
