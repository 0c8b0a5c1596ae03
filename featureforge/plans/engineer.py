"""Whole feature-engineering pipelines (W2, W4, W5, W6) as Spark ML Pipelines.

``Pipeline.fit`` runs one bounded statistics job per fit-dependent stage;
the fitted ``PipelineModel.transform`` is a single lazy projection (every
statistic is a literal), so scoring new data adds no job and no shuffle and
also works on a stream.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.functions.exprs import numeric_cols
from featureforge.ml.base import StatsEstimator, StatsModel
from featureforge.operators import features as X
from featureforge.operators.encode import OneHotEncoder
from featureforge.operators.impute import Imputer
from featureforge.operators.outlier import OutlierCapper
from featureforge.operators.scale import Scaler
from featureforge.operators.select import FeatureSelector
from featureforge.roles import Roles
from featureforge.session import cut_lineage


class BusinessModel(StatsModel):
    def apply(self, df, cfg, st):
        roles = self.roles_of(cfg)
        if cfg.get("variant") == "advanced":
            sw = cfg.get("switches", {})
            return X.advanced_business_features(df, roles, stats=st, **sw)
        return X.business_features(df, roles, stats=st)


class BusinessFeatures(StatsEstimator):
    """W6 / F-step: business features with their global statistics frozen.
    ``variant='advanced'`` takes the four switches of the business transformer."""

    model_class = BusinessModel

    def __init__(self, roles: Roles = Roles(), variant: str = "fe", create_clv: bool = True,
                 create_service_metrics: bool = True, create_risk_scores: bool = True,
                 create_customer_segments: bool = True):
        super().__init__(roles=roles, variant=variant, switches=dict(
            create_clv=create_clv, create_service_metrics=create_service_metrics,
            create_risk_scores=create_risk_scores, create_customer_segments=create_customer_segments))

    def compute(self, df, cfg):
        roles = self.roles_of(cfg)
        if cfg.get("variant") == "advanced":
            return {"_mean_monthly": df.agg(F.avg(roles.monthly)).first()[0]} if roles.monthly in df.columns else {}
        return X.business_feature_stats(df, roles)


class InteractionModel(StatsModel):
    def apply(self, df, cfg, st):
        return X.interaction_features(df, self.roles_of(cfg), cfg.get("degree", 2), gates=st)


class Interactions(StatsEstimator):
    """X1 + X5 step; the ratio gates are decided at fit."""

    model_class = InteractionModel

    def __init__(self, roles: Roles = Roles(), degree: int = 2):
        super().__init__(roles=roles, degree=degree)

    def compute(self, df, cfg):
        roles = self.roles_of(cfg)
        key = [c for c in (roles.tenure, roles.monthly, "CLV_estimate", "total_services") if c in df.columns]
        prod = X.pairwise_products(df, key, cfg.get("degree", 2)) if len(key) >= 2 else df
        present = [(a, b) for a, b in X.fe_pairs(roles) if a in prod.columns and b in prod.columns]
        return X.pair_gates(prod, present, "fe") if present else {}


class PolynomialModel(StatsModel):
    def apply(self, df, cfg, st):
        return X.polynomial_features(df, st["cols"], cfg["degree"], drop_original=False)


class Polynomial(StatsEstimator):
    """X3 as a stage: degree-d block of the first ``first`` numeric columns
    (chosen at fit), appended to the frame."""

    model_class = PolynomialModel

    def __init__(self, first: int = 5, degree: int = 2, exclude: Sequence[str] = ()):
        super().__init__(first=first, degree=degree, exclude=list(exclude))

    def compute(self, df, cfg):
        return {"cols": numeric_cols(df, cfg["exclude"])[:cfg["first"]]}


def engineering_pipeline(roles: Roles, numeric: str = "median", categorical: str = "mode",
                         outlier: str = "iqr", scale: str = "standard", drop_first: bool = True,
                         variance_threshold: float = 0.01, skip_binary_outliers: bool = True,
                         max_categories: int = 50) -> Pipeline:
    """Impute -> cap -> business -> interactions -> one-hot (with the
    analytic dummy-variance guard) -> scale -> variance selection."""
    ex = [roles.id, roles.target]
    return Pipeline(stages=[
        Imputer(numeric, categorical, exclude=ex),
        OutlierCapper(outlier, exclude=ex, skip_binary=skip_binary_outliers),
        BusinessFeatures(roles),
        Interactions(roles),
        OneHotEncoder(exclude=ex, drop_first=drop_first, max_categories=max_categories,
                      min_dummy_variance=variance_threshold,
                      label_order={"tenure_category": list(roles.tenure_labels),
                                   "charges_category": list(roles.charges_labels)}),
        Scaler(scale, exclude=ex),
        FeatureSelector(roles.target, exclude=[roles.id], methods=["variance"],
                        variance_threshold=variance_threshold),
    ])


def basic_preprocess_pipeline(roles: Roles) -> Pipeline:
    """Impute (median / mode) -> IQR cap -> one-hot (drop first) -> standard scale."""
    ex = [roles.id, roles.target]
    return Pipeline(stages=[Imputer("median", "mode", exclude=ex),
                            OutlierCapper("iqr", exclude=ex, skip_binary=False),
                            OneHotEncoder(exclude=ex, drop_first=True),
                            Scaler("standard", exclude=ex, skip_binary=False, fallback="none")])


def advanced_preprocess_pipeline(roles: Roles, scaling: str = "robust", polynomial: bool = True) -> Pipeline:
    """Impute (median; other strategies: ``advanced_preprocess``) -> IQR cap with
    bounds frozen at fit -> robust (or quantile/standard) scale -> degree-2
    polynomial block of the first five numeric columns."""
    ex = [roles.id, roles.target]
    stages = [Imputer("median", "mode", exclude=ex), OutlierCapper("iqr", exclude=ex, skip_binary=False),
              Scaler(scaling, exclude=ex, skip_binary=False)]
    if polynomial:
        stages.append(Polynomial(5, 2, exclude=ex))
    return Pipeline(stages=stages)


def advanced_preprocess(df: DataFrame, roles: Roles, impute: str = "median", scaling: str = "robust",
                        polynomial: bool = True, isolation: bool = False) -> DataFrame:
    """W5 with its strategies: numeric columns imputed by ``median``, ``knn``
    (five nearest rows) or ``iterative`` regression, then the pipeline fitted and
    applied; ``isolation`` adds the isolation-forest flag of the result."""
    from featureforge.ml.isolation import IsolationForestFlag
    from featureforge.ml.iterative import iterative_impute
    from featureforge.ml.knn import knn_impute
    num = numeric_cols(df, [roles.id, roles.target])
    if impute not in ("median", "knn", "iterative"):
        raise ValueError(f"unknown imputation {impute}")
    if impute == "knn":
        df = cut_lineage(knn_impute(df, num, 5, roles.id))  # each stage's fit reads it, the neighbours are searched once
    elif impute == "iterative":
        df = iterative_impute(df.withColumns({c: F.col(c).cast("double") for c in num}), num)
    out = advanced_preprocess_pipeline(roles, scaling, polynomial).fit(df).transform(df)
    return IsolationForestFlag(num, roles.id).fit(out).transform(out) if isolation else out


def engineer(df: DataFrame, roles: Roles, **kw) -> tuple[DataFrame, object]:
    """Fit W2 on ``df`` and return (engineered frame, fitted PipelineModel)."""
    model = engineering_pipeline(roles, **kw).fit(df)
    return model.transform(df), model


def stage_report(model) -> list[dict]:
    """Fitted state of every stage (R-style report of what each stage decided)."""
    out = []
    for st in model.stages:
        d = json.loads(st.getOrDefault(st.state)) if st.hasParam("state") and st.isDefined(st.state) else {}
        out.append({"stage": type(st).__name__, "keys": sorted(d)})
    return out
