"""Spark ML Estimator/Model pairs whose fitted state is a small JSON document.

``fit`` runs a few bounded statistics jobs (fused aggregates, or a long-format
value count filtered by a cardinality guard) and freezes the result; the
model's ``transform`` is a lazy projection with literals, so it adds no job
and no shuffle and can be applied to a stream.  Both classes are
``DefaultParamsWritable`` so they persist inside a ``PipelineModel`` (S5).
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from featureforge.roles import Roles


class _JsonParams(Params):
    config = Param(Params._dummy(), "config", "operator configuration (JSON)",
                   typeConverter=TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted state (JSON)",
                  typeConverter=TypeConverters.toString)

    def _cfg(self) -> dict:
        return json.loads(self.getOrDefault(self.config)) if self.isDefined(self.config) else {}

    def _st(self) -> dict:
        return json.loads(self.getOrDefault(self.state)) if self.isDefined(self.state) else {}

    @staticmethod
    def roles_of(cfg: dict) -> Roles:
        r = cfg.get("roles")
        return Roles(**r) if r else Roles()


def _jsonable(v):
    if isinstance(v, Roles):
        d = asdict(v)
        return {k: (list(x) if isinstance(x, tuple) else x) for k, x in d.items()}
    if isinstance(v, tuple):
        return list(v)
    return v


class StatsModel(Model, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted stage: ``apply(df, cfg, state)`` builds the projection."""

    def __init__(self, config: str | None = None, state: str | None = None):
        super().__init__()
        if config is not None:
            self._set(config=config)
        if state is not None:
            self._set(state=state)

    def apply(self, df: DataFrame, cfg: dict, st: dict) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df, self._cfg(), self._st())

    @property
    def fitted(self) -> dict:
        return self._st()


class StatsEstimator(Estimator, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator: ``compute(df, cfg) -> state`` runs the bounded fit job."""

    model_class: type = StatsModel

    def __init__(self, **kwargs):
        super().__init__()
        self._set(config=json.dumps({k: _jsonable(v) for k, v in kwargs.items()}))

    def compute(self, df: DataFrame, cfg: dict) -> dict:  # pragma: no cover
        raise NotImplementedError

    def _fit(self, df: DataFrame):
        cfg = self._cfg()
        st = self.compute(df, cfg)
        return self.model_class(config=json.dumps(cfg), state=json.dumps(st, default=float))
