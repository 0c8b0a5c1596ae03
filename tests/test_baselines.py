"""All default base models, boosting stopped early on the scored rows."""

import pytest
from pyspark.sql import functions as F

from featureforge.ml import models as M
from featureforge.ml.boosting import BoostedTrees
from featureforge.plans.catalog import models as catalog
from tests.conftest import SF_SMOKE


class Asked(Exception):
    pass


def test_the_query_fits_every_base_model(spark, monkeypatch):
    def asked(train, valid, features, models=M.BASE_MODELS, *args, **kw):
        raise Asked(*models)

    monkeypatch.setattr(M, "train_baselines", asked)
    with pytest.raises(Asked) as told:
        catalog.q_baselines(spark, SF_SMOKE)
    assert told.value.args == M.BASE_MODELS and set(M.BOOSTED) < set(M.BASE_MODELS)


def _noise(spark):
    rows = spark.range(0, 600, 1, 4).select("id", (F.xxhash64("id", F.lit(1)) % 2 == 0).cast("int").alias("label"),
                                            (F.xxhash64("id", F.lit(2)) % 1000).cast("double").alias("x"))
    return rows.where("id % 3 > 0"), rows.where("id % 3 = 0")


def test_boosted_baselines_stop_on_the_validation_rows(spark, monkeypatch):
    train, valid = _noise(spark)
    monkeypatch.setattr(M, "fit_with_early_stopping", lambda both, features, kind, **kw: M.make_pipeline(
        kind, features, valid_col="is_valid", early_stopping_rounds=2, n_estimators=12, max_depth=2).fit(both))
    fitted, status = M.train_baselines(train, valid, ["x"], ("naive_bayes", "xgboost", "no_such_model"))
    seen = [v for _, v in fitted["xgboost"].stages[-1].losses]
    assert None not in seen and len(fitted["xgboost"].stages[-1].trees) < 12
    told = {r["model"]: r for r in status.collect()}
    assert [told[k]["status"] for k in ("naive_bayes", "xgboost", "no_such_model")] == ["ok", "ok", "failed"]
    assert "no_such_model" in told["no_such_model"]["error"] and told["no_such_model"]["roc_auc"] is None
    for k in ("naive_bayes", "xgboost"):
        r = told[k]
        assert r["training_time"] > 0 and 0 <= r["roc_auc"] <= 1 and r["tp"] + r["fp"] + r["tn"] + r["fn"] == valid.count()
        assert abs(r["accuracy"] - (r["tp"] + r["tn"]) / valid.count()) < 1e-12


def test_validation_labels_are_no_training_facts(spark):
    """The base margin of a model that starts from the average is that of the training rows."""
    train, valid = _noise(spark)
    both = M.with_validation(train.withColumn("label", (F.col("id") % 4 == 1).cast("int")), valid.withColumn("label", F.lit(1)), 600)
    model = BoostedTrees("lightgbm", ["x"], n_estimators=1, valid_col="is_valid").fit(both)
    rate = train.agg(F.avg((F.col("id") % 4 == 1).cast("int"))).first()[0]
    assert abs(1 / (1 + 2.718281828459045 ** -model.base) - rate) < 1e-9
