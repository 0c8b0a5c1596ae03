"""W3 and R6 run the whole workflow."""

import inspect

import pytest

from featureforge.ml import models as M
from featureforge.plans import develop
from featureforge.plans.catalog import operations, workflows
from tests.conftest import SF_SMOKE

asked = inspect.signature(develop.develop_models)


class Asked(Exception):
    pass


@pytest.mark.parametrize("query", [workflows.q_w3, workflows.q_w3_cv, workflows.q_w3_interpretation, operations.q_runlog])
def test_the_queries_leave_no_trial_fold_or_round_out(spark, monkeypatch, query):
    seen = []

    def run(*args, **kw):
        told = asked.bind(*args, **kw)
        told.apply_defaults()
        seen.append(told.arguments)
        raise Asked

    monkeypatch.setattr(develop, "develop_models", run)
    if query is operations.q_runlog:    # only its third phase is asked for
        monkeypatch.setattr(operations, "run_phases", lambda spark, phases, base: phases[-1][1](None))
    with pytest.raises(Asked):
        query(spark, SF_SMOKE)
    (p,) = seen
    assert (p["n_trials"], p["folds"], p["startup"], p["n_bags"]) == (50, 5, 10, 10)
    assert p["kinds"] == M.BASE_MODELS and p["tune_kinds"] == ("random_forest", "xgboost", "lightgbm")
    assert not p["fixed"] and not p["tune_space"]


def _rows(spark):
    from pyspark.sql import functions as F
    return spark.range(0, 240, 1, 4).select("id", (F.col("id") % 3).cast("int").alias("fold"), ((F.col("id") / 3).cast("int") % 2).alias("label"),
                                            (F.col("id") % 7 + 3 * ((F.col("id") / 3).cast("int") % 2)).cast("double").alias("x")).persist()


def test_the_stack_is_cross_validated(spark, monkeypatch):
    rows, seen, stacking = _rows(spark), [], M.stacking

    def spied(train, features, kinds, fold_col="fold", k=5, parallelism=4):
        seen.append(({r[0] for r in train.select("id").collect()}, train.select(fold_col).distinct().count()))
        return stacking(train, features, kinds, fold_col, k, parallelism)

    monkeypatch.setattr(M, "stacking", spied)
    cv = {(r["model"], r["metric"]): r for r in M.cross_validate(rows, ["x"], ("naive_bayes",), "fold", 3, stack=("naive_bayes", "decision_tree")).collect()}
    assert {m for m, _ in cv} == {"naive_bayes", "stacking_ensemble"}
    assert all(r["folds"] == 3 for r in cv.values()) and cv["stacking_ensemble", "roc_auc"]["mean"] > 0.7
    # fold f's rows are in no fit that scores them; what is left is dealt into folds anew
    assert [ids for ids, _ in seen] == [{i for i in range(240) if i % 3 != f} for f in range(3)] and {n for _, n in seen} == {3}
    rows.unpersist()


def test_the_refit_of_a_tuned_booster_stops_on_the_validation_rows(spark):
    from pyspark.sql import functions as F
    rows = _rows(spark)
    noise = rows.withColumn("label", (F.xxhash64("id") % 2 == 0).cast("int"))
    model, _, best = M.tune(noise.where("id % 4 > 0"), ["x"], "xgboost", n_trials=1, startup=1, space={"learning_rate": M.Range(0.3, 0.9)},
                            fixed={"n_estimators": 3, "max_depth": 2},
                            valid=noise.where("id % 4 = 0"))
    losses = model.stages[-1].losses
    assert all(v is not None for _, v in losses)
    assert len(model.stages[-1].trees) == min(range(len(losses)), key=lambda i: losses[i][1])
    rows.unpersist()
