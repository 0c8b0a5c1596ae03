"""Physical-plan guards: no cartesian products, column pruning reaches the
parquet scan, fitted transforms add no shuffle."""

import pytest

from tests.conftest import SF_SMOKE

LAZY = ["flagship_segment_churn_value", "n1_churn_by_segment", "n5_churn_by_tenure_bins",
        "q7_duplicate_profile", "q11_categorical_profile", "f_business_features",
        "t1_stratified_split", "v11_cumulative_gains", "i9_interpolate_events", "q16_histogram"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_product(spark, name):
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, SF_SMOKE))
    assert "CartesianProduct" not in plan


def test_scan_prunes_columns(spark):
    import __spark_entry__ as E
    df = E.queries()["q7_duplicate_profile"](spark, SF_SMOKE)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" in text and "l_extendedprice" not in text      # 3 of 11 lineitem columns read
