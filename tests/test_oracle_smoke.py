"""A slice of the catalogue checked against its DuckDB oracle at sf0.001
(the full gate runs at sf0.01 with tools/oracle_check.py)."""

import math
import os

import duckdb
import pytest

from tests.conftest import SF_SMOKE

NAMES = ["n1_churn_by_segment", "f_business_features", "q15_outlier_report", "e1_one_hot_drop_first",
         "c1_c5_scale_standard", "l3_anova_f_topk", "t1_stratified_split", "v18_evaluate_all",
         "i9_interpolate_events", "flagship_segment_churn_value",
         "q1_q3_validation_report", "q11_categorical_profile", "q13_correlation_matrix", "q17_box_stats",
         "n5_churn_by_tenure_bins", "i1_i2_impute_median_mode", "o1_cap_iqr_compat", "o3_filter_zscore",
         "x4_x5_top_variance_interactions", "e2_label_encode", "e3_target_encode",
         "c4_scale_quantile", "l2_correlation_filter", "l4_chi2_topk", "l5_l6_mutual_info", "t4_time_split",
         "v11_cumulative_gains", "v16_per_class_report", "d3_prediction_drift_psi", "w4_basic_preprocess",
         "w1_explore_overview", "doc_n2_quality_rate_by_language", "e2_label_encode_wide",
         "e3_target_encode_wide", "d2_performance_by_month"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 5)
    return v


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF_SMOKE)
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events", "labels", "documents"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMOKE, t + '.parquet')}')")
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    s_rows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    idx = [rel.columns.index(c) for c in cols]
    d_rows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
