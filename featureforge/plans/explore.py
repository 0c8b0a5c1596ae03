"""The exploration phase as a dict of report DataFrames.

Most reports are lazy (one aggregate-based job each when written or
collected); the correlation matrix and the outlier report run their small
statistics jobs while the dict is built (their results are tiny tables).
The source should be persisted by the caller when several reports are
materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from featureforge.functions.exprs import numeric_cols
from featureforge.operators import insight as N
from featureforge.operators import profile as P
from featureforge.roles import Roles


def explore(df: DataFrame, roles: Roles, bins: int = 5, after: DataFrame | None = None) -> dict[str, DataFrame]:
    """``after``: a transformed frame whose dtypes are compared with ``df``'s."""
    num = numeric_cols(df, [roles.id])
    corr = P.correlation_matrix(df, num)
    reports = {
        "schema": P.schema_profile(df),
        "missing_values": P.missing_profile(df),
        "missing_summary": P.missing_summary(df),
        "duplicates": P.duplicate_profile(df),
        "unique_values": P.unique_profile(df),
        "potential_issues": P.issue_list(df),
        "completeness": P.completeness(df),
        "categorical_analysis": P.categorical_profile(df),
        "outliers": P.outlier_report(df, roles),
        "correlation_matrix": corr,
        "correlation_summary": P.correlation_summary(corr),
        "high_correlations": P.high_correlations(corr),
        "recommendations": P.recommendations(df, roles, num, corr=corr),
    }
    if after is not None:
        reports["dtype_distribution"] = P.dtype_distribution(df, after)
    for c in num:
        reports[f"histogram_{c}"] = P.histogram(df, c)
    if roles.target in df.columns:
        reports.update({
            "target_distribution": P.target_distribution(df, roles),
            "class_balance": P.class_balance(df, roles),
            "churn_by_segment": N.churn_by_segment(df, roles),
            "churn_rate_by_category": N.churn_rate_by_category(df, roles),
        })
        if roles.monthly in df.columns:
            reports["avg_charge_by_target"] = N.avg_charge_by_target(df, roles)
            reports["revenue_at_risk"] = N.revenue_at_risk(df, roles)
            reports["charges_by_target"] = P.box_stats(df, roles.monthly, roles.target)
        if roles.tenure in df.columns:
            reports["churn_by_tenure_bins"] = N.churn_by_equal_width_bins(df, roles, roles.tenure, bins)
    return reports
