"""Catalogued queries on a second dataset: document quality labels.

The same operators run on ``labels`` JOIN ``documents`` with different column
roles (id = doc_id, target = quality with positive class 1, size = n_chars):
the operators hard-code no column names.  The document text is never read
(column pruning keeps it out of the scan)."""

from __future__ import annotations

from pyspark.sql import functions as F

from featureforge.operators import insight as N
from featureforge.operators import profile as P
from featureforge.operators import split as T
from featureforge.plans.registry import register
from featureforge.roles import Roles
from featureforge.sources.tables import table

DOC_ROLES = Roles(id="doc_id", target="quality", positive=1, monthly="n_chars", tenure="n_chars")

_DQ = ("dq AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
       "FROM labels l JOIN documents d USING (doc_id))")


def doc_quality(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return labels.join(docs, "doc_id")


@register("doc_n2_quality_rate_by_language", sql=f"""
WITH {_DQ},
g AS (SELECT 'lang' AS feature, lang AS category, CAST(count(*) AS BIGINT) AS n_rows,
             CAST(sum(CAST(quality = 1 AS INTEGER)) AS BIGINT) AS npos FROM dq WHERE lang IS NOT NULL GROUP BY lang),
g2 AS (SELECT 'source' AS feature, source AS category, CAST(count(*) AS BIGINT) AS n_rows,
              CAST(sum(CAST(quality = 1 AS INTEGER)) AS BIGINT) AS npos FROM dq WHERE source IS NOT NULL GROUP BY source),
allg AS (SELECT * FROM g UNION ALL SELECT * FROM g2),
card AS (SELECT feature, count(*) AS k FROM allg GROUP BY feature)
SELECT a.feature, a.category, a.n_rows, round(CAST(a.npos AS DOUBLE) * 100 / a.n_rows, 6) AS churn_rate
FROM allg a JOIN card USING (feature) WHERE card.k <= 8
""")
def q_doc_rate(spark, sf):
    """N2 with document roles: % good-quality documents per low-cardinality
    category (language passes the <= 8 guard, the 20 sources do not)."""
    return N.churn_rate_by_category(doc_quality(spark, sf), DOC_ROLES, max_card=8)


@register("doc_q12_quality_balance", sql=f"""
WITH {_DQ}
SELECT count(*) AS total_samples, CAST(count(*) FILTER (WHERE quality IS NULL) AS BIGINT) AS missing_count,
       round(count(*) FILTER (WHERE quality IS NULL) * 100.0e0 / count(*), 6) AS missing_pct,
       k AS n_classes, mn AS minority_class_count, mx AS majority_class_count,
       round(CAST(mx AS DOUBLE) / mn, 6) AS imbalance_ratio, CAST(mx AS DOUBLE) / mn > 1.5 AS is_imbalanced
FROM dq CROSS JOIN (SELECT count(*) AS k, min(c) AS mn, max(c) AS mx
                    FROM (SELECT count(*) AS c FROM dq WHERE quality IS NOT NULL GROUP BY quality))
GROUP BY k, mn, mx
""")
def q_doc_balance(spark, sf):
    """Q12 on document quality (85 % positive: imbalanced)."""
    return P.class_balance(doc_quality(spark, sf), DOC_ROLES)


@register("doc_t1_stratified_split", sql=f"""
WITH {_DQ}
SELECT doc_id, CASE WHEN r <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) AS r,
             count(*) OVER (PARTITION BY quality) AS n FROM dq)
""")
def q_doc_split(spark, sf):
    """T1 on documents, stratified by quality."""
    return T.train_test_split(doc_quality(spark, sf).select("doc_id", "quality"), "doc_id", "quality",
                              0.2, 42).select("doc_id", "split")


@register("doc_q15_length_outliers", sql="""
WITH dq AS (SELECT l.doc_id, d.n_chars FROM labels l JOIN documents d USING (doc_id))
""" + __import__("featureforge.plans.catalog.profile", fromlist=["_outlier_sql"])._outlier_sql(
    "dq", ["n_chars"], ""))
def q_doc_outliers(spark, sf):
    """Q15 on document length (heavy right tail)."""
    return P.outlier_report(doc_quality(spark, sf), DOC_ROLES, cols=["n_chars"])
