"""Exact quantiles over several bucket levels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureforge.functions.rank import quantiles


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_many_quantiles_over_two_levels(spark):
    n = 20_000
    df = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e3).alias("x"),
                               F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 90 / 4.0).alias("y"),
                               F.when(F.col("id") < 5, F.col("id") * 1.0).alias("z"))
    qs = [i / 250 for i in range(251)]
    got = quantiles(df, {c: F.col(c) for c in "xyz"}, qs, buckets=16, finish_rows=200)
    for c in "xyz":
        v = np.array([r[0] for r in df.where(F.col(c).isNotNull()).select(c).collect()])
        assert got[c] == pytest.approx(list(np.quantile(v, qs)), rel=1e-12)
