"""Queries that SQL can express, against their DuckDB SQL."""

import os

import duckdb
import pytest

from tests.llm.conftest import SF


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op6_minhash_neardup", "op9_quality_rules", "op10_decontaminate"])
def test_matches_oracle(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({E.oracle_sql()[name]})").fetchall()
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_operator_is_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(E.oracle_sql()) <= names
