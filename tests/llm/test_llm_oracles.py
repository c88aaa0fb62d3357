"""The registered training-data queries match DuckDB where SQL can express them (sf0.001)."""

import pytest

from cohortlens.llm.queries import QUERIES, SQL
from tests.conftest import SMOKE


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    res = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    at = [res.columns.index(c) for c in columns]
    assert got == sorted(tuple(r[i] for i in at) for r in res.fetchall())


def test_one_query_per_operator():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
