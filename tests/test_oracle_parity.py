"""Every query with an oracle matches DuckDB on the smoke tables (sf0.001)."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE

#: The optional training-data queries have their own tests.
SQL = {k: v for k, v in E.oracle_sql().items() if not k.startswith(("op", "pipeline"))}
QUERIES = {k: v for k, v in E.queries().items() if not k.startswith(("op", "pipeline"))}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    res = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["age_ordinal", "n", "target_rate"]
    assert len(rows) == 5


def test_every_query_has_a_name_from_the_inventory():
    import re
    for name in QUERIES:
        assert re.match(r"^[A-Z]+[0-9]", name), name


@pytest.mark.parametrize("name", ["K1_stratified_split", "V4_V5_roc_auc_average_precision",
                                  "X1_shapley_linear_margin"])
def test_results_do_not_depend_on_shuffle_partitions(spark, duck, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = QUERIES[name](spark, SMOKE)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    res = duck.sql(SQL[name])
    assert got == _rows(res.columns, res.fetchall())
