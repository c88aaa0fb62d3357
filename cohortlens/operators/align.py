"""Joins and set operations J1-J4, U1-U2 (all equi-joins on a key).

Catalyst/AQE choose broadcast vs sort-merge from measured sizes; explicit
broadcast is used only for literal domains, whose size is fixed by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, key: str = "row_id") -> DataFrame:
    """Re-attach columns by key (one inner equi-join)."""
    return left.join(right, key, "inner")


def assemble(left: DataFrame, right: DataFrame, key: str, fill=0) -> DataFrame:
    """Two per-key frames -> one, outer aligned, missing filled."""
    out = left.join(right, key, "full_outer")
    value_cols = [c for c in out.columns if c != key]
    return out.fillna(fill, subset=value_cols)


def reindex_domain(df: DataFrame, key: str, domain: list, fill: dict | None = None) -> DataFrame:
    """Rows for every domain value in domain order (``position``), absent -> fill.

    ``domain`` is a literal list, so broadcasting it is bounded by construction.
    """
    spark = df.sparkSession
    dom = spark.createDataFrame([(i, v) for i, v in enumerate(domain)],
                                f"position int, {key} {df.schema[key].dataType.simpleString()}")
    out = F.broadcast(dom).join(df, key, "left")
    return out.fillna(fill) if fill else out


def alignment_check(a: DataFrame, b: DataFrame, key: str = "row_id") -> DataFrame:
    """Order-free key-set equality: counts of one-sided and shared keys."""
    ka = a.select(F.col(key), F.lit(1).alias("_a"))
    kb = b.select(F.col(key), F.lit(1).alias("_b"))
    j = ka.join(kb, key, "full_outer")
    return j.agg(
        F.count_if(F.col("_b").isNull()).alias("only_left"),
        F.count_if(F.col("_a").isNull()).alias("only_right"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"),
    ).withColumn("aligned", ((F.col("only_left") == 0) & (F.col("only_right") == 0)).cast("int"))


def stack_groups(frames: dict[str, DataFrame], label: str = "group") -> DataFrame:
    """Stack per-group frames with a group label column."""
    return reduce(lambda x, y: x.unionByName(y),
                  [f.withColumn(label, F.lit(g)) for g, f in frames.items()])


def missing_keys(a: DataFrame, b: DataFrame, key: str = "row_id") -> DataFrame:
    """Keys of ``a`` absent from ``b``."""
    return a.select(key).join(b.select(key), key, "left_anti")


def column_diff(have: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """U2 on schemas: (missing, extra) column names, order kept."""
    hs, es = set(have), set(expected)
    return [c for c in expected if c not in hs], [c for c in have if c not in es]
