"""Feature operators F1-F5, emitted as one projection (no withColumn chains).

F1 ordinal map (unmapped or null -> the job fails, by a filter that no later
projection prunes, so no extra validation pass), F2 positive-count flags, F3
row-wise utilisation sum, F4 sentinel flag, F5 configured interactions.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.exprs import INTEGRAL_TYPES, NUMERIC_TYPES, row_sum
from cohortlens.operators.clean import require, shown
from cohortlens.spec import Spec


def ordinal_expr(spec: Spec) -> Column:
    """bracket -> int via a literal map, null where none is configured."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v))
                                          for k, v in spec.ordinal_map))
    return m[F.col(spec.ordinal_column)].cast("int")


def _product(df: DataFrame, a: str, b: str) -> Column:
    ta, tb = df.schema[a].dataType, df.schema[b].dataType
    if isinstance(ta, INTEGRAL_TYPES) and isinstance(tb, INTEGRAL_TYPES):
        return F.col(a).cast("bigint") * F.col(b).cast("bigint")
    return F.col(a).cast("double") * F.col(b).cast("double")


def feature_columns_plan(df: DataFrame, spec: Spec) -> list[Column]:
    cols = set(df.columns)
    out: list[Column] = []
    drop = set()
    if spec.ordinal_column in cols and spec.ordinal_map:
        out.append(ordinal_expr(spec).alias(spec.ordinal_output))
        drop.add(spec.ordinal_column)
    for c in spec.prior_utilization_cols:                                  # F2
        if c in cols:
            out.append(F.coalesce(F.col(c) > 0, F.lit(False)).cast("int").alias(f"any_{c}"))
    avail = [c for c in spec.utilization_sum_cols if c in cols]           # F3
    if avail:
        out.append(row_sum(avail).alias(spec.utilization_total))
    if spec.sentinel_column in cols:                                      # F4
        out.append((~F.col(spec.sentinel_column).eqNullSafe(spec.sentinel_value))
                   .cast("int").alias(spec.sentinel_flag))
    if spec.interactions_enabled:                                         # F5
        for pair in spec.interaction_terms:
            if len(pair) != 2:
                continue
            a, b = pair
            if a not in cols or b not in cols:
                continue
            if not (isinstance(df.schema[a].dataType, NUMERIC_TYPES)
                    and isinstance(df.schema[b].dataType, NUMERIC_TYPES)):
                continue
            out.append(_product(df, a, b).alias(f"{a}_x_{b}"))
    keep = [F.col(c) for c in df.columns if c not in drop]
    return keep + out


def create_features(df: DataFrame, spec: Spec, strict: bool = True) -> DataFrame:
    """F1-F5 in one ``select``; the bracket column is replaced by its ordinal.

    With ``strict`` a bracket without an ordinal fails every job over the result.
    """
    if strict and spec.ordinal_column in df.columns and spec.ordinal_map:
        bracket = F.col(spec.ordinal_column)
        df = require(df, bracket.isin(*[k for k, _ in spec.ordinal_map]),
                     F.concat(F.lit(f"{spec.ordinal_column} has no ordinal for: "), shown(bracket)))
    return df.select(feature_columns_plan(df, spec))
