"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def normalize_label(c: Column) -> Column:
    """null stays null, else strip all surrounding whitespace and lower-case.

    ``trim`` only strips spaces; tabs and newlines must go too.
    """
    return F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))


def is_missing(df: DataFrame, name: str) -> Column:
    """null, or NaN for float columns (NaN counts as missing, as in pandas)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FRACTIONAL_TYPES):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def safe_div(num: Column, den: Column) -> Column:
    """num/den as double, 0 when the denominator is 0 (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def row_sum(cols: list[str]) -> Column:
    """Row-wise sum skipping nulls (a missing count adds nothing)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation step for engine-to-engine comparison)."""
    return df.select([
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, FRACTIONAL_TYPES) else F.col(f.name)
        for f in df.schema.fields
    ])


def seeded_hash(key: Column, seed: int) -> Column:
    """Portable deterministic order key: md5 of ``key:seed`` (same in DuckDB)."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson r over pairwise-complete rows; null (not an ANSI division error)
    when either side has zero variance, as pandas gives NaN there."""
    both = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    x, y = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
