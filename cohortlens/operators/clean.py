"""Cleaning operators P1-P12.

``clean_data`` runs: target mapping -> column drop -> duplicate removal ->
schema validation -> median imputation -> mode imputation -> residual-null
gate. Rows made equal *by imputation* stay (dedupe runs before imputing).

Fit results that reach the driver are bounded: two rows of counts per
column, one median / mode per column with nulls, at most six sample labels.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.exprs import (NUMERIC_TYPES, is_missing, normalize_label,
                                        numeric_columns, string_columns)
from cohortlens.functions.quantile import exact_quantiles
from cohortlens.spec import Spec

ROW_ID = "row_id"


# ---------------------------------------------------------------- P1-P3 target
def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """``df``; the job fails with ``message`` at a row for which ``ok`` is false or null.

    The check is a filter that keeps every other row, not a projected column: a
    later ``select``, ``drop`` or ``count`` cannot prune it, and it costs no pass.
    """
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def shown(c: Column) -> Column:
    """A value in a message, nulls spelled out."""
    return F.coalesce(c.cast("string"), F.lit("NULL"))


@dataclass(frozen=True)
class TargetRule:
    """What a target column may hold: two labels of a text column, 0 and 1 of a numeric one."""
    column: str
    value: Column          # as compared with the allowed ones
    allowed: tuple
    numeric: bool

    @staticmethod
    def of(df: DataFrame, spec: Spec) -> "TargetRule":
        if isinstance(df.schema[spec.target].dataType, NUMERIC_TYPES):
            return TargetRule(spec.target, F.col(spec.target), (0, 1), True)
        labels = tuple((v or "").strip().lower() for v in (spec.negative_value, spec.positive_value))
        if "" in labels or labels[0] == labels[1]:
            raise ValueError(f"two different labels are needed to map '{spec.target}', got {labels}")
        return TargetRule(spec.target, normalize_label(F.col(spec.target)), labels, False)

    @property
    def ok(self) -> Column:
        return self.value.isin(*self.allowed)

    @property
    def mapped(self) -> Column:
        hit = self.value if self.numeric else (self.value == self.allowed[1]).cast("int")
        return hit.cast("tinyint")


@dataclass(frozen=True)
class TargetReport:
    """Counts of rows without a label and with one that no rule maps, and at most ``SAMPLES`` of the latter in order."""
    n_null: int
    n_unknown: int
    samples: tuple

    def raise_if_bad(self, column: str) -> None:
        if self.n_null or self.n_unknown:
            raise ValueError(f"target {column}: {self.n_null} null, {self.n_unknown} unmapped, such as {list(self.samples)}")


SAMPLES = 5


def check_target(df: DataFrame, spec: Spec) -> TargetReport:
    """Q2-style report on the raw target, in one aggregate; the samples are the smallest distinct unmapped values."""
    rule = TargetRule.of(df, spec)
    unknown = F.col(spec.target).isNotNull() & ~F.coalesce(rule.ok, F.lit(False))
    if rule.numeric:
        seen = F.coalesce(rule.value, F.lit(0))
    else:
        seen = F.col(spec.target).cast("string")
    got = df.groupBy(F.when(unknown, seen).alias("v")).agg(
        F.count_if(F.col(spec.target).isNull()).alias("n"), F.count_if(unknown).alias("u"))
    total = got.agg(F.sum("n").alias("n"), F.sum("u").alias("u")).first()
    some = [r["v"] for r in got.where("u > 0").orderBy("v").limit(SAMPLES).collect()] if total["u"] else []
    return TargetReport(total["n"] or 0, total["u"] or 0, tuple(some))


def map_target(df: DataFrame, spec: Spec, validate: bool = False) -> DataFrame:
    """Text labels -> tinyint 0/1; numeric 0/1 -> tinyint.

    A null or unmapped label fails every job over the result, whatever columns
    it reads. ``validate=True`` reports at once, with counts and samples.
    """
    if spec.target not in df.columns:
        return df
    if validate:
        check_target(df, spec).raise_if_bad(spec.target)
    rule = TargetRule.of(df, spec)
    good = require(df, rule.ok, F.concat(F.lit(f"target {spec.target} is null or unmapped: "), shown(F.col(spec.target))))
    return good.withColumn(spec.target, rule.mapped)


# ---------------------------------------------------------------- P4-P6 columns
def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Drop the listed columns that exist."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def select_features(df: DataFrame, target: str) -> DataFrame:
    """P5: analysis frame = everything but the target."""
    return df.drop(target)


def sanitize_column_names(df: DataFrame) -> DataFrame:
    """Spaces -> underscores; raises when two names collide."""
    new = [c.replace(" ", "_") for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after sanitising: {new}")
    return df.toDF(*new)


# ---------------------------------------------------------------- P9 dedupe
def drop_duplicates(df: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Full-row duplicates (ignoring the key), first (smallest key) kept.

    One aggregation keyed on all columns: partial aggregation collapses hot
    duplicate groups map-side before the shuffle. Nulls group together.
    """
    if key not in df.columns:
        return df.dropDuplicates()
    others = [c for c in df.columns if c != key]
    kept = df.groupBy(*others).agg(F.min(key).alias(key))
    return kept.select(*df.columns)


# ---------------------------------------------------------------- P10-P12 impute
@dataclass
class Imputer:
    """Fitted medians (numeric, as double) and modes (string) per column."""
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for f in df.schema.fields:
            c = F.col(f.name)
            if f.name in self.medians:
                miss = is_missing(df, f.name)
                out.append(F.when(miss, F.lit(self.medians[f.name]))
                           .otherwise(c.cast("double")).alias(f.name))
            elif f.name in self.modes:
                out.append(F.coalesce(c, F.lit(self.modes[f.name])).alias(f.name))
            else:
                out.append(c)
        return df.select(out)


def null_counts(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """One aggregate: missing count per column (NaN counts as missing)."""
    if not cols:
        return {}
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def fit_imputer(df: DataFrame, target: str | None, key: str = ROW_ID,
                counts: dict[str, int] | None = None) -> Imputer:
    """Exact medians of numeric and modes of string columns that have nulls.

    Medians come from bucket counts (``exact_quantiles``), so a continuous column
    is never gathered in one task. Mode ties resolve to the lowest value.
    """
    skip = {c for c in (target, key) if c}
    num = numeric_columns(df, exclude=tuple(skip))
    strs = string_columns(df, exclude=tuple(skip))
    counts = counts if counts is not None else null_counts(df, num + strs)
    num_fill = [c for c in num if counts.get(c, 0) > 0]
    str_fill = [c for c in strs if counts.get(c, 0) > 0]
    medians = {c: q[0] for c, q in exact_quantiles(df, num_fill, [0.5]).items()}
    modes = {}
    if str_fill:
        row = df.agg(*[F.mode(F.col(c), True).alias(c) for c in str_fill]).first()
        modes = {c: row[c] for c in str_fill}
    empty = [c for c, v in {**medians, **modes}.items() if v is None]
    if empty:
        # A column without any value has nothing to be filled from
        raise ValueError(f"columns without any value cannot be imputed: {empty}")
    return Imputer(medians, modes)


def residual_null_count(df: DataFrame) -> Column:
    """P12 as an aggregate expression: total missing cells in the frame."""
    parts = [F.count_if(is_missing(df, c)) for c in df.columns]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def require_complete(df: DataFrame, skip: tuple[str, ...] = (ROW_ID,)) -> DataFrame:
    """Every job over the result fails at a row in which a cell is missing; the message names the columns."""
    cols = [c for c in df.columns if c not in skip]
    if not cols:
        return df
    gaps = F.concat_ws(", ", *[F.when(is_missing(df, c), F.lit(c)) for c in cols])
    return require(df, gaps == "", F.concat(F.lit("missing values are left in "), gaps))


# ---------------------------------------------------------------- composition
@dataclass
class CleanFit:
    imputer: Imputer
    null_counts: dict[str, int]


def validate_schema(df: DataFrame, spec: Spec) -> None:
    """Q1 part: required columns and target present (schema only, no pass)."""
    have = set(df.columns)
    absent = sorted({*spec.required_columns, spec.target} - have)
    if absent:
        raise ValueError(f"columns {absent} are required, the frame has {sorted(have)}")


def clean_data(df: DataFrame, spec: Spec, require_target: bool = True,
               validate: bool = False, imputer: Imputer | None = None,
               materialize_mode: str | None = "table") -> tuple[DataFrame, CleanFit]:
    """Compose P1-P12. Pass a fitted ``imputer`` to clean a scoring batch.

    The deduplicated frame is the stage boundary: it is materialised once
    (``materialize_mode``) and the fit passes (null counts, medians/modes) and
    the returned frame all read it, instead of replaying scan + joins + dedupe.
    """
    from cohortlens.session import materialize
    if require_target or spec.target in df.columns:
        df = map_target(df, spec, validate=validate)
    df = drop_columns(df, spec.drop_columns)
    df = drop_duplicates(df)
    if require_target:
        validate_schema(df, spec)
    if imputer is None:
        df = materialize(df, materialize_mode)
        skip = (spec.target, ROW_ID)
        filled = numeric_columns(df, exclude=skip) + string_columns(df, exclude=skip)
        counts = null_counts(df, [c for c in df.columns if c not in skip])
        left = {c: n for c, n in counts.items() if n and c not in filled}
        if left:
            # No rule fills these, so the cleaned frame would keep their nulls
            raise ValueError(f"no imputation rule for the nulls of these columns: {left}")
        counts = {c: counts[c] for c in filled}
        imputer = fit_imputer(df, spec.target, counts=counts)
    else:
        counts = {}
    return require_complete(imputer.transform(df)), CleanFit(imputer, counts)

