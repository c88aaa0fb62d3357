"""Encoding operators E1-E5: fitted levels, drop-first one-hot, alignment.

A column with more than ``max_levels`` levels keeps its levels in a table that is
never gathered: they are numbered where they lie, and a row gets one sparse
vector instead of thousands of dummies.

Levels are *fitted* once (E1) and every batch is encoded from them, so the
content of a scoring batch cannot change which level is the reference (the
per-batch re-derivation trap). Unseen values encode as all-zero, i.e. as the
reference level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortlens.functions.exprs import string_columns

LEVELS_SCHEMA = "column string, level string"


def encode_order(df: DataFrame, configured: tuple[str, ...] | list[str], target: str) -> list[str]:
    """Configured categoricals first (config order), then leftover strings (frame order)."""
    first = [c for c in configured if c in df.columns]
    rest = [c for c in string_columns(df, exclude=(target,)) if c not in first]
    return first + rest


def level_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """E1 as a DataFrame: distinct (column, level) pairs over all columns in one pass."""
    if not columns:
        return df.sparkSession.createDataFrame([], LEVELS_SCHEMA)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
        for c in columns])).alias("p")).select("p.column", "p.level")
    return long.where(F.col("level").isNotNull()).distinct()


def level_positions(table: DataFrame) -> DataFrame:
    """The (column, level) pairs of ``table`` with ``position``, from 1 in level order.

    Running counts over range partitions: no task sorts a column's levels.
    """
    from cohortlens.functions.ranges import running_totals
    out = running_totals(table, ["column"], [F.col("level").asc()], {"position": F.lit(1)})
    return out.withColumn("position", F.col("position").cast("int"))


@dataclass
class SparseLevels:
    """Levels of the columns that are too many for dummies: a written table (column, level, position)."""
    table: DataFrame
    sizes: dict[str, int]

    def feature_names(self) -> list[str]:
        return [f"{c}__onehot" for c in self.sizes]

    def place(self, df: DataFrame, column: str) -> DataFrame:
        """``df`` with ``__at``: the dummy that is 1, from 0; null for null, unseen and the first level."""
        own = self.table.where(F.col("column") == column).select(F.col("level").alias("__level"), (F.col("position") - 2).alias("__at"))
        src = F.col(column).cast("string") if column in df.columns else F.lit(None).cast("string")
        # a hot level makes a skewed side of a shuffle join, which adaptive execution splits
        return df.join(own.where("__at >= 0"), src == F.col("__level"), "left").drop("__level")

    def transform(self, df: DataFrame) -> DataFrame:
        """One sparse vector column ``{column}__onehot`` of the levels but the first, in place of each column."""
        from cohortlens.session import materialize
        for c, n in self.sizes.items():
            df = self.place(df, c).withColumn(f"{c}__onehot", _one_hot(F.col("__at"), n - 1)).drop("__at", c)
        made = set(self.feature_names())
        schema = StructType([StructField(f.name, VectorUDT() if f.name in made else f.dataType, True) for f in df.schema.fields])
        return materialize(df, "table", schema)

    def long_form(self, df: DataFrame, key: str = "row_id") -> DataFrame:
        """E2 in long form: (key, column, position) of every dummy that is 1."""
        parts = [self.place(df.select(key, c), c).where("__at is not null").select(key, F.lit(c).alias("column"), (F.col("__at") + 1).alias("position"))
                 for c in self.sizes]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _one_hot(at: Column, size: int) -> Column:
    """A vector's storage form (sparse) with a 1 at ``at``, or without any entry."""
    none = at.isNull()
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
        F.when(none, F.array().cast("array<int>")).otherwise(F.array(at.cast("int"))).alias("indices"),
        F.when(none, F.array().cast("array<double>")).otherwise(F.array(F.lit(1.0))).alias("values"))


@dataclass
class Levels:
    """Fitted sorted levels per column, in encoding order; ``sparse`` holds the columns with too many."""
    columns: list[str]
    levels: dict[str, list[str]]
    sparse: SparseLevels | None = None

    def feature_names(self) -> list[str]:
        dense = [f"{c}_{v}" for c in self.columns for v in self.levels[c][1:]]
        return dense + (self.sparse.feature_names() if self.sparse else [])

    def as_dataframe(self, spark) -> DataFrame:
        rows = [(c, v) for c in self.columns for v in self.levels[c]]
        dense = spark.createDataFrame(rows, LEVELS_SCHEMA)
        return dense.unionByName(self.sparse.table.select("column", "level")) if self.sparse else dense

    def transform(self, df: DataFrame) -> DataFrame:
        """One ``select``: non-categoricals in order, then tinyint dummies, then vectors of many levels.

        A null or unseen value gives all zeros in its group.
        """
        if self.sparse:
            df = self.sparse.transform(df)
        vectors = self.sparse.feature_names() if self.sparse else []
        enc = {*self.columns, *vectors}
        keep = [F.col(c) for c in df.columns if c not in enc]
        dummies = []
        for c in self.columns:
            src = F.col(c) if c in df.columns else F.lit(None).cast("string")
            for v in self.levels[c][1:]:
                dummies.append(F.coalesce(src == F.lit(v), F.lit(False))
                               .cast("tinyint").alias(f"{c}_{v}"))
        return df.select(keep + dummies + [F.col(c) for c in vectors])


def fit_levels(df: DataFrame, configured, target: str, max_levels: int = 1000) -> Levels:
    """Sorted distinct levels per categorical.

    Lists of at most ``max_levels`` levels come to the driver; a column with more
    is numbered in a written table and encoded as a sparse vector.
    """
    from cohortlens.session import materialize
    cols = encode_order(df, configured, target)
    if not cols:
        return Levels([], {})
    table = materialize(level_table(df, cols), "table")
    sizes = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    many = {c: sizes[c] for c in cols if sizes.get(c, 0) > max_levels}
    few = [c for c in cols if c not in many]
    lists = table.where(F.col("column").isin(few)).groupBy("column").agg(F.sort_array(F.collect_list("level")).alias("levels"))
    got = {r["column"]: list(r["levels"]) for r in lists.collect()} if few else {}
    sparse = None
    if many:
        placed = level_positions(table.where(F.col("column").isin(list(many))))
        sparse = SparseLevels(materialize(placed, "table"), many)
    return Levels(few, {c: got.get(c, []) for c in few}, sparse)


def encode_features(df: DataFrame, levels: Levels, target: str,
                    expected: list[str] | None = None) -> DataFrame:
    """E2 + E3 + E4: encode from fitted levels, check no strings remain, align."""
    out = levels.transform(df)
    left = string_columns(out, exclude=(target,))
    if left:                                                       # E3
        raise ValueError(f"text columns without an encoding: {left}")
    if expected is not None:
        out = align_columns(out, expected, target)
    return out


def align_columns(df: DataFrame, expected: list[str], target: str | None = None,
                  key: str | None = "row_id") -> DataFrame:
    """Reindex to ``expected``: missing -> 0 (tinyint), extras dropped, key/target kept."""
    have = set(df.columns)
    sel = [F.col(key)] if key and key in have else []
    sel += [F.col(c) if c in have else F.lit(0).cast("tinyint").alias(c) for c in expected]
    if target and target in have:
        sel.append(F.col(target))
    return df.select(sel)


def unseen_levels(df: DataFrame, levels_df: DataFrame, columns: list[str], small: bool = True) -> DataFrame:
    """E5: (column, level) pairs observed in ``df`` but absent from the fitted table.

    Long form, so a batch full of new values never gathers into one task; the
    fitted table is broadcast where ``max_levels`` bounds it (``small``).
    Sort by (column, level) for the report order.
    """
    observed = level_table(df, [c for c in columns if c in df.columns])
    fitted = F.broadcast(levels_df) if small else levels_df
    return observed.join(fitted, ["column", "level"], "left_anti")
