"""Profiling aggregates A1-A15, all as long-form DataFrames.

Plan shape: per-column statistics come from ONE wide aggregate (no row
expansion, map-side partial aggregation) reshaped with ``inline``; level
statistics unpivot strings and aggregate ``(column, level)`` pairs, so the
shuffle carries at most one row per level per partition. Windows only run
over these small aggregated tables, always partitioned by column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.exprs import is_missing, numeric_columns, safe_corr, string_columns
from cohortlens.functions.quantile import exact_quantiles, group_key, quartiles_by


MAX_AGG_EXPRESSIONS = 500   # per aggregate: keeps generated code under the JVM method limits


def _inline(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


def _chunks(items: list, per_item: int = 1) -> list[list]:
    """Split items so each aggregate carries at most MAX_AGG_EXPRESSIONS expressions."""
    size = max(1, MAX_AGG_EXPRESSIONS // per_item)
    return [items[i:i + size] for i in range(0, len(items), size)] or [[]]


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def unpivot_values(df: DataFrame, columns: list[str], value_type: str = "double",
                   extra: list[str] | None = None) -> DataFrame:
    """(extra..., column, value) rows; one generator, no shuffle."""
    extra = extra or []
    return df.select(*extra, _inline([
        F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value"))
        for c in columns]))


# ------------------------------------------------------------------ A1 / A2 / A3
def overview(df: DataFrame) -> DataFrame:
    """A1: per column position, type and non-null count, plus the row count."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    return agg.select(F.col("__n").alias("n_rows"), _inline([
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 F.lit(t.simpleString()).alias("dtype"), F.col(c).alias("non_null"))
        for i, (c, t) in enumerate((f.name, f.dataType) for f in df.schema.fields)]))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric half of A2: one wide aggregate per chunk of columns; quartiles exact (linear)."""
    return _union_all([_describe_numeric_chunk(df, chunk) for chunk in _chunks(columns, 5)])


def _describe_numeric_chunk(df: DataFrame, columns: list[str]) -> DataFrame:
    quarts = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    return wide.select(_inline([
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                 F.col(f"lo{i}").alias("min"),
                 *(F.lit(q).cast("double").alias(p) for q, p in zip(quarts[c], ("p25", "p50", "p75"))),
                 F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(columns)]))


def level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, level, n) for string columns; nulls excluded."""
    long = unpivot_values(df, columns, "string").where(F.col("value").isNotNull())
    return long.groupBy("column", F.col("value").alias("level")).agg(F.count("*").alias("n"))


def describe_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """String half of A2: count, unique, top (ties -> smallest), freq."""
    lc = level_counts(df, columns)
    return lc.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("level", F.struct((-F.col("n")).alias("k"), F.col("level").alias("v")))
        .alias("top"),
        F.max("n").alias("freq"),
    )


def describe_all(df: DataFrame, exclude=("row_id",)) -> DataFrame:
    """A2: count, unique, top, freq, mean, std, min, quartiles, max per column."""
    num = numeric_columns(df, exclude=exclude)
    strs = string_columns(df, exclude=exclude)
    parts = []
    if num:
        parts.append(describe_numeric(df, num).select(
            "column", "count", F.lit(None).cast("bigint").alias("unique"),
            F.lit(None).cast("string").alias("top"), F.lit(None).cast("bigint").alias("freq"),
            "mean", "std", "min", "p25", "p50", "p75", "max"))
    if strs:
        d = F.lit(None).cast("double")
        parts.append(describe_strings(df, strs).select(
            "column", "count", "unique", "top", "freq", d.alias("mean"), d.alias("std"),
            d.alias("min"), d.alias("p25"), d.alias("p50"), d.alias("p75"), d.alias("max")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_profile(df: DataFrame, exclude=()) -> DataFrame:
    """A3: columns with missing values: count and percentage, largest first."""
    cols = [c for c in df.columns if c not in exclude]
    parts = []
    for chunk in _chunks(cols):
        agg = df.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(is_missing(df, c)).alias(c) for c in chunk])
        parts.append(agg.select(F.col("__n").alias("n_rows"), _inline([
            F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in chunk])))
    long = _union_all(parts)
    return (long.where(F.col("n_missing") > 0)
            .select("column", "n_missing",
                    (F.col("n_missing") / F.col("n_rows") * 100).alias("pct_missing"))
            .orderBy(F.desc("pct_missing"), "column"))


# ------------------------------------------------------------------ A4 / A5 / A6 / A7
def sentinel_prevalence(df: DataFrame, column: str, value: str) -> DataFrame:
    """A4: rows equal to the sentinel level, count and percent."""
    return df.agg(F.count_if(F.col(column) == value).alias("n_sentinel"),
                  F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(column).alias("column"), "n_sentinel", "n_rows",
        (F.try_divide(F.col("n_sentinel"), F.col("n_rows")) * 100).alias("pct_sentinel"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """A5: count and percent per raw label."""
    counts = df.groupBy(F.col(target).alias("label")).agg(F.count("*").alias("n"))
    total = Window.partitionBy(F.lit(0))  # over <= #labels aggregated rows
    return counts.select("label", "n", (F.col("n") / F.sum("n").over(total) * 100).alias("pct"))


def bracket_frequency(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts in domain order, absent brackets -> 0."""
    from cohortlens.operators.align import reindex_domain
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return reindex_domain(counts, column, domain, fill={"n": 0}).select(
        "position", F.col(column).alias("level"), "n")


def target_rate_by_group(df: DataFrame, target: Column, columns: list[str]) -> DataFrame:
    """Per (column, level): n and rate of the 0/1 target, plus the overall rate."""
    long = df.select(target.cast("double").alias("__y"), _inline([
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
        for c in columns]))
    g = long.groupBy("column", "level").agg(F.count("*").alias("n"), F.sum("__y").alias("pos"))
    overall = long.groupBy("column").agg((F.sum("__y") / F.count("*")).alias("overall_rate"))
    # null levels count toward the overall rate but get no row of their own
    return (g.where(F.col("level").isNotNull()).join(F.broadcast(overall), "column")      # a row per column
            .select("column", "level", "n", (F.col("pos") / F.col("n")).alias("rate"), "overall_rate"))


# ------------------------------------------------------------------ A8 / A9 histogram + density
def _ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.min(F.col(c).cast("double")).alias(f"a{i}"),
                 F.max(F.col(c).cast("double")).alias(f"b{i}")]
    return df.agg(*aggs).select(_inline([
        F.struct(F.lit(c).alias("column"), F.col(f"a{i}").alias("mn"), F.col(f"b{i}").alias("mx"))
        for i, c in enumerate(columns)]))


def histogram(df: DataFrame, columns: list[str], bins: int = 30) -> DataFrame:
    """Equal-width bins per column, last edge closed, empty bins kept.

    A constant column gets the range (v-0.5, v+0.5), as numpy does.
    """
    rng = _ranges(df, columns).select(
        "column",
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo0"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi0"))
    vals = unpivot_values(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    # one row per column: bounded by the column list, so broadcasting it is safe
    binned = vals.join(F.broadcast(rng), "column").select(
        "column", F.least(F.floor((F.col("value") - F.col("lo0")) * bins
                                  / (F.col("hi0") - F.col("lo0"))),
                          F.lit(bins - 1)).cast("int").alias("bin"))
    counts = binned.groupBy("column", "bin").agg(F.count("*").alias("n"))
    step = (F.col("hi0") - F.col("lo0")) / bins
    dom = rng.select("column", "lo0", "hi0", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
                     .alias("bin"))
    dom = dom.select("column", "bin", (F.col("lo0") + F.col("bin") * step).alias("lo"),
                     F.when(F.col("bin") == bins - 1, F.col("hi0"))
                     .otherwise(F.col("lo0") + (F.col("bin") + 1) * step).alias("hi"))
    return dom.join(counts, ["column", "bin"], "left").fillna(0, subset=["n"])


def density(df: DataFrame, columns: list[str], grid: int = 200) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, sample std) on ``grid`` points over [min, max].

    Works from pre-aggregated (column, value, count) rows, so the kernel sum
    costs distinct-values x grid, with one partial
    sum per grid point and task; the definition is the same at every size.
    """
    vals = unpivot_values(df, columns).where(F.col("value").isNotNull() & ~F.isnan("value"))
    vc = vals.groupBy("column", "value").agg(F.count("*").alias("c"))
    st = vc.groupBy("column").agg(
        F.sum("c").alias("n"),
        (F.sum(F.col("c") * F.col("value")) / F.sum("c")).alias("mu"),
        F.min("value").alias("mn"), F.max("value").alias("mx"))
    var = vc.join(F.broadcast(st), "column").groupBy("column").agg(
        (F.sum(F.col("c") * F.pow(F.col("value") - F.col("mu"), 2))
         / (F.first("n") - 1)).alias("var"))
    params = st.join(var, "column").where((F.col("var") > 0) & (F.col("n") > 1)).select(
        "column", "n", "mn", "mx",
        (F.sqrt("var") * F.pow(F.col("n").cast("double"), -0.2)).alias("h"))
    g = vc.join(F.broadcast(params), "column").select(
        "column", "value", "c", "n", "mn", "mx", "h",
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("j"))
    x = F.col("mn") + F.col("j") * (F.col("mx") - F.col("mn")) / (grid - 1)
    contrib = F.col("c") * F.exp(-0.5 * F.pow((x - F.col("value")) / F.col("h"), 2))
    return g.groupBy("column", "j").agg(
        F.first(x).alias("x"),
        (F.sum(contrib) / (F.first("n") * F.first("h") * math.sqrt(2 * math.pi))).alias("density"))


# ------------------------------------------------------------------ A10 / A11 / A12
def top_levels(df: DataFrame, columns: list[str], k: int = 15) -> DataFrame:
    """A10: k most frequent levels per column (ties -> smaller level)."""
    lc = level_counts(df, columns)
    w = Window.partitionBy("column").orderBy(F.desc("n"), "level")
    return lc.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_levels_with_sentinel(df: DataFrame, column: str, sentinel: str, k: int = 12) -> DataFrame:
    """Top-k known levels by count plus the sentinel bar (distributed top-k)."""
    lc = df.groupBy(F.col(column).alias("level")).agg(F.count("*").alias("n"))
    top = (lc.where((F.col("level") != sentinel) & F.col("level").isNotNull())
           .orderBy(F.desc("n"), "level").limit(k))
    known = top.withColumn("rank", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "level")))   # over k rows
    known = known.withColumn("is_sentinel", F.lit(0))
    sent = lc.where(F.col("level") == sentinel).select(
        "level", "n", F.lit(0).alias("rank"), F.lit(1).alias("is_sentinel"))
    return known.unionByName(sent)


def discrete_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Value counts per column with the share of zeros."""
    vals = unpivot_values(df, columns, "bigint").where(F.col("value").isNotNull())
    vc = vals.groupBy("column", "value").agg(F.count("*").alias("n"))
    zero = vals.groupBy("column").agg((F.count_if(F.col("value") == 0) / F.count("*") * 100).alias("pct_zero"))
    return vc.join(F.broadcast(zero), "column").select("column", "value", "n", "pct_zero")      # a row per column


# ------------------------------------------------------------------ A13 box statistics
def box_stats(df: DataFrame, target: Column, columns: list[str]) -> DataFrame:
    """Quartiles, 1.5*IQR fences and whisker ends per (feature, target)."""
    long = (unpivot_values(df, columns, extra=[target.alias("target")])
            .where(F.col("value").isNotNull()))
    groups = ["column", "target"]
    q = long.groupBy(*groups).agg(F.count("*").alias("n")).withColumn("__key", group_key(groups))
    q = q.join(quartiles_by(long, groups, "value"), "__key", "left").select("column", "target", "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    fences = q.select("column", "target",
                      (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("f_lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("f_hi"))
    # fences: one row per (feature, class): bounded, broadcast
    w = long.join(F.broadcast(fences), ["column", "target"]).groupBy("column", "target").agg(
        F.min(F.when(F.col("value") >= F.col("f_lo"), F.col("value"))).alias("whisker_lo"),
        F.max(F.when(F.col("value") <= F.col("f_hi"), F.col("value"))).alias("whisker_hi"))
    return q.join(w, ["column", "target"]).withColumn("iqr", F.col("q3") - F.col("q1"))


# ------------------------------------------------------------------ A14 / A15 correlation
def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r for every pair below the diagonal (pairwise complete rows).

    Pairs grow quadratically, so they are spread over aggregates of at most
    MAX_AGG_EXPRESSIONS each (one pass per chunk; a handful of columns is one pass).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    parts = []
    for chunk in _chunks(pairs):
        wide = df.agg(*[safe_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{k}")
                        for k, (a, b) in enumerate(chunk)])
        parts.append(wide.select(_inline([
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{k}").alias("r"))
            for k, (a, b) in enumerate(chunk)])))
    return _union_all(parts)


def target_correlations(df: DataFrame, target: str, columns: list[str], k: int = 10) -> DataFrame:
    """R of each column with the target, ranked by |r| (top k)."""
    cols = [c for c in columns if c != target]
    wide = df.agg(*[safe_corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"r{i}")
                    for i, c in enumerate(cols)])
    long = wide.select(_inline([F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r"))
                                for i, c in enumerate(cols)]))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("r")), "feature")
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
