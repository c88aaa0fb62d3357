"""Error analysis R1-R6: the four outcome groups as a column, profiled with
grouped aggregates (the analysis columns are re-attached by one key join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.quantile import group_key, quartiles_by
from cohortlens.operators.align import reindex_domain

GROUPS = ["TP", "TN", "FP", "FN"]


def error_group(score: Column, label: Column, threshold: float) -> Column:
    pred = score >= F.lit(float(threshold))
    y = label == 1
    return (F.when(pred & y, "TP").when(~pred & ~y, "TN").when(pred & ~y, "FP")
            .otherwise("FN"))


def with_groups(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn("group", error_group(F.col("score"), F.col("label"), threshold))


def group_sizes(grouped: DataFrame) -> DataFrame:
    """Size and share of each group; all four listed even when empty."""
    c = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    out = reindex_domain(c, "group", GROUPS, fill={"n": 0})
    everything = Window.partitionBy(F.lit(0))      # over the four group rows only
    return out.select("position", "group", "n",
                      F.try_divide(F.col("n"), F.sum("n").over(everything)).alias("share"))


def group_means(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """R2: n and mean of every numeric column per group (all four groups present)."""
    g = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n"),
                                     *[F.avg(F.col(c)).alias(f"mean_{c}") for c in columns])
    return reindex_domain(g, "group", GROUPS, fill={"n": 0})


def group_distributions(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """Per (group, feature): n, min, quartiles, max (violin + inner box data)."""
    long = grouped.select("group", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns])))
    keys = ["group", "feature"]
    q = long.groupBy(*keys).agg(F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"))
    q = q.withColumn("__key", group_key(keys)).join(quartiles_by(long, keys, "value"), "__key", "left")
    return q.select("group", "feature", "n", "min", F.col("q")[0].alias("q1"),
                    F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def scatter_grid(grouped: DataFrame, x: str, y: str) -> DataFrame:
    """Counts on the 2-D grid per group (skipped when a column is absent)."""
    if x not in grouped.columns or y not in grouped.columns:
        return grouped.sparkSession.createDataFrame([], "group string, x double, y double, n bigint")
    return grouped.groupBy("group", F.col(x).alias(x), F.col(y).alias(y)).agg(
        F.count(F.lit(1)).alias("n"))


def fp_fn_profile(grouped: DataFrame, columns: list[str]) -> DataFrame:
    """FP and FN means per feature, and their ratio to the overall mean (0 -> null)."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.avg(F.when(F.col("group") == "FP", x)).alias(f"fp{i}"),
                 F.avg(F.when(F.col("group") == "FN", x)).alias(f"fn{i}"),
                 F.avg(x).alias(f"all{i}")]
    wide = grouped.agg(*aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"fp{i}").alias("fp_mean"),
                 F.col(f"fn{i}").alias("fn_mean"), F.col(f"all{i}").alias("overall_mean"))
        for i, c in enumerate(columns)])))
    base = F.nullif(F.col("overall_mean"), F.lit(0.0))
    return long.select("feature", "fp_mean", "fn_mean", "overall_mean",
                       (F.col("fp_mean") / base).alias("fp_ratio"),
                       (F.col("fn_mean") / base).alias("fn_ratio"))


def category_share(grouped: DataFrame, column: str) -> DataFrame:
    """Share of each level within FP and within FN, outer aligned, 0 filled."""
    if column not in grouped.columns:
        raise ValueError(f"column '{column}' not found; pass the pre-encoding analysis frame")
    sub = grouped.where(F.col("group").isin("FP", "FN"))
    c = sub.groupBy(F.col(column).alias("level")).pivot("group", ["FP", "FN"]).agg(
        F.count(F.lit(1)))
    totals = sub.groupBy(F.lit(0).alias("__k")).agg(F.count_if(F.col("group") == "FP").alias("__fp"),
                                                    F.count_if(F.col("group") == "FN").alias("__fn"))
    c = c.withColumn("__k", F.lit(0)).join(F.broadcast(totals), "__k")       # one row
    fp, fn = F.coalesce("FP", F.lit(0)), F.coalesce("FN", F.lit(0))
    return c.select("level",
                    F.coalesce(F.try_divide(fp, F.col("__fp")), F.lit(0.0))
                    .alias("fp_share"),
                    F.coalesce(F.try_divide(fn, F.col("__fn")), F.lit(0.0))
                    .alias("fn_share"))
