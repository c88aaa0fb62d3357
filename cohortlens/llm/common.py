"""Shared steps of the training-data operators: tables, prefix positions, components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and reread."""
    return materialize(df, mode="table")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def numbered(df: DataFrame, group: list[str], order: list[str], name: str,
             weight: str | None = None, per_bucket: int = 50_000) -> DataFrame:
    """Running position inside each group: row number from 0, or the sum of ``weight`` before the row.

    A group is never sorted in one task. Rows fall into hash buckets of about
    ``per_bucket`` rows, (group, bucket) totals are prefix-summed (one row per
    bucket) and joined back, and only the rows of one bucket are sorted
    together. The order is by bucket, then by ``order``: fixed by the values,
    not by how rows were dealt to tasks. Groups match null-safely.
    """
    n = max(1, -(-df.count() // per_bucket))
    w = F.col(weight) if weight else F.lit(1).cast("long")
    rows = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(n)))
    keys = [F.coalesce(F.xxhash64(*group), F.lit(0)).alias("__g")] if group else [F.lit(0).alias("__g")]
    rows = rows.select("*", *keys)
    totals = rows.groupBy("__g", "__b").agg(F.sum(w).alias("__t"))
    before = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("__g", "__b", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__s"))
    inside = (Window.partitionBy("__g", "__b").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("__i", F.coalesce(F.sum(w).over(inside), F.lit(0)))
    return (placed.join(starts, ["__g", "__b"])
            .select(*df.columns, (F.col("__s") + F.col("__i")).cast("long").alias(name)))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v): rows (node, component), component the smallest node.

    Alternating large-star and small-star steps (Kiveris et al. 2014): each
    step is a min-aggregate and one join, and a node's neighbours are never
    gathered in one row. Every round is written to the shared folder. Nulls
    and self-links are dropped; an empty input gives no rows.
    """
    spark = edges.sparkSession
    e = stored(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
               .where(F.col("u") != F.col("v"))
               .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                                 F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
    seen = mark(e)
    for _ in range(max_rounds):
        sym = e.union(e.select("v", "u"))
        m = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (sym.join(m, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small)
        now = mark(e)
        if now == seen:
            roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
