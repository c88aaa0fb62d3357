"""Parquet table access for the driver tables (explicit paths, pushdown-friendly)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def assign_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """S2 for tables without a key: consecutive ids 0..n-1 in scan order.

    ``monotonically_increasing_id`` is (partition << 33) + index inside the
    partition; the frame is materialised first so partitions and ids are fixed
    (an executor loss re-reads the files, it cannot renumber), then each
    partition's offset comes from a prefix sum over the per-partition counts
    (one row per partition, broadcast). No Python round trip, no global sort.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortlens.session import materialize
    if name in df.columns:
        return df
    d = materialize(df.withColumn("__pid", F.spark_partition_id())
                    .withColumn("__mono", F.monotonically_increasing_id()))
    counts = d.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = d.join(F.broadcast(offsets), "__pid").withColumn(
        name, F.col("__off") + F.col("__mono") - F.shiftleft(F.col("__pid").cast("long"), 33))
    return out.select(name, *df.columns)
