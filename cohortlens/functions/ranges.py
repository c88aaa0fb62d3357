"""Running totals over range partitions: no task holds a group, no table of offsets grows with groups x buckets.

Rows are range-partitioned on (groups, order) from a sample and written, so the
partition of a row is fixed. A partition's rows are summed in one task; what
lies before them in the same group is carried over by the totals of the earlier
partitions. Only groups that span partitions carry anything, so the table that is
broadcast has at most two rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.rank import join_null_safe
from cohortlens.session import materialize


def running_totals(df: DataFrame, groups: list[str], order: list[Column], values: dict[str, Column],
                   inclusive: bool = True) -> DataFrame:
    """``df`` with, per name of ``values``, the sum of that expression over the rows up to this one in its group.

    ``order`` holds sort expressions (``F.col("x").asc()``); rows that tie in it
    share a partition but are told apart arbitrarily, so it should be unique within a
    group. Without groups the whole frame is one. Nulls are a group of their own.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc() for g in groups]
    given = df.select("*", *[v.alias(f"__v_{k}") for k, v in values.items()])
    parts = materialize(given.repartitionByRange(n, *keys, *order).withColumn("__p", F.spark_partition_id()), "table")
    totals = parts.groupBy(*groups, "__p").agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in values])
    before = Window.partitionBy(*groups).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    spans = F.count(F.lit(1)).over(Window.partitionBy(*groups))
    carry = totals.select(*groups, "__p", spans.alias("__n"), *[F.sum(f"__t_{k}").over(before).alias(f"__c_{k}") for k in values])
    carry = carry.where("__n > 1").drop("__n")
    last = Window.currentRow if inclusive else -1
    inside = Window.partitionBy("__p", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    placed = parts.select(*df.columns, "__p", *[F.sum(f"__v_{k}").over(inside).alias(f"__i_{k}") for k in values])
    out = join_null_safe(placed, F.broadcast(carry), [*groups, "__p"], "left")
    zero = F.lit(0)
    return out.select(*df.columns, *[(F.coalesce(f"__i_{k}", zero) + F.coalesce(f"__c_{k}", zero)).alias(k) for k in values])
