"""Scalable prefix rank / prefix sum without a single-task window.

An unpartitioned (or two-class) window sends every row to one or two tasks.
Instead:

1. assign each row a *bucket* that is monotone in the sort order
   (leading hex digits of an md5 key, or the power of two of a score);
2. aggregate per (group, bucket) -- a table bounded by groups x buckets;
3. prefix-sum that small table with a window partitioned by group;
4. broadcast the per-bucket offsets (bounded, see 2) back to the rows;
5. finish with a window partitioned by (group, bucket).

Step 5 spreads the rows over ``groups x buckets`` tasks. Hash buckets are
uniform by construction; score buckets are applied to *distinct* scores, so a
hot score collapses to one row before ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_DIGITS = 4              # 65,536 hash buckets: ~1.5M rows per window group at 1e11 rows
OCTAVE_BUCKETS = 256        # score buckets per power of two of the score, or of 1 - score above 0.5
SMALLEST = 2.0 ** -60       # smaller distances to 0 or 1 share a bucket


def hash_bucket(h: Column, digits: int = HEX_DIGITS) -> Column:
    """Bucket of an md5 hex string: its first ``digits`` hex digits as an int.

    The offsets table is groups x 16**digits rows (broadcast), so ``digits``
    trades broadcast size against rows per window group.
    """
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def score_bucket_desc(score: Column, per_octave: int = OCTAVE_BUCKETS) -> Column:
    """Bucket ascending in *descending* score order, for scores in [0, 1].

    Buckets are logarithmic towards both ends, so scores of rare (or nearly
    certain) events spread over as many tasks as others do; there are at most
    ``120 * per_octave``. A null or NaN score fails the job.
    """
    s = F.least(F.greatest(score.cast("double"), F.lit(0.0)), F.lit(1.0))
    low = F.floor(F.log2(F.greatest(s, F.lit(SMALLEST))) * per_octave)
    high = -F.floor(F.log2(F.greatest(F.lit(1.0) - s, F.lit(SMALLEST))) * per_octave)
    bucket = (-F.when(s < 0.5, low).otherwise(high)).cast("int")
    return F.when(score.isNull() | F.isnan(score.cast("double")), F.raise_error(F.lit("a score is null or NaN"))).otherwise(bucket)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where nulls match nulls; the keys appear once."""
    renamed = right.select(*(F.col(k).alias(f"__r_{k}") if k in keys else F.col(k) for k in right.columns))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, cond, how).drop(*(f"__r_{k}" for k in keys))


def prefix_rank(df: DataFrame, groups: list[str], bucket: Column, order: list[Column],
                name: str = "rank") -> DataFrame:
    """1-based row number within ``groups`` in (bucket, order) order."""
    # the same filter on both branches keeps their subplans identical, so Spark can
    # reuse one shuffle for the bucket counts and the rows (ReusedExchange)
    d = df.withColumn("__b", bucket).where(F.col("__b").isNotNull())
    counts = d.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__c"))
    w = (Window.partitionBy(*groups).orderBy("__b")
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*groups, "__b",
                            F.coalesce(F.sum("__c").over(w), F.lit(0)).alias("__off"))
    d = join_null_safe(d, F.broadcast(offsets), [*groups, "__b"])
    w2 = Window.partitionBy(*groups, "__b").orderBy(*order)
    return d.withColumn(name, F.row_number().over(w2) + F.col("__off")).drop("__b", "__off")


def prefix_sums(df: DataFrame, groups: list[str], bucket: Column, order: list[Column],
                values: list[str], prefix: str = "above_") -> DataFrame:
    """For each row, the sums of ``values`` over rows strictly earlier in
    (bucket, order) within ``groups`` (exclusive prefix sums).

    Rows must be unique in the order (e.g. one row per distinct score).
    """
    d = df.withColumn("__b", bucket).where(F.col("__b").isNotNull())
    totals = d.groupBy(*groups, "__b").agg(*[F.sum(v).alias(f"__t{i}")
                                             for i, v in enumerate(values)])
    w = (Window.partitionBy(*groups).orderBy("__b")
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*groups, "__b", *[
        F.coalesce(F.sum(f"__t{i}").over(w), F.lit(0)).alias(f"__o{i}")
        for i in range(len(values))])
    d = join_null_safe(d, F.broadcast(offsets), [*groups, "__b"])
    w2 = (Window.partitionBy(*groups, "__b").orderBy(*order)
          .rowsBetween(Window.unboundedPreceding, -1))
    for i, v in enumerate(values):
        d = d.withColumn(f"{prefix}{v}",
                         F.coalesce(F.sum(v).over(w2), F.lit(0)) + F.col(f"__o{i}"))
    return d.drop("__b", *[f"__o{i}" for i in range(len(values))])
