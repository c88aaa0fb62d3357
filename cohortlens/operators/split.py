"""Sampling, splits and folds K1-K5.

Exact per-class quotas (largest remainder, ties to the lower class) and a
portable order key ``md5(row_id || ':' || seed)``, so sizes are exact and
membership is reproducible in any engine. Ranking uses the bucketed prefix
rank (hash buckets are uniform, so no task holds a whole class).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.exprs import seeded_hash
from cohortlens.functions.rank import hash_bucket, join_null_safe, prefix_rank


def class_quotas(counts: DataFrame, cls: str, n_col: str, take: Column) -> DataFrame:
    """Largest-remainder allocation of ``take`` rows over classes.

    ``counts`` has one row per class (tiny); ``take`` is an expression over the
    total ``__total``. Returns (cls, n_col, quota).
    """
    w_all = Window.partitionBy(F.lit(0))      # over the per-class rows only
    c = counts.withColumn("__total", F.sum(n_col).over(w_all))
    c = c.withColumn("__k", take.cast("bigint"))
    c = c.withColumn("__f", F.floor(F.col("__k") * F.col(n_col) / F.col("__total")).cast("bigint"))
    c = c.withColumn("__r", (F.col("__k") * F.col(n_col)) % F.col("__total"))
    c = c.withColumn("__left", F.col("__k") - F.sum("__f").over(w_all))
    c = c.withColumn("__rk", F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.desc("__r"), F.col(cls))))
    return c.select(cls, n_col, (F.col("__f") + (F.col("__rk") <= F.col("__left")).cast("bigint"))
                    .alias("quota"))


def ranked(df: DataFrame, label: str, key: str = "row_id", seed: int = 42,
           stratify: bool = True) -> DataFrame:
    """Adds ``__s`` (stratum) and ``__rank`` (1-based md5 order within stratum)."""
    h = seeded_hash(F.col(key), seed)
    d = df.withColumn("__s", F.col(label) if stratify else F.lit(0)).withColumn("__h", h)
    return prefix_rank(d, ["__s"], hash_bucket(F.col("__h")), [F.col("__h"), F.col(key)],
                       "__rank").drop("__h")


def stratified_split(df: DataFrame, label: str, key: str = "row_id", seed: int = 42,
                     test_size: float = 0.2, val_size: float = 0.2,
                     stratify: bool = True) -> DataFrame:
    """K1: adds ``split`` in {train, val, test} and ``split_rank`` (rank inside the split's class).

    test = ceil(test_size * n); val = ceil(val_size / (1 - test_size) * rest).
    """
    counts = df.groupBy((F.col(label) if stratify else F.lit(0)).alias("__s")).agg(
        F.count(F.lit(1)).alias("__n"))
    r = ranked(df, label, key, seed, stratify)
    test = class_quotas(counts, "__s", "__n", F.ceil(F.lit(float(test_size)) * F.col("__total")))
    test = test.select("__s", "__n", F.col("quota").alias("__qt"))
    rest = test.select("__s", (F.col("__n") - F.col("__qt")).alias("__rest"), "__qt")
    val_frac = val_size / (1.0 - test_size)
    val = class_quotas(rest, "__s", "__rest", F.ceil(F.lit(val_frac) * F.col("__total")))
    q = join_null_safe(test, val.select("__s", F.col("quota").alias("__qv")), ["__s"])
    # one row per class: bounded by the label domain
    out = join_null_safe(r, F.broadcast(q.select("__s", "__qt", "__qv")), ["__s"])
    rk = F.col("__rank")
    split = (F.when(rk <= F.col("__qt"), "test")
             .when(rk <= F.col("__qt") + F.col("__qv"), "val").otherwise("train"))
    in_split = (F.when(rk <= F.col("__qt"), rk)
                .when(rk <= F.col("__qt") + F.col("__qv"), rk - F.col("__qt"))
                .otherwise(rk - F.col("__qt") - F.col("__qv")))
    return out.withColumn("split", split).withColumn("split_rank", in_split.cast("bigint")) \
        .drop("__s", "__rank", "__qt", "__qv")


def fold_column(split_df: DataFrame, k: int = 5, name: str = "fold") -> DataFrame:
    """K2: stratified k folds over the training rows (null elsewhere)."""
    return split_df.withColumn(
        name, F.when(F.col("split") == "train",
                     F.pmod(F.col("split_rank") - 1, F.lit(k)).cast("int")))


def two_way_split(df: DataFrame, label: str, frac: float, key: str = "row_id", seed: int = 42,
                  names: tuple[str, str] = ("calib_fit", "calib_eval"),
                  stratify: bool = True) -> DataFrame:
    """K3: stratified two-part split; ``names[1]`` gets ceil(frac * n) rows."""
    counts = df.groupBy((F.col(label) if stratify else F.lit(0)).alias("__s")).agg(
        F.count(F.lit(1)).alias("__n"))
    r = ranked(df, label, key, seed, stratify)
    q = class_quotas(counts, "__s", "__n", F.ceil(F.lit(float(frac)) * F.col("__total")))
    out = join_null_safe(r, F.broadcast(q.select("__s", F.col("quota").alias("__q"))), ["__s"])
    return out.withColumn("part", F.when(F.col("__rank") <= F.col("__q"), names[1])
                          .otherwise(names[0])).drop("__s", "__rank", "__q")


def uniform_sample(df: DataFrame, n: int, key: str = "row_id", seed: int = 42) -> DataFrame:
    """K4: n rows without replacement, seeded; a top-k (no full sort)."""
    return df.orderBy(seeded_hash(F.col(key), seed), F.col(key)).limit(n)


def split_profile(split_df: DataFrame, label: str) -> DataFrame:
    """K5: rows and positive rate per split."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                         F.avg(F.col(label).cast("double")).alias("pos_rate"))


def expected_sizes(n: int, test_size: float = 0.2, val_size: float = 0.2) -> tuple[int, int, int]:
    """Driver-side helper for tests: (train, val, test) totals."""
    n_test = math.ceil(test_size * n)
    rest = n - n_test
    n_val = math.ceil(val_size / (1.0 - test_size) * rest)
    return rest - n_val, n_val, n_test
