"""Threshold analysis T6-T8 in one pass over the scored rows.

Each row is bucketed by how many grid thresholds lie at or below its score
(0..len(grid)); the grouped counts are at most (len(grid)+1) rows per
group, and a reverse running sum over that tiny table yields the confusion
counts for every threshold at once (instead of one pass per threshold).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.exprs import safe_div
from cohortlens.operators.metrics import GROUP


def threshold_grid(lo: float = 0.05, hi: float = 0.95, step: float = 0.05) -> list[float]:
    """End-inclusive evenly spaced grid (linspace, so no accumulation error)."""
    n = int(round((hi - lo) / step)) + 1
    return [float(t) for t in np.linspace(lo, hi, n)]


def threshold_sweep(scored: DataFrame, grid: list[float] | None = None, groups=GROUP) -> DataFrame:
    """Per group and grid threshold: precision, recall, f1, specificity, accuracy.

    The unrounded grid value decides ``score >= t``; ``threshold`` reports it to 3 places.
    """
    grid = grid or threshold_grid()
    k = len(grid)
    b = sum((F.col("score") >= F.lit(t)).cast("int") for t in grid)
    cnt = scored.groupBy(*groups, b.alias("b")).agg(
        F.sum("label").cast("bigint").alias("pos"),
        F.sum(1 - F.col("label")).cast("bigint").alias("neg"))
    tot = cnt.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    dom = tot.select(*groups, "P", "N", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("b"))
    full = dom.join(cnt, [*groups, "b"], "left").fillna(0, subset=["pos", "neg"])
    # rows with bucket >= i are predicted positive at grid[i-1]
    w = (Window.partitionBy(*groups).orderBy(F.desc("b"))
         .rowsBetween(Window.unboundedPreceding, 0))
    full = full.select(*groups, "b", "P", "N", F.sum("pos").over(w).alias("tp"),
                       F.sum("neg").over(w).alias("fp"))
    grid_map = F.create_map(*[x for i, t in enumerate(grid) for x in (F.lit(i + 1), F.lit(t))])
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return full.select(
        *groups, F.round(grid_map[F.col("b")], 3).alias("threshold"),
        safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"), safe_div(tn, tn + fp).alias("specificity"),
        safe_div(tp + tn, F.col("P") + F.col("N")).alias("accuracy"))


def choose_threshold(sweep: DataFrame, optimize_by: str = "recall", recall_target: float = 0.80,
                     groups=GROUP) -> DataFrame:
    """Recall mode: max precision among recall >= target, else max F1;
    a named metric: its argmax; unknown -> F1. Ties -> lowest threshold."""
    metrics = ("precision", "recall", "f1", "specificity", "accuracy")
    if optimize_by == "recall":
        ok = F.col("recall") >= F.lit(recall_target)
        has = F.max(ok.cast("int")).over(Window.partitionBy(*groups))
        key = F.when(has == 1, F.when(ok, F.col("precision"))).otherwise(F.col("f1"))
        rule = F.when(has == 1, F.lit("max_precision_at_recall")).otherwise(F.lit("max_f1"))
    else:
        m = optimize_by if optimize_by in metrics else "f1"
        key, rule = F.col(m), F.lit(f"max_{m}")
    # windows run over the sweep table: len(grid) rows per group
    ranked = sweep.select(*groups, "threshold", key.alias("__k"), rule.alias("rule")).where(
        F.col("__k").isNotNull())
    w = Window.partitionBy(*groups).orderBy(F.desc("__k"), "threshold")
    return (ranked.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1)
            .select(*groups, "threshold", "rule"))


def sweep_long(sweep: DataFrame, groups=GROUP) -> DataFrame:
    """(threshold, metric, value) for precision, recall, f1, specificity."""
    names = ("precision", "recall", "f1", "specificity")
    return sweep.select(*groups, "threshold", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])))
