"""Evaluation V1-V13 on a long scored table ``(model, split, row_id, label, score)``.

Threshold metrics are conditional counts in one grouped aggregate. Ranking
metrics (exact ROC-AUC with averaged ties, step-sum average precision, the
curves) first collapse rows to distinct scores per group -- partial
aggregation, so a hot score costs one row -- then use the bucketed prefix
sums, never a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.exprs import safe_div
from cohortlens.functions.rank import prefix_sums, score_bucket_desc

GROUP = ["model", "split"]


def score_table(df: DataFrame, models: dict[str, Column], label: str, key: str = "row_id",
                split: str = "split") -> DataFrame:
    """Long scored table from per-model score expressions (no join: one generator)."""
    return df.select(F.col(key).alias("row_id"), F.col(split).alias("split"),
                     F.col(label).cast("int").alias("label"),
                     F.inline(F.array(*[F.struct(F.lit(m).alias("model"),
                                                 e.cast("double").alias("score"))
                                        for m, e in models.items()])))


# ------------------------------------------------------------------ V1-V3
def confusion(scored: DataFrame, threshold: float | Column = 0.5, groups=GROUP) -> DataFrame:
    """V1: tn, fp, fn, tp at ``score >= threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col("score") >= t
    y = F.col("label") == 1
    return scored.groupBy(*groups).agg(
        F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp"))


def threshold_metrics_cols() -> list[Column]:
    """V2 from tn/fp/fn/tp columns; 0 when a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return [safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
            safe_div(tp, tp + fp).alias("precision"),
            safe_div(tp, tp + fn).alias("recall"),
            safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
            safe_div(tn, tn + fp).alias("specificity")]


def threshold_metrics(scored: DataFrame, threshold: float = 0.5, groups=GROUP) -> DataFrame:
    c = confusion(scored, threshold, groups)
    return c.select(*groups, "tn", "fp", "fn", "tp", *threshold_metrics_cols())


def brier(scored: DataFrame, groups=GROUP) -> DataFrame:
    """V3: mean squared error of the probability."""
    return scored.groupBy(*groups).agg(
        F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier"))


# ------------------------------------------------------------------ V4-V7
def distinct_scores(scored: DataFrame, groups=GROUP) -> DataFrame:
    """(groups, score, pos, neg, above_pos, above_neg): one row per distinct score,
    with the positives/negatives of strictly higher scores."""
    d = scored.groupBy(*groups, "score").agg(
        F.sum(F.col("label")).cast("bigint").alias("pos"),
        F.sum(1 - F.col("label")).cast("bigint").alias("neg"))
    return prefix_sums(d, list(groups), score_bucket_desc(F.col("score")),
                       [F.desc("score")], ["pos", "neg"], prefix="above_")


def ranking_metrics(scored: DataFrame, groups=GROUP) -> DataFrame:
    """V4 ROC-AUC (ties count half) and V5 average precision (step sum)."""
    d = distinct_scores(scored, groups)
    tp = F.col("above_pos") + F.col("pos")
    fp = F.col("above_neg") + F.col("neg")
    g = d.groupBy(*groups).agg(
        F.sum(F.col("neg") * (F.col("above_pos") + F.col("pos") / 2.0)).alias("__u"),
        F.sum(F.col("pos") * (tp / (tp + fp))).alias("__ap"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    # a one-class group has no ranking metric: null instead of failing the whole job
    return g.select(*groups, F.try_divide(F.col("__u"), F.col("P") * F.col("N")).alias("roc_auc"),
                    F.try_divide(F.col("__ap"), F.col("P")).alias("pr_auc"))


def _with_totals(d: DataFrame, scored: DataFrame, groups) -> DataFrame:
    """Attach per-group P and N. They come from the scored rows (one partial
    aggregate, few rows, broadcast), not from ``d``, so the window pipeline that
    produced ``d`` runs once."""
    tot = scored.groupBy(*groups).agg(F.sum(F.col("label")).cast("bigint").alias("P"),
                                      F.sum(1 - F.col("label")).cast("bigint").alias("N"))
    return d.join(F.broadcast(tot), list(groups))


def roc_curve(scored: DataFrame, groups=GROUP) -> DataFrame:
    """V6: (threshold, fpr, tpr) per distinct score, highest first."""
    d = _with_totals(distinct_scores(scored, groups), scored, groups)
    return d.select(*groups, F.col("score").alias("threshold"),
                    F.try_divide(F.col("above_neg") + F.col("neg"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("above_pos") + F.col("pos"), F.col("P")).alias("tpr"))


def pr_curve(scored: DataFrame, groups=GROUP) -> DataFrame:
    """V7: (threshold, precision, recall, prevalence) per distinct score."""
    d = _with_totals(distinct_scores(scored, groups), scored, groups)
    tp = F.col("above_pos") + F.col("pos")
    fp = F.col("above_neg") + F.col("neg")
    return d.select(*groups, F.col("score").alias("threshold"),
                    (tp / (tp + fp)).alias("precision"), F.try_divide(tp, F.col("P")).alias("recall"),
                    (F.col("P") / (F.col("P") + F.col("N"))).alias("prevalence"))


# ------------------------------------------------------------------ V8
def reliability_curve(scored: DataFrame, bins: int = 10, groups=GROUP) -> DataFrame:
    """V8: uniform bins on [0, 1]; bin = number of inner edges strictly below the score
    (left-sided search), so a score on an edge goes to the lower bin; empty bins omitted."""
    import numpy as np
    edges = [float(e) for e in np.linspace(0.0, 1.0, bins + 1)[1:-1]]
    b = sum((F.col("score") > F.lit(e)).cast("int") for e in edges)
    return scored.groupBy(*groups, b.alias("bin")).agg(
        F.avg("score").alias("mean_score"), F.avg(F.col("label").cast("double")).alias("frac_pos"),
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ V9-V13
def class_report(scored: DataFrame, threshold: float = 0.5, groups=GROUP) -> DataFrame:
    """V9: per-class precision/recall/F1/support, macro and weighted averages."""
    c = confusion(scored, threshold, groups)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    rows = [
        F.struct(F.lit("0").alias("class"), safe_div(tn, tn + fn).alias("precision"),
                 safe_div(tn, tn + fp).alias("recall"), safe_div(2 * tn, 2 * tn + fn + fp).alias("f1"),
                 (tn + fp).alias("support")),
        F.struct(F.lit("1").alias("class"), safe_div(tp, tp + fp).alias("precision"),
                 safe_div(tp, tp + fn).alias("recall"), safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                 (tp + fn).alias("support")),
    ]
    per = c.select(*groups, n.alias("__n"), F.inline(F.array(*rows)))
    avg_rows = per.groupBy(*groups).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("s"))
    avgs = avg_rows.select(*groups, F.inline(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("s").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("s").alias("support")))))
    return per.drop("__n").unionByName(avgs)


def evaluate(scored: DataFrame, threshold: float = 0.5, groups=GROUP) -> DataFrame:
    """V2-V5 together: one row per group with the eight reference metrics."""
    t = threshold_metrics(scored, threshold, groups)
    r = ranking_metrics(scored, groups)
    b = brier(scored, groups)
    return (r.join(t, list(groups)).join(b, list(groups))
            .select(*groups, "roc_auc", "pr_auc", "accuracy", "precision", "recall", "f1",
                    "specificity", "brier"))


def compare_models(metrics: DataFrame, split: str = "val") -> DataFrame:
    """One row per model, sorted by ROC-AUC desc, 4 decimals."""
    m = metrics.where(F.col("split") == split).drop("split")
    cols = [c for c in m.columns if c != "model"]
    return m.select("model", *[F.round(c, 4).alias(c) for c in cols]).orderBy(F.desc("roc_auc"))


def best_model(metrics: DataFrame, metric: str = "roc_auc", split: str = "val") -> DataFrame:
    """Argmax of ``metric`` (unknown metric -> roc_auc); ties -> smaller name."""
    if metric not in metrics.columns:
        metric = "roc_auc"
    m = metrics.where(F.col("split") == split)
    order = F.struct((-F.col(metric)).alias("k"), F.col("model").alias("m"))
    return m.agg(F.min_by("model", order).alias("best_model"),
                 F.max(metric).alias("best_value"))


def metrics_long(metrics: DataFrame, scored: DataFrame, split: str = "val",
                 names=("roc_auc", "pr_auc", "precision", "recall", "f1")) -> DataFrame:
    """(model, metric, value) plus the no-skill line (prevalence) per model."""
    m = metrics.where(F.col("split") == split)
    long = m.select("model", F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
        for n in names])))
    prev = (scored.where(F.col("split") == split).groupBy("model")
            .agg(F.avg(F.col("label").cast("double")).alias("value"))
            .select("model", F.lit("no_skill").alias("metric"), "value"))
    return long.unionByName(prev)


def split_comparison(scored: DataFrame, threshold: float, splits=("val", "test")) -> DataFrame:
    """The reference metrics for each split at the chosen threshold."""
    return evaluate(scored.where(F.col("split").isin(*splits)), threshold)
