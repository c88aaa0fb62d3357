"""Attribution X1-X5: model-agnostic permutation Shapley values as a Spark job.

For each explained row r, seeded permutation p and prefix length k = 0..F,
the masked point takes the first k features of the permutation from r and
the rest from each background row b. The model scores every masked point;
v(r,p,k) = mean over b; phi(r, perm[k]) = mean over p of v(k+1) - v(k).
Sum(phi) + base = score(r) holds exactly per permutation (telescoping).

A model that is a link over a linear margin (scaled logistic regression with
its calibrator) needs running sums only: numpy inside tasks, nothing scored
(``additive_values``). For every other model the work is rows x perms x (F+1) x
background model evaluations, generated per explained row with ``explode`` (no
join) and reduced by a partial aggregation, so only rows x perms x (F+1) values
shuffle. The background is a bounded sample (``n_background`` rows), shipped to
the tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.exprs import safe_corr
from cohortlens.functions.quantile import group_key, quartiles_by
from cohortlens.operators.split import uniform_sample

MAX_BACKGROUND = 1000     # the background is shipped to every task as a literal


def masked_points(sample: DataFrame, background: list[list[float]], features: list[str],
                  n_perm: int = 10, seed: int = 42, key: str = "row_id") -> DataFrame:
    """(row_id, p, k, b, features...) for every masked evaluation point."""
    F_ = len(features)
    bg = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in background])
    x = F.array(*[F.col(c).cast("double") for c in features])
    idx = F.sequence(F.lit(0), F.lit(F_ - 1))
    d = sample.select(F.col(key), x.alias("__x"),
                      F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))).alias("p"))
    # permutations use lambda functions (not code-generated): compute them on the small
    # (row, perm) table *before* the exchange, so the expansion stage after it runs
    # fully inside whole-stage codegen. The repartition also spreads the pairs over
    # many tasks (a top-k sample arrives in a single partition).
    from cohortlens.session import parallelism
    d = d.withColumn("__perm", permutation(F.col(key), F.col("p"), F_, seed))
    d = d.withColumn("__inv", F.transform(idx, lambda j: F.array_position(F.col("__perm"), j) - 1))
    d = d.drop("__perm").repartition(parallelism(sample.sparkSession), key, "p")
    d = d.select(key, "p", "__x", "__inv", F.explode(F.sequence(F.lit(0), F.lit(F_))).alias("k"))
    d = d.select(key, "p", "k", "__x", "__inv", F.posexplode(bg).alias("b", "__bg"))
    # plain per-feature expressions (code-generated), not a lambda per element
    return d.select(key, "p", "k", "b", *[
        F.when(F.col("__inv")[i] < F.col("k"), F.col("__x")[i]).otherwise(F.col("__bg")[i])
        .alias(c) for i, c in enumerate(features)])


def permutation(key, p, n_features: int, seed: int):
    """Seeded permutation of 0..n-1 for (row, p), in antithetic pairs: p = 2i is
    the indices sorted by md5(row:i:j:seed), p = 2i+1 is the same order reversed
    (forward and backward passes over one draw, as a permutation explainer does)."""
    idx = F.sequence(F.lit(0), F.lit(n_features - 1))
    draw = F.floor(p / 2).cast("long")
    keyed = F.transform(idx, lambda j: F.struct(
        F.md5(F.concat_ws(":", key.cast("string"), draw.cast("string"), j.cast("string"),
                          F.lit(str(seed)))).alias("h"), j.alias("j")))
    forward = F.transform(F.array_sort(keyed), lambda s: s["j"])
    return F.when(p % 2 == 0, forward).otherwise(F.reverse(forward))


def drawn_orders(key, n_perm: int, n_features: int, seed: int):
    """The forward orders behind ``n_perm`` permutations; :func:`both_ways` adds their reverses."""
    return F.array(*[permutation(key, F.lit(p), n_features, seed) for p in range(0, n_perm, 2)])


def both_ways(orders: pa.Array, n_perm: int, n_features: int) -> np.ndarray:
    """Rows x perms x features from an Arrow column of forward orders."""
    forward = orders.flatten().flatten().to_numpy(zero_copy_only=False).reshape(len(orders), -1, n_features)
    out = np.empty((len(orders), n_perm, n_features), dtype=np.int64)
    out[:, 0::2] = forward
    out[:, 1::2] = forward[:, :n_perm // 2, ::-1]
    return out


@dataclass
class AdditiveMargin:
    """A score ``link(bias + sum_j weights[j] * x_j)``; ``link`` maps arrays elementwise.
    Without a link the score is the margin itself."""
    weights: np.ndarray
    bias: float
    link: Callable[[np.ndarray], np.ndarray] | None


#: Running sums that one step holds (rows x background), so that they stay in a core's cache.
SUMS_PER_STEP = 100_000


def margin_gains(margin: AdditiveMargin, x: np.ndarray, background: np.ndarray, perms: np.ndarray) -> np.ndarray:
    """Attributions (rows x features) along each row's permutations (rows x perms x features).

    The running sums of all (row, background row) pairs take one feature after the
    other; the link is evaluated anew only where the feature moved the sum. Without
    a link the mean over the background is that of its mean row.
    """
    link = margin.link
    own, back = x * margin.weights, (background * margin.weights).T
    start = margin.bias + back.sum(axis=0)
    if link is None:
        back, start = back.mean(axis=1, keepdims=True), start.mean(keepdims=True)
    back, first = np.ascontiguousarray(back), link(start) if link else start
    phi = np.zeros_like(x)
    block = max(1, SUMS_PER_STEP // max(1, len(start)))
    for lo in range(0, len(x), block):
        mine, gain = own[lo:lo + block], phi[lo:lo + block]
        r = np.arange(len(mine))
        for p in range(perms.shape[1]):
            sums = np.tile(start, len(mine))
            value = np.tile(first, len(mine))
            before = value.reshape(len(mine), -1).mean(axis=1)
            for j in perms[lo:lo + block, p].T:
                move = (mine[r, j][:, None] - back[j]).ravel()
                if link is None:
                    value += move
                else:
                    moved = np.flatnonzero(move)
                    if 2 * len(moved) > len(move):
                        sums += move
                        value = link(sums)
                    else:
                        at = sums[moved] + move[moved]
                        sums[moved], value[moved] = at, link(at)
                v = value.reshape(len(mine), -1).mean(axis=1)
                gain[r, j] += v - before
                before = v
    return phi / perms.shape[1]


def additive_values(margin: AdditiveMargin, sample: DataFrame, background: np.ndarray,
                    features: list[str], n_perm: int, seed: int,
                    key: str = "row_id") -> tuple[DataFrame, float]:
    """X1 for a linear margin under a link: no masked point is built.

    Replacing background features by the row's moves the margin by
    ``w_j * (x_j - b_j)`` each, so v(r, p, k) is the mean of the link over
    running sums (:func:`margin_gains`). Nothing is shuffled but the spread of
    the rows.
    """
    from cohortlens.session import parallelism
    n = len(features)
    start = margin.bias + background @ margin.weights
    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = sample.select(F.col(key), x.alias("x")).repartition(
        parallelism(sample.sparkSession), key).select(key, "x", drawn_orders(F.col(key), n_perm, n, seed).alias("orders"))
    names = list(features)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n)
            phi = margin_gains(margin, x, background, both_ways(batch.column(2), n_perm, n))
            at = pa.array(np.repeat(np.arange(len(x)), n))
            name = pa.DictionaryArray.from_arrays(pa.array(np.tile(np.arange(n, dtype=np.int32), len(x))), pa.array(names, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), name.cast(pa.string()), pa.array(x.ravel()), pa.array(phi.ravel())],
                                             names=[key, "feature", "value", "phi"])

    key_type = sample.schema[key].dataType.simpleString()
    out = rows.mapInArrow(run, f"`{key}` {key_type}, feature string, value double, phi double")
    return out, float((margin.link(start) if margin.link else start).mean())


def shapley_values(model, sample: DataFrame, background: DataFrame, features: list[str],
                   n_perm: int = 10, seed: int = 42, key: str = "row_id",
                   score_col: str = "score") -> tuple[DataFrame, float]:
    """Long table (row_id, feature, value, phi) and the base value.

    ``model.transform(df)`` must add ``score_col``. ``background`` must be a
    bounded sample (it is collected once, e.g. 100 rows). A model whose
    ``additive(features)`` gives an :class:`AdditiveMargin` takes the short path
    of :func:`additive_values`, one whose ``paths(features)`` gives its trees that of
    :func:`tree_paths.path_values`; every other model scores the masked points.
    """
    got = background.select(features).limit(MAX_BACKGROUND + 1).collect()
    if len(got) > MAX_BACKGROUND:
        raise ValueError(f"background must be a sample of at most {MAX_BACKGROUND} rows")
    bg_rows = [[float(r[c]) for c in features] for r in got]
    margin = model.additive(features) if hasattr(model, "additive") else None
    if margin is not None:
        return additive_values(margin, sample, np.array(bg_rows).reshape(-1, len(features)),
                               features, n_perm, seed, key)
    trees = model.paths(features) if hasattr(model, "paths") else None
    if trees is not None:
        from cohortlens.operators.tree_paths import path_values
        return path_values(trees, sample, np.array(bg_rows).reshape(-1, len(features)),
                           features, n_perm, seed, key)
    pts = masked_points(sample, bg_rows, features, n_perm, seed, key)
    scored = model.transform(pts)
    v = scored.groupBy(key, "p", "k").agg(F.avg(score_col).alias("v"))
    w = Window.partitionBy(key, "p").orderBy("k")     # F+1 rows per (row, perm)
    steps = v.withColumn("dv", F.col("v") - F.lag("v").over(w)).where(F.col("k") > 0)
    perm = permutation(F.col(key), F.col("p"), len(features), seed)
    steps = steps.withColumn("j", perm[F.col("k") - 1])
    phi = steps.groupBy(key, "j").agg(F.avg("dv").alias("phi"))
    names = F.array(*[F.lit(c) for c in features])
    vals = sample.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("__x"))
    out = phi.join(vals, key).select(key, names[F.col("j")].alias("feature"),
                                     F.col("__x")[F.col("j")].alias("value"), "phi")
    base = v.where(F.col("k") == 0).agg(F.avg("v")).first()[0]
    return out, float(base)


def explain(model, frame: DataFrame, features: list[str], n_rows: int | None = None,
            n_background: int = 100, n_perm: int = 10, seed: int = 42, key: str = "row_id"):
    """X1 for every row of ``frame`` (or for ``n_rows`` of them, drawn by K4), against a
    background of ``n_background`` of those rows."""
    from cohortlens.session import materialize
    frame = frame.select(key, *features)
    sample = materialize(frame if n_rows is None else uniform_sample(frame, n_rows, key, seed), "table")
    background = uniform_sample(sample, n_background, key, seed + 1)
    return shapley_values(model, sample, background, features, n_perm, seed, key)


def global_importance(phi: DataFrame, top_n: int = 20) -> DataFrame:
    """Mean |phi| per feature, top ``top_n``."""
    g = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean_abs_phi"), "feature")  # F rows
    return g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)


def impact_distribution(phi: DataFrame) -> DataFrame:
    """Per-feature phi quantiles and the phi-value correlation (beeswarm data)."""
    g = phi.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("phi").alias("phi_min"), F.max("phi").alias("phi_max"),
        safe_corr(F.col("value"), F.col("phi")).alias("value_phi_corr")).withColumn("__key", group_key(["feature"]))
    return g.join(quartiles_by(phi, ["feature"], "phi"), "__key", "left").select(
        "feature", "n", "phi_min", F.col("q").alias("phi_q"), "phi_max", "value_phi_corr")


def dependence_pairs(phi: DataFrame, top_n: int = 4) -> DataFrame:
    """(feature, value, phi) for the ``top_n`` most important features."""
    top = global_importance(phi, top_n).select("feature")
    return phi.join(F.broadcast(top), "feature", "left_semi")   # <= top_n rows


def row_breakdown(phi: DataFrame, base: float, rows: DataFrame, key: str = "row_id") -> DataFrame:
    """For the given rows, contributions by |phi| desc with running totals from base."""
    sel = phi.join(rows.select(key), key, "left_semi")
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("phi")), "feature")   # F rows per row
    return sel.withColumn("order", F.row_number().over(w)).withColumn(
        "running", F.lit(base) + F.sum("phi").over(w.rowsBetween(Window.unboundedPreceding, 0)))


class ExpressionModel:
    """Wrap a score expression over feature columns as a model (``transform`` adds
    ``score``), so any SQL-expressible scorer can be explained with the same job.
    ``weights`` says that the expression is their linear margin."""

    def __init__(self, expr, out: str = "score", weights: dict[str, float] | None = None):
        self.expr, self.out, self.weights = expr, out, weights

    def additive(self, features: list[str]) -> AdditiveMargin | None:
        if self.weights is None:
            return None
        return AdditiveMargin(np.array([self.weights.get(c, 0.0) for c in features]), 0.0, None)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.out, self.expr)


def linear_margin(weights: dict[str, float]) -> ExpressionModel:
    """Linear margin sum(w_j * x_j): its exact Shapley value against a background is
    w_j * (x_j - mean_b x_bj), which every permutation reproduces exactly."""
    expr = None
    for c, w in weights.items():
        term = F.col(c).cast("double") * F.lit(float(w))
        expr = term if expr is None else expr + term
    return ExpressionModel(expr, weights=weights)
