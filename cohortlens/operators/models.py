"""Model training, scoring and tuning M1-M10, M13 on MLlib.

Features stay typed columns until the MLlib boundary (``VectorAssembler``).
Parameters follow the reference configuration, translated to Spark's
objective scaling (see ``logistic_regression``). Fits are distributed; the
only driver-side values are class counts, row counts and fitted models.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.functions.exprs import seeded_hash

VEC = "features_vec"


# ------------------------------------------------------------------ M2 class weights
def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """n / (k * n_c) per class: one tiny aggregate (k classes rows)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    w = Window.partitionBy(F.lit(0))            # over the k class rows only
    return c.select(label, (F.sum("__nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("__nc")))
                    .alias("weight"))


def with_class_weights(df: DataFrame, label: str, balanced: bool = True) -> DataFrame:
    """M2: ``weight`` column, recomputed for whatever frame is being fitted."""
    if not balanced:
        return df.withColumn("weight", F.lit(1.0))
    return df.join(F.broadcast(class_weight_table(df, label)), label)


# ------------------------------------------------------------------ estimators (M1, M3-M5)
def assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VEC, handleInvalid="error")


def logistic_regression(features: list[str], label: str, n_weight: float, C: float = 1.0,
                        penalty: str = "l2", max_iter: int = 1000, **_) -> Pipeline:
    """M1 + M3: standard scaling then LR.

    sklearn minimises ``C * sum(w_i * loss_i) + penalty``; Spark minimises
    ``sum(w_i * loss_i) / sum(w) + regParam * penalty``, so regParam =
    1 / (C * sum(w)). With balanced weights sum(w) = n. The scaler uses the
    sample std (sklearn: population std) -- a documented difference.
    """
    scaler = StandardScaler(inputCol=VEC, outputCol="features_std", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="features_std", labelCol=label, weightCol="weight",
                            regParam=1.0 / (C * n_weight),
                            elasticNetParam=1.0 if penalty == "l1" else 0.0,
                            standardization=False, maxIter=max_iter)
    return Pipeline(stages=[assembler(features), scaler, lr])


def random_forest(features: list[str], label: str, n_estimators: int = 200,
                  max_depth: int | None = None, min_samples_leaf: int = 10, seed: int = 42,
                  **_) -> Pipeline:
    """M4: bootstrap forest, sqrt feature subsets; depth None -> Spark's maximum 30."""
    rf = RandomForestClassifier(featuresCol=VEC, labelCol=label, weightCol="weight",
                                numTrees=n_estimators, maxDepth=min(max_depth or 30, 30),
                                minInstancesPerNode=min_samples_leaf,
                                featureSubsetStrategy="sqrt", bootstrap=True, seed=seed,
                                # execution knobs only (same trees): more nodes split per
                                # pass over the data, node ids cached between levels
                                maxMemoryInMB=1024, cacheNodeIds=True)
    return Pipeline(stages=[assembler(features), rf])


def fit_random_forest(data: DataFrame, features: list[str], label: str, params: dict, seed: int = 42) -> PipelineModel:
    """M4 by :mod:`cohortlens.operators.forest`; many levels in one sparse vector column go to MLlib's own fit."""
    from cohortlens.operators.forest import fit_forest
    estimator = random_forest(features, label, seed=seed, **params)
    if any(isinstance(data.schema[c].dataType, VectorUDT) for c in features):
        return estimator.fit(spread(data, features, label))
    vectors, forest = estimator.getStages()
    return PipelineModel([vectors, fit_forest(vectors.transform(data), VEC, len(features), forest)])


def gradient_boosting(features: list[str], label: str, max_iter: int = 200,
                      learning_rate: float = 0.05, max_depth: int = 5,
                      min_samples_leaf: int = 20, seed: int = 42, **_) -> Pipeline:
    """M5: ``max_iter`` boosted trees; early stopping is :func:`fit_boosting`'s."""
    gbt = GBTClassifier(featuresCol=VEC, labelCol=label, weightCol="weight", maxIter=max_iter,
                        stepSize=learning_rate, maxDepth=max_depth, minInstancesPerNode=min_samples_leaf,
                        seed=seed, maxMemoryInMB=1024, cacheNodeIds=True)
    return Pipeline(stages=[assembler(features), gbt])


@dataclass(frozen=True)
class EarlyStop:
    """When boosting ends: after ``patience`` rounds without a gain of ``tolerance`` on the held-out
    share. ``enabled`` None holds a share out only above ``least_rows`` rows, as the source's library does."""
    enabled: bool | None = None
    patience: int = 10
    tolerance: float = 1e-7
    holdout: float = 0.1
    least_rows: int = 10_000
    first_run: int = 25

    def holds(self, n_rows: int) -> bool:
        return n_rows > self.least_rows if self.enabled is None else self.enabled


def stop_round(losses: list[float], patience: int, tolerance: float) -> tuple[int, bool]:
    """(trees of the best prefix, whether the patience ran out) of staged held-out losses."""
    best, at = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best - tolerance:
            best, at = loss, i + 1
        elif i + 1 - at >= patience:
            return max(at, 1), True
    return max(at, 1), False


def truncated(model: GBTClassificationModel, n_trees: int, spark: SparkSession) -> GBTClassificationModel:
    """The ensemble of the first ``n_trees`` trees."""
    if n_trees >= model.getNumTrees:
        return model
    sc = spark.sparkContext                    # a search's threads have no active session
    jvm, gateway = sc._jvm, sc._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n_trees)
    weights = gateway.new_array(jvm.double, n_trees)
    have, scale = model._java_obj.trees(), model.treeWeights
    for i in range(n_trees):
        trees[i], weights[i] = have[i], scale[i]
    short = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        f"{model.uid}_{n_trees}", trees, weights, model.numFeatures, model.numClasses)
    out = GBTClassificationModel(short)
    model._copyValues(out)
    out._transfer_params_to_java()
    return out


def fit_boosting(data: DataFrame, features: list[str], label: str, params: dict, seed: int = 42,
                 stop: EarlyStop = EarlyStop()) -> PipelineModel:
    """M5 by :mod:`cohortlens.operators.boosting`, with patience: staged losses on held-out rows choose the ensemble's length.

    Many levels in one sparse vector column go to MLlib's own fit.
    """
    from cohortlens.operators.boosting import fit_boosted
    params = {k: v for k, v in params.items() if k != "early_stop"}
    if any(isinstance(data.schema[c].dataType, VectorUDT) for c in features):
        return _fit_boosting_runs(data, features, label, params, seed, stop)
    vectors, gbt = gradient_boosting(features, label, seed=seed, **params).getStages()
    if not stop.holds(data.count()):
        return PipelineModel([vectors, fit_boosted(vectors.transform(data), VEC, len(features), gbt)])
    flagged = vectors.transform(early_stop_indicator(data, stop.holdout, seed))
    return PipelineModel([vectors, fit_boosted(flagged, VEC, len(features), gbt, "is_early_stop", stop.patience, stop.tolerance)])


def _fit_boosting_runs(data: DataFrame, features: list[str], label: str, params: dict, seed: int, stop: EarlyStop) -> PipelineModel:
    """Boosting by MLlib's own fit.

    A run of more rounds begins with the trees of a shorter one (same rows and
    seed), so runs double until the patience ends inside one or ``max_iter`` is
    reached; all of them cost at most twice the last.
    """
    most = int(params.get("max_iter", 200))
    if not stop.holds(data.count()):
        data = spread(data, features, label)
        return gradient_boosting(features, label, seed=seed, **params).fit(data)
    flagged = early_stop_indicator(data, stop.holdout, seed)
    rest = spread(flagged.where(~F.col("is_early_stop")), features, label)
    held = assembler(features).transform(flagged.where("is_early_stop")).select(
        VEC, F.col(label).cast("double").alias(label), "weight")
    rounds = min(stop.first_run, most)
    while True:
        model = gradient_boosting(features, label, seed=seed, **{**params, "max_iter": rounds}).fit(rest)
        trees = model.stages[-1]
        best, over = stop_round(staged_losses(trees, held, label), stop.patience, stop.tolerance)
        if over or rounds == most:
            return PipelineModel([model.stages[0], truncated(trees, best, data.sparkSession)])
        rounds = min(2 * rounds, most)


def staged_losses(model: GBTClassificationModel, held: DataFrame, label: str) -> list[float]:
    """Logistic loss of every prefix of the ensemble on the held-out rows, in one pass."""
    if not held.limit(1).count():
        raise ValueError("early stopping held out no row")
    return list(model.evaluateEachIteration(held.withColumnRenamed(label, model.getLabelCol())))


def early_stop_indicator(df: DataFrame, frac: float = 0.1, seed: int = 42,
                         name: str = "is_early_stop") -> DataFrame:
    """Deterministic ~frac holdout flag from the md5 key (no shuffle)."""
    h = F.conv(F.substring(seeded_hash(F.col("row_id"), seed + 7), 1, 8), 16, 10).cast("double")
    return df.withColumn(name, h / float(16 ** 8) < frac)


def build_estimator(name: str, features: list[str], label: str, params: dict, n_weight: float,
                    seed: int = 42) -> Pipeline:
    if name == "LogisticRegression":
        return logistic_regression(features, label, n_weight, **params)
    if name == "RandomForest":
        return random_forest(features, label, seed=seed, **params)
    if name == "GradientBoosting":
        return gradient_boosting(features, label, seed=seed, **params)
    raise ValueError(f"unknown model {name!r}")


def fit(name: str, train: DataFrame, features: list[str], label: str, params: dict,
        seed: int = 42, balanced: bool = True) -> PipelineModel:
    """M9: fit as configured (no search). Returns a PipelineModel."""
    return fit_weighted(name, with_class_weights(train, label, balanced), features, label, params, seed)


def fit_weighted(name: str, data: DataFrame, features: list[str], label: str, params: dict,
                 seed: int = 42, n_weight: float | None = None) -> PipelineModel:
    """A fit on rows that carry their ``weight``; ``n_weight`` is its sum where the caller has it."""
    if name == "GradientBoosting":
        return fit_boosting(data, features, label, params, seed, params.get("early_stop", EarlyStop()))
    if name == "RandomForest":
        return fit_random_forest(data, features, label, params, seed)
    if name == "LogisticRegression" and n_weight is None:
        n_weight = float(data.agg(F.sum("weight")).first()[0])
    return build_estimator(name, features, label, params, n_weight or 1.0, seed).fit(data)


def spread(data: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows of a tree fit over as many partitions as there are cores: a written table may be read in fewer,
    and each further partition adds its own statistics of all nodes."""
    keep = [c for c in ("row_id", label, "weight", *features) if c in data.columns]
    return data.select(*keep).repartition(data.sparkSession.sparkContext.defaultParallelism, *(["row_id"] if "row_id" in keep else []))


# ------------------------------------------------------------------ M10 / M11 scoring
def positive_probability(col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def score(model: PipelineModel, df: DataFrame, name: str, label: str,
          split_col: str = "split") -> DataFrame:
    """Long scored rows (model, split, row_id, label, score)."""
    out = model.transform(df)
    return out.select(F.lit(name).alias("model"), F.col(split_col).alias("split"), "row_id",
                      F.col(label).cast("int").alias("label"),
                      positive_probability().alias("score"))


def predict(scored: DataFrame, threshold: float) -> DataFrame:
    """0/1 prediction at ``score >= threshold``."""
    return scored.withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))


# ------------------------------------------------------------------ M6 cross-validation
def cross_validate(name: str, train: DataFrame, features: list[str], label: str, params: dict,
                   fold_col: str = "fold", k: int = 5, seed: int = 42,
                   parallelism: int = 1) -> DataFrame:
    """M6: per-fold ROC-AUC, average precision and F1, scored into one long table.

    Class weights are recomputed on each fold's training part. With
    ``parallelism`` > 1 the k fits are submitted as concurrent Spark jobs.
    """
    from concurrent.futures import ThreadPoolExecutor

    from cohortlens.operators.metrics import ranking_metrics, threshold_metrics

    def one(f):
        model = fit(name, train.where(F.col(fold_col) != f), features, label, params, seed)
        held = train.where(F.col(fold_col) == f).withColumn("split", F.lit(f"fold{f}"))
        return score(model, held, name, label)

    if parallelism > 1:
        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(one, range(k)))
    else:
        parts = [one(f) for f in range(k)]
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    per = ranking_metrics(scored).join(
        threshold_metrics(scored, 0.5).select("model", "split", "f1"), ["model", "split"])
    return per.withColumnRenamed("split", "fold")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """mean and population std of each CV metric."""
    aggs = []
    for m in ("roc_auc", "pr_auc", "f1"):
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.groupBy("model").agg(*aggs)


# ------------------------------------------------------------------ M7 / M8 search
# search keys with no MLlib analogue: the solver is MLlib's own choice, and trees have
# no minimum-samples-to-split parameter (minInstancesPerNode covers the leaf size)
NOT_APPLICABLE = ("solver", "min_samples_split")


def search_space(name: str, spaces: dict) -> list[dict]:
    """M7: the grid of distinct parameter maps for ``name``.

    Keys are taken as configured; a pipeline-step prefix (``classifier__``) is
    stripped and keys without an MLlib analogue are dropped before the product.
    """
    space = {}
    for key, values in spaces.get(name, {}).items():
        bare = key.split("__")[-1]
        if bare not in NOT_APPLICABLE:
            space[bare] = list(values)
    keys = sorted(space)
    return [dict(zip(keys, vals)) for vals in product(*[space[k] for k in keys])]


def sample_draws(grid: list[dict], n: int, seed: int = 42) -> list[dict]:
    """Seeded sample without replacement of ``n`` grid points."""
    rng = random.Random(seed)
    return rng.sample(grid, min(n, len(grid)))


class ExactAUCEvaluator(Evaluator):
    """ROC-AUC with averaged ties, computed by the set-based operator (no binning)."""

    def __init__(self, label: str = "label"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        from cohortlens.operators.metrics import ranking_metrics
        s = dataset.select(F.lit("m").alias("model"), F.lit("s").alias("split"),
                           F.col(self.label).cast("int").alias("label"),
                           positive_probability().alias("score"))
        return float(ranking_metrics(s).first()["roc_auc"])

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class Fold:
    """Training rows of one fold, written once with their weights, and the rows held out."""
    number: int
    train: DataFrame
    n_weight: float
    held: DataFrame


def fold_frames(train: DataFrame, features: list[str], label: str, k: int, fold_col: str = "fold") -> list[Fold]:
    """The k folds of a search: every draw reads the same tables instead of weighting the rows anew."""
    from cohortlens.session import materialize
    columns = ["row_id", label, *features]
    out = []
    for f in range(k):
        rows = materialize(with_class_weights(train.where(F.col(fold_col) != f).select(columns), label), "table")
        held = train.where(F.col(fold_col) == f).select(columns).withColumn("split", F.lit(f"fold{f}"))
        out.append(Fold(f, rows, float(rows.agg(F.sum("weight")).first()[0] or 0.0), held))
    return out


def search_scores(name: str, draws: list[dict], folds: list[Fold], features: list[str], label: str,
                  seed: int = 42, parallelism: int = 4) -> list[float]:
    """Mean exact ROC-AUC of each draw over the folds.

    All (draw, fold) pairs are independent. Logistic regressions advance together,
    a pass over the folds per step (``logistic_search``); tree fits run as
    concurrent jobs of ``parallelism`` threads, each writes its scored rows. One
    grouped pass over all scores gives every AUC.
    """
    from concurrent.futures import ThreadPoolExecutor

    from cohortlens.operators.logistic_search import held_scores
    from cohortlens.operators.metrics import ranking_metrics
    from cohortlens.session import materialize

    def one(pair):
        i, fold = pair
        model = fit_weighted(name, fold.train, features, label, draws[i], seed, fold.n_weight)
        return materialize(score(model, fold.held, f"draw{i}", label), "table")

    if name == "LogisticRegression":
        per = ranking_metrics(materialize(held_scores(folds, draws, features, label), "table"))
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(one, [(i, f) for i in range(len(draws)) for f in folds]))
        paths = [p.inputFiles()[0].rsplit("/", 1)[0] for p in parts if p.inputFiles()]
        per = ranking_metrics(parts[0].sparkSession.read.parquet(*paths))
    got = {r["model"]: r["a"] for r in per.groupBy("model").agg(F.avg("roc_auc").alias("a")).collect()}
    return [float(got.get(f"draw{i}") or 0.0) for i in range(len(draws))]


def random_search(name: str, train: DataFrame, features: list[str], label: str, spaces: dict,
                  n_draws: int = 20, k: int = 5, seed: int = 42, fold_col: str = "fold",
                  parallelism: int = 4, fixed: dict | None = None, folds: list[Fold] | None = None) -> dict:
    """M8: seeded draws from the grid of any family, k-fold CV on exact ROC-AUC, refit best on all of train.

    ``fixed`` parameters join every draw; ``folds`` (of :func:`fold_frames`) are
    shared by the searches of several families. Returns the refitted model, the
    winning parameters, its CV score and a (draw, params, cv_roc_auc) list. Ties go
    to the earlier draw.
    """
    fixed = fixed or {}
    draws = sample_draws(search_space(name, spaces), n_draws, seed)
    if not draws:                                                     # M9 fallback
        return {"model": fit(name, train, features, label, fixed, seed), "params": {},
                "cv_score": None, "draws": []}
    folds = folds or fold_frames(train, features, label, k, fold_col)
    scores = search_scores(name, [{**fixed, **d} for d in draws], folds, features, label, seed, parallelism)
    best = max(range(len(draws)), key=lambda i: (scores[i], -i))
    return {"model": fit(name, train, features, label, {**fixed, **draws[best]}, seed),
            "params": draws[best], "cv_score": scores[best],
            "draws": [(i, draws[i], scores[i]) for i in range(len(draws))]}


# ------------------------------------------------------------------ M13 importance
def feature_importance(model: PipelineModel, features: list[str], top_n: int = 20) -> DataFrame:
    """Gini importances (trees) or |coefficient| (LR), top ``top_n``."""
    spark = SparkSession.getActiveSession()
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        vals, kind = last.featureImportances.toArray().tolist(), "gini"
    elif hasattr(last, "coefficients"):
        vals, kind = [abs(v) for v in last.coefficients.toArray().tolist()], "abs_coefficient"
    else:
        return spark.createDataFrame([], "feature string, importance double, kind string, rank int")
    df = spark.createDataFrame([(f, float(v), kind) for f, v in zip(features, vals)],
                               "feature string, importance double, kind string")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_n)
