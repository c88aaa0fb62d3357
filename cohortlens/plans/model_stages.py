"""Model stages over the encoded, split frame: fit, score, calibrate, explain.

``modeling_frame`` is the shared input: encoded features + ``split`` + ``fold``.
It is written once as a table under the shared checkpoint folder, so the several
fits that read it do not re-run binding, cleaning and encoding, and an
executor loss replays from the table rather than from the raw scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import models as MD
from cohortlens.operators.calibrate import CalibratedModel, calibrate
from cohortlens.operators.split import fold_column, stratified_split
from cohortlens.plans.build import build_feature_artifacts
from cohortlens.session import materialize
from cohortlens.spec import Spec


@dataclass
class ModelingFrame:
    frame: DataFrame
    features: list[str]
    spec: Spec
    artifacts: object = None      # FeatureArtifacts: fitted imputer and levels


def modeling_frame(raw: DataFrame, spec: Spec, checkpoint: bool = True) -> ModelingFrame:
    art = build_feature_artifacts(raw, spec)
    split = stratified_split(art.encoded, spec.target, seed=spec.seed, test_size=spec.test_size,
                             val_size=spec.val_size, stratify=spec.stratify)
    frame = fold_column(split, spec.cv_folds)
    if checkpoint:
        frame = materialize(frame, "table")           # fits and scoring read few of its columns at a time
    return ModelingFrame(frame, art.feature_columns, spec, art)


def params_for(name: str, spec: Spec) -> dict:
    return {"LogisticRegression": spec.lr_params, "RandomForest": spec.rf_params,
            "GradientBoosting": spec.gb_params}[name]


def fit_model(mf: ModelingFrame, name: str, params: dict | None = None):
    train = mf.frame.where(F.col("split") == "train")
    return MD.fit(name, train, mf.features, mf.spec.target,
                  params if params is not None else params_for(name, mf.spec), mf.spec.seed)


def score_splits(mf: ModelingFrame, model, name: str, splits=("val", "test")) -> DataFrame:
    rows = mf.frame.where(F.col("split").isin(*splits))
    return MD.score(model, rows, name, mf.spec.target)


def calibrated_model(mf: ModelingFrame, base, name: str) -> tuple[CalibratedModel, DataFrame]:
    val = mf.frame.where(F.col("split") == "val")
    return calibrate(base, val, mf.spec.target, mf.spec.calibration_methods,
                     mf.spec.calib_eval_size, mf.spec.seed, mf.features, name)


def calibrated_scores(mf: ModelingFrame, cal: CalibratedModel, splits=("val", "test")) -> DataFrame:
    rows = mf.frame.where(F.col("split").isin(*splits))
    return cal.transform(rows).select(F.lit(cal.name).alias("model"), "split", "row_id",
                                      F.col(mf.spec.target).cast("int").alias("label"), "score")


def binding_modeling_frame(spark: SparkSession, sf_dir: str, spec: Spec) -> ModelingFrame:
    from cohortlens.sources.binding import orders_patient_frame
    return modeling_frame(orders_patient_frame(spark, sf_dir), spec)
