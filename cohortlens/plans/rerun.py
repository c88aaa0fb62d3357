"""Full rerun: the end-to-end report run as one Spark program.

build features -> persist artifacts + manifest -> split/folds -> baseline CV,
fit, evaluate, compare -> tune every family, take the best -> calibrate -> threshold
sweep/choice -> final val/test metrics -> save model -> attribution and
error profiles. Every result is a DataFrame written as a table under
``out_dir`` (default: the shared checkpoint folder); the driver only ever
holds fitted models and small decision values (best name, threshold).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import attribution as XA
from cohortlens.operators import errors as ER
from cohortlens.operators import metrics as ME
from cohortlens.operators import models as MD
from cohortlens.operators import threshold as TH
from cohortlens.operators.align import lookup
from cohortlens.plans import model_stages as PM
from cohortlens.session import materialize
from cohortlens.sources.artifacts import artifact_dir, write_table
from cohortlens.sources.manifest import build_manifest, write_manifest
from cohortlens.spec import SEARCH_SPACES, Spec


@dataclass
class RerunResult:
    out_dir: str
    tables: dict[str, str] = field(default_factory=dict)
    best_model: str = ""
    threshold: float = 0.5
    calibration_method: str = ""


def run_all(raw: DataFrame, spec: Spec, out_dir: str | None = None,
            models=("LogisticRegression", "RandomForest", "GradientBoosting"),
            cross_validate: bool = True, tune: bool = True, explain: bool = True,
            source_paths: list[str] | None = None, shap_rows: int | None = None,
            shap_background: int = 100, shap_permutations: int = 10,
            spaces: dict | None = None, early_stop: MD.EarlyStop = MD.EarlyStop()) -> RerunResult:
    """The report run. With ``tune`` every family is searched over ``spaces`` and the best tuned one is taken."""
    spark = raw.sparkSession
    spaces = SEARCH_SPACES if spaces is None else spaces
    fixed = {"GradientBoosting": {"early_stop": early_stop}}
    res = RerunResult(out_dir or artifact_dir(spark, "rerun"))

    def save(name: str, df: DataFrame) -> DataFrame:
        res.tables[name] = write_table(df, f"{res.out_dir}/{name}")
        return df

    # ---- features, artifacts, manifest, split
    mf = PM.modeling_frame(raw, spec)
    art = mf.artifacts
    save("encoded", mf.frame.drop("fold"))
    save("analysis", art.analysis)
    if source_paths:
        manifest = build_manifest(spark, spec, source_paths, art.encoded, art.analysis,
                                  mf.features, art.levels.levels)
        write_manifest(manifest, f"{res.out_dir}/manifest")
        res.tables["manifest"] = f"{res.out_dir}/manifest"
    train = mf.frame.where(F.col("split") == "train")

    # ---- baselines: CV, fit, evaluate on validation, compare
    fitted, scored_parts, cv_parts = {}, [], []
    for name in models:
        params = {**PM.params_for(name, spec), **fixed.get(name, {})}
        if cross_validate:
            cv_parts.append(MD.cross_validate(name, train, mf.features, spec.target, params,
                                              "fold", spec.cv_folds, spec.seed, parallelism=4))
        fitted[name] = PM.fit_model(mf, name, params)
        scored_parts.append(PM.score_splits(mf, fitted[name], name, ("val",)))
    if cv_parts:
        cv = cv_parts[0]
        for p in cv_parts[1:]:
            cv = cv.unionByName(p)
        save("cv_summary", MD.cv_summary(cv))
    scored = scored_parts[0]
    for p in scored_parts[1:]:
        scored = scored.unionByName(p)
    baseline = materialize(ME.evaluate(scored, 0.5), "table")
    save("metrics_baseline", ME.compare_models(baseline, "val"))
    res.best_model = ME.best_model(baseline, "roc_auc", "val").first()["best_model"]

    # ---- tuning, calibration, threshold
    candidates = fitted
    if tune:
        folds = MD.fold_frames(train, mf.features, spec.target, spec.cv_folds)
        found = {name: MD.random_search(name, train, mf.features, spec.target, spaces, spec.n_search_draws, spec.cv_folds,
                                        spec.seed, fixed=fixed.get(name), folds=folds) for name in models}
        candidates = {name: f["model"] for name, f in found.items()}
        save("search", spark.createDataFrame(
            [(name, i, json.dumps(p, sort_keys=True), sc, int(p == f["params"])) for name, f in found.items() for i, p, sc in f["draws"]],
            "model string, draw int, params string, cv_roc_auc double, chosen int"))
        parts = [PM.score_splits(mf, m, name, ("val",)) for name, m in candidates.items()]
        tuned_metrics = materialize(ME.evaluate(reduce(DataFrame.unionByName, parts), 0.5), "table")
        save("metrics_search", ME.compare_models(tuned_metrics, "val"))
        res.best_model = ME.best_model(tuned_metrics, "roc_auc", "val").first()["best_model"]
    tuned = candidates[res.best_model]
    calibrated, cal_table = PM.calibrated_model(mf, tuned, res.best_model)
    save("calibration", cal_table)
    res.calibration_method = calibrated.method
    val_cal = materialize(PM.calibrated_scores(mf, calibrated, ("val",)), "table")
    sweep = save("threshold_sweep", TH.threshold_sweep(
        val_cal, TH.threshold_grid(spec.sweep_min, spec.sweep_max, spec.sweep_step)))
    res.threshold = float(TH.choose_threshold(sweep, spec.optimize_by,
                                              spec.recall_target).first()["threshold"])
    calibrated.threshold = res.threshold
    final = PM.calibrated_scores(mf, calibrated, ("val", "test"))
    at_end = materialize(ME.split_comparison(final, res.threshold), "table")
    save("metrics_tuned", at_end)
    # one row per split, stored beside the model
    calibrated.metrics = {r["split"]: {k: v for k, v in r.asDict().items() if isinstance(v, float)} for r in at_end.collect()}
    calibrated.save(f"{res.out_dir}/model")
    res.tables["model"] = f"{res.out_dir}/model"

    # ---- explanation and error analysis
    if explain:
        val = mf.frame.where(F.col("split") == "val")
        phi, _ = XA.explain(calibrated, val, mf.features, shap_rows, shap_background,
                            shap_permutations, spec.seed)
        phi = save("attribution", materialize(phi, "table"))
        save("attribution_importance", XA.global_importance(phi, 20))
    grouped = lookup(ER.with_groups(val_cal, res.threshold).select("row_id", "group"),
                     art.analysis)
    numeric = [c for c, t in art.analysis.dtypes
               if c != "row_id" and t in ("int", "bigint", "double", "tinyint", "smallint")]
    save("error_groups", ER.group_sizes(grouped))
    save("error_group_means", ER.group_means(grouped, numeric))
    save("error_fp_fn_profile", ER.fp_fn_profile(grouped, numeric))
    return res
