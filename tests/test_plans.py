"""End-to-end plans on the smoke tables: validation run and full rerun."""

from pyspark.sql import functions as F

from cohortlens.operators.calibrate import CalibratedModel
from cohortlens.operators.models import EarlyStop
from cohortlens.plans.rerun import run_all
from cohortlens.plans.validation import run_validation
from cohortlens.sources.binding import orders_patient_frame
from cohortlens.sources.tables import table_path
from cohortlens.spec import orders_binding_spec
from tests.conftest import SMOKE

SPEC = orders_binding_spec()


def test_validation_run(spark):
    res = run_validation(orders_patient_frame(spark, SMOKE), SPEC)
    statuses = {r["status"]: r["n"] for r in res.summary.collect()}
    assert res.checks.count() == sum(statuses.values()) == 17
    assert set(res.required_failures) <= {"duplicates_removed"}   # imputation may create copies


def test_full_rerun(spark):
    light = SPEC.with_(rf_params={"n_estimators": 10, "max_depth": 5, "min_samples_leaf": 10},
                       gb_params={"max_iter": 10, "max_depth": 3, "min_samples_leaf": 20},
                       n_search_draws=2, cv_folds=2)
    res = run_all(orders_patient_frame(spark, SMOKE), light,
                  source_paths=[table_path(SMOKE, t) for t in ("orders", "lineitem")],
                  shap_rows=20, shap_background=5, shap_permutations=2, early_stop=EarlyStop(enabled=True, patience=2, first_run=4),
                  spaces={"LogisticRegression": {"C": [0.1, 1.0]}, "RandomForest": {"n_estimators": [8], "max_depth": [3, 5]},
                          "GradientBoosting": {"max_iter": [8], "max_depth": [2]}})
    assert res.best_model in ("LogisticRegression", "RandomForest", "GradientBoosting")
    assert 0.05 <= res.threshold <= 0.95 and res.calibration_method in ("sigmoid", "isotonic")
    for name in ("encoded", "metrics_baseline", "threshold_sweep", "metrics_tuned",
                 "attribution_importance", "error_groups", "error_group_means"):
        assert spark.read.parquet(res.tables[name]).count() > 0, name
    assert spark.read.parquet(res.tables["threshold_sweep"]).count() == 19
    search = spark.read.parquet(res.tables["search"]).collect()
    assert sorted((r["model"], r["chosen"]) for r in search) == [
        ("GradientBoosting", 1), ("LogisticRegression", 0), ("LogisticRegression", 1), ("RandomForest", 0), ("RandomForest", 1)]
    ranked = spark.read.parquet(res.tables["metrics_search"]).collect()
    assert len(ranked) == 3 and max(ranked, key=lambda r: r["roc_auc"])["roc_auc"] == next(r["roc_auc"] for r in ranked if r["model"] == res.best_model)
    tuned = spark.read.parquet(res.tables["metrics_tuned"])
    assert sorted(r["split"] for r in tuned.collect()) == ["test", "val"]
    saved = CalibratedModel.load(res.tables["model"])
    assert set(saved.metrics) == {"val", "test"} and saved.threshold == res.threshold
    assert 0 <= saved.metrics["test"]["roc_auc"] <= 1
    assert spark.read.parquet(res.tables["error_groups"]).agg(F.sum("n")).first()[0] > 0


def test_search_of_all_families_is_the_configured_one(spark, monkeypatch):
    """M8's query draws as often as configured from the configured grids, over all folds."""
    from cohortlens.operators import models as MD
    from cohortlens.plans import registry as RG
    from cohortlens.spec import SEARCH_SPACES
    asked = []

    def scores(name, draws, folds, features, label, seed=42, parallelism=4):
        asked.append((name, draws, len(folds)))
        return [0.5 + i / 100 for i in range(len(draws))]

    monkeypatch.setattr(MD, "search_scores", scores)
    monkeypatch.setattr(MD, "fit", lambda *a, **k: None)
    rows = RG.REGISTRY["M8_search_all_families"](spark, SMOKE).collect()
    assert [(n, len(d), k) for n, d, k in asked] == [("LogisticRegression", 14, 5), ("RandomForest", 20, 5), ("GradientBoosting", 20, 5)]
    assert all(d in MD.search_space(n, SEARCH_SPACES) for n, draws, _ in asked for d in draws)
    assert len(rows) == 54 and sum(r["chosen"] for r in rows) == 3
