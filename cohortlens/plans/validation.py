"""Validation run: build the artifacts once, run every quality check, fail on
any non-warning failure. One result DataFrame plus a status summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.quality import check_summary, run_checks
from cohortlens.plans.build import build_feature_artifacts
from cohortlens.session import materialize
from cohortlens.spec import Spec


@dataclass
class ValidationResult:
    checks: DataFrame
    summary: DataFrame
    required_failures: list[str]
    warnings: list[str]

    @property
    def ok(self) -> bool:
        return not self.required_failures


def run_validation(raw: DataFrame, spec: Spec, raise_on_failure: bool = False) -> ValidationResult:
    art = build_feature_artifacts(raw, spec)
    checks = materialize(run_checks(raw, art.clean, art.analysis, art.encoded,
                                    spec.required_columns, spec.categorical_columns, spec.target))
    failed = checks.where(F.col("passed") == 0).select("name", "severity").collect()
    required = [r["name"] for r in failed if r["severity"] != "warning"]
    warnings = [r["name"] for r in failed if r["severity"] == "warning"]
    result = ValidationResult(checks, check_summary(checks), required, warnings)
    if raise_on_failure and required:
        raise ValueError(f"required checks failed: {required}")
    return result
