"""Feature artifact build: load -> clean -> features -> (analysis, encoded).

The three frames share ``row_id`` and stay lazy; the only actions are the
bounded fits (target check, null counts, medians/modes, levels).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortlens.operators.clean import CleanFit, clean_data
from cohortlens.operators.encode import Levels, encode_features, fit_levels
from cohortlens.operators.features import create_features
from cohortlens.spec import Spec


@dataclass
class FeatureArtifacts:
    clean: DataFrame
    analysis: DataFrame
    encoded: DataFrame
    feature_columns: list[str]
    levels: Levels
    fit: CleanFit


def build_features(raw: DataFrame, spec: Spec) -> tuple[DataFrame, CleanFit]:
    """Clean then create features (the frame before encoding, target kept)."""
    clean, fit = clean_data(raw, spec)
    return create_features(clean, spec), fit


def build_feature_artifacts(raw: DataFrame, spec: Spec, levels: Levels | None = None,
                            expected: list[str] | None = None) -> FeatureArtifacts:
    clean, fit = clean_data(raw, spec)
    feats = create_features(clean, spec)
    analysis = feats.drop(spec.target)
    levels = levels or fit_levels(feats, spec.categorical_columns, spec.target,
                                  spec.max_levels)
    encoded = encode_features(feats, levels, spec.target, expected)
    feature_columns = [c for c in encoded.columns if c not in (spec.target, "row_id")]
    return FeatureArtifacts(clean, analysis, encoded, feature_columns, levels, fit)
