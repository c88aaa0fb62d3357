"""Run parameters (the analogue of a project config), as one frozen dataclass.

Operators take a ``Spec``; nothing reads files or globals.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Spec:
    target: str = "readmitted"
    positive_value: str = "yes"
    negative_value: str = "no"
    drop_columns: tuple[str, ...] = ()
    required_columns: tuple[str, ...] = ()
    categorical_columns: tuple[str, ...] = ()
    # ordered bracket column -> ordinal
    ordinal_column: str = "age"
    ordinal_output: str = "age_ordinal"
    ordinal_map: tuple[tuple[str, int], ...] = ()
    prior_utilization_cols: tuple[str, ...] = ("n_inpatient", "n_emergency")
    utilization_sum_cols: tuple[str, ...] = ("n_outpatient", "n_inpatient", "n_emergency")
    utilization_total: str = "total_prior_utilization"
    sentinel_column: str = "medical_specialty"
    sentinel_value: str = "Missing"
    sentinel_flag: str = "specialty_known"
    interactions_enabled: bool = True
    interaction_terms: tuple[tuple[str, ...], ...] = ()
    # CSV null markers applied after reading (Spark keeps "NA" as text)
    null_markers: tuple[str, ...] = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "#N/A")
    # splits
    seed: int = 42
    test_size: float = 0.20
    val_size: float = 0.20
    stratify: bool = True
    cv_folds: int = 5
    calib_eval_size: float = 0.30
    # threshold analysis
    optimize_by: str = "recall"
    recall_target: float = 0.80
    sweep_min: float = 0.05
    sweep_max: float = 0.95
    sweep_step: float = 0.05
    calibration_methods: tuple[str, ...] = ("sigmoid", "isotonic")
    # encoding guard: more levels than this per column -> use the sparse encoder
    max_levels: int = 1000
    # models
    lr_params: dict = field(default_factory=dict)
    rf_params: dict = field(default_factory=dict)
    gb_params: dict = field(default_factory=dict)
    n_search_draws: int = 20

    @property
    def ordinal_dict(self) -> dict[str, int]:
        return dict(self.ordinal_map)

    def with_(self, **kw) -> "Spec":
        return replace(self, **kw)


# --- fixed values: the clinical table's configuration (must equal the source project's) ---
CLINICAL_REQUIRED = (
    "age", "time_in_hospital", "n_lab_procedures", "n_procedures", "n_medications",
    "n_outpatient", "n_inpatient", "n_emergency", "medical_specialty", "diag_1", "diag_2",
    "diag_3", "glucose_test", "A1Ctest", "change", "diabetes_med", "readmitted",
)
CLINICAL_CATEGORICALS = (
    "medical_specialty", "diag_1", "diag_2", "diag_3", "glucose_test", "A1Ctest", "change",
    "diabetes_med",
)
CLINICAL_AGE_BRACKETS = (
    ("[40-50)", 1), ("[50-60)", 2), ("[60-70)", 3), ("[70-80)", 4), ("[80-90)", 5),
    ("[90-100)", 6),
)
CLINICAL_INTERACTIONS = (("n_inpatient", "time_in_hospital"), ("n_medications", "time_in_hospital"))
LR_PARAMS = {"C": 1.0, "max_iter": 1000, "class_weight": "balanced", "penalty": "l2"}
RF_PARAMS = {"n_estimators": 200, "max_depth": None, "min_samples_leaf": 10,
             "class_weight": "balanced"}
GB_PARAMS = {"max_iter": 200, "learning_rate": 0.05, "max_depth": 5, "min_samples_leaf": 20,
             "class_weight": "balanced"}
EXPECTED_FEATURES = (
    "age_ordinal", "any_n_inpatient", "any_n_emergency", "total_prior_utilization",
    "specialty_known", "n_inpatient_x_time_in_hospital", "n_medications_x_time_in_hospital",
)
ATTRIBUTION_BACKGROUND = 100
PUBLISHED_THRESHOLD = 0.35
SEARCH_SPACES = {
    "LogisticRegression": {
        "classifier__C": [0.001, 0.01, 0.1, 0.5, 1.0, 5.0, 10.0],
        "classifier__penalty": ["l1", "l2"],
        "classifier__solver": ["liblinear", "saga"],
    },
    "RandomForest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [5, 10, 15, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [5, 10, 20],
    },
    "GradientBoosting": {
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "max_iter": [100, 150, 200, 300],
        "max_depth": [3, 4, 5, 6],
        "min_samples_leaf": [10, 20, 30, 50],
    },
}
# --- end fixed values ---


def clinical_spec() -> Spec:
    return Spec(
        required_columns=CLINICAL_REQUIRED,
        categorical_columns=CLINICAL_CATEGORICALS,
        ordinal_map=CLINICAL_AGE_BRACKETS,
        interaction_terms=CLINICAL_INTERACTIONS,
        lr_params=dict(LR_PARAMS), rf_params=dict(RF_PARAMS), gb_params=dict(GB_PARAMS),
    )


# The driver tables carry no patient table, so orders are bound to the same shape
# (see sources/binding.py). Order priorities play the ordered bracket and sentinel roles.
ORDER_PRIORITIES = (
    ("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5),
)


def orders_binding_spec() -> Spec:
    return clinical_spec().with_(
        target="readmitted",
        positive_value="F",
        negative_value="O",
        required_columns=(
            "age", "time_in_hospital", "n_medications", "n_outpatient", "n_inpatient",
            "n_emergency", "medical_specialty", "c_mktsegment", "n_name", "min_returnflag",
            "readmitted",
        ),
        categorical_columns=("medical_specialty", "c_mktsegment", "n_name", "min_returnflag"),
        ordinal_map=ORDER_PRIORITIES,
        sentinel_value="4-NOT SPECIFIED",
    )
