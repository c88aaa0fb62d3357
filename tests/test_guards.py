"""Hand-built edge frames (FIXTURES.md section 6): guards, null rules, ties."""

import math

import pytest
from pyspark.errors import PythonException  # noqa: F401
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import clean as C
from cohortlens.operators import encode as EN
from cohortlens.operators import errors as ER
from cohortlens.operators import features as FE
from cohortlens.operators import metrics as ME
from cohortlens.operators import quality as QA
from cohortlens.operators import threshold as TH
from cohortlens.spec import clinical_spec

SPEC = clinical_spec()


def _spark_error(fn):
    with pytest.raises(Exception) as ei:
        fn()
    return str(ei.value)


# ------------------------------------------------------------------ labels_messy
def test_label_normalisation_strips_tabs_and_case(spark):
    df = spark.createDataFrame([(1, " Yes"), (2, "NO\t"), (3, "yes\n")], "row_id long, readmitted string")
    out = {r[0]: r[1] for r in C.map_target(df, SPEC).collect()}
    assert out == {1: 1, 2: 0, 3: 1}


def test_unknown_and_null_labels_raise(spark):
    bad = spark.createDataFrame([(1, "yes"), (2, "maybe"), (3, "zzz"), (4, "no")],
                                "row_id long, readmitted string")
    report = C.check_target(bad, SPEC)
    assert (report.n_null, report.n_unknown, report.samples) == (0, 2, ("maybe", "zzz"))
    with pytest.raises(ValueError, match="2 unmapped.*maybe"):
        C.map_target(bad, SPEC, validate=True)
    msg = _spark_error(lambda: C.map_target(bad, SPEC).collect())
    assert "maybe" in msg or "zzz" in msg
    nul = spark.createDataFrame([(1, "yes"), (2, None)], "row_id long, readmitted string")
    with pytest.raises(ValueError, match="1 null"):
        C.map_target(nul, SPEC, validate=True)


def test_guards_survive_pruning(spark):
    """Unknown labels, brackets and residual nulls fail a job that reads other columns or none."""
    jobs = (lambda d: d.select("row_id").collect(), lambda d: d.count(), lambda d: d.drop("readmitted").agg(F.max("row_id")).collect())
    for kind, values in (("string", ("yes", "maybe")), ("string", ("no", None)), ("int", (1, 2)), ("double", (0.0, None))):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"row_id long, readmitted {kind}")
        for job in jobs:
            assert "readmitted is null or unmapped" in _spark_error(lambda: job(C.map_target(df, SPEC)))
    for v in ("zzz", None):
        df = spark.createDataFrame([(1, "[40-50)", 1), (2, v, 0)], "row_id long, age string, n_inpatient int")
        for job in (lambda d: d.select("any_n_inpatient").collect(), lambda d: d.count(), lambda d: d.select("row_id").count()):
            assert "age has no ordinal" in _spark_error(lambda: job(FE.create_features(df, SPEC)))


def test_residual_nulls_of_a_scoring_batch(spark):
    spec = SPEC.with_(required_columns=())
    kind = "row_id long, readmitted string, x double, cat string"
    train = spark.createDataFrame([(1, "yes", 5.0, "a"), (2, "no", None, "b"), (3, "no", 1.0, "b")], kind)
    _, fit = C.clean_data(train, spec, materialize_mode=None)
    assert set(fit.imputer.medians) == {"x"} and not fit.imputer.modes
    batch = spark.createDataFrame([(7, "yes", None, "a"), (8, "no", 2.0, None)], kind)
    out, _ = C.clean_data(batch, spec, imputer=fit.imputer, materialize_mode=None)
    for job in (lambda: out.count(), lambda: out.select("row_id").collect(), lambda: out.collect()):
        assert "missing values are left in cat" in _spark_error(job)
    fine, _ = C.clean_data(batch.where("row_id = 7"), spec, imputer=fit.imputer, materialize_mode=None)
    assert fine.first()["x"] == 3.0


def test_numeric_target_rules(spark):
    ok = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, readmitted int")
    assert [r[1] for r in C.map_target(ok, SPEC).orderBy("row_id").collect()] == [0, 1]
    two = spark.createDataFrame([(1, 0), (2, 2)], "row_id long, readmitted int")
    with pytest.raises(ValueError, match=r"1 unmapped.*\[2\]"):
        C.map_target(two, SPEC, validate=True)


def test_same_positive_and_negative_config_raises(spark):
    df = spark.createDataFrame([(1, "yes")], "row_id long, readmitted string")
    with pytest.raises(ValueError, match="two different labels"):
        C.map_target(df, SPEC.with_(negative_value=" YES"))


# ------------------------------------------------------------------ dupes
def test_dedupe_before_imputation(spark):
    rows = [
        (1, "yes", 5.0, "a"), (2, "yes", 5.0, "a"),     # exact copy -> removed
        (3, " YES", 7.0, "b"), (4, "yes", 7.0, "b"),    # copies only after label mapping
        (5, "no", None, "c"), (6, "no", 3.0, "c"),      # copies only after imputation: kept
        (7, "no", 3.0, "d"),
    ]
    df = spark.createDataFrame(rows, "row_id long, readmitted string, x double, cat string")
    spec = SPEC.with_(required_columns=())
    out, fit = C.clean_data(df, spec, materialize_mode=None)
    ids = sorted(r[0] for r in out.select("row_id").collect())
    assert ids == [1, 3, 5, 6, 7]
    assert fit.imputer.medians == {"x": 4.0}        # median of 5, 7, 3, 3 (deduped)


# ------------------------------------------------------------------ nulls
def test_median_mode_rules(spark):
    rows = [(1, "yes", 1, None, "p", None), (2, "no", 2, 4.0, "q", None),
            (3, "yes", None, float("nan"), "q", None), (4, "no", 4, 8.0, None, None),
            (5, "no", 3, 6.0, "p", None)]
    df = spark.createDataFrame(rows, "row_id long, readmitted string, odd int, even double, "
                                     "tie string, allnull string")
    spec = SPEC.with_(required_columns=())
    with pytest.raises(ValueError, match="without any value"):
        C.clean_data(df, spec, materialize_mode=None)
    out, fit = C.clean_data(df.drop("allnull"), spec, materialize_mode=None)
    assert fit.imputer.medians == {"odd": 2.5, "even": 6.0}   # NaN counts as missing
    assert fit.imputer.modes == {"tie": "p"}                  # tie p/q -> lowest
    assert dict(out.dtypes)["odd"] == "double"                # imputed ints widen
    assert out.agg(C.residual_null_count(out)).first()[0] == 0


# ------------------------------------------------------------------ brackets
def test_unknown_or_null_bracket_raises(spark):
    for v in ("[10-20)", None):
        df = spark.createDataFrame([(1, "[40-50)"), (2, v)], "row_id long, age string")
        msg = _spark_error(lambda: FE.create_features(df, SPEC).collect())
        assert "age has no ordinal" in msg
    ok = spark.createDataFrame([(1, "[90-100)")], "row_id long, age string")
    assert FE.create_features(ok, SPEC).first()["age_ordinal"] == 6


def test_feature_null_semantics(spark):
    df = spark.createDataFrame(
        [(1, "[40-50)", None, 2, None, "Missing", 3), (2, "[50-60)", 1, 0, 0, None, None)],
        "row_id long, age string, n_inpatient int, n_emergency int, n_outpatient int, "
        "medical_specialty string, time_in_hospital int")
    r = {x["row_id"]: x for x in FE.create_features(df, SPEC).collect()}
    assert r[1]["any_n_inpatient"] == 0 and r[1]["total_prior_utilization"] == 2
    assert r[1]["specialty_known"] == 0 and r[2]["specialty_known"] == 1   # null != Missing
    assert r[1]["n_inpatient_x_time_in_hospital"] is None


# ------------------------------------------------------------------ score_batch / one_level
def test_encoding_independent_of_batch_composition(spark):
    train = spark.createDataFrame([(1, "yes", "a"), (2, "no", "b"), (3, "no", "c")],
                                  "row_id long, diabetes_med string, other string")
    lv = EN.fit_levels(train, ["diabetes_med"], "readmitted")
    batch = spark.createDataFrame([(9, "yes", "zzz")], "row_id long, diabetes_med string, other string")
    enc = EN.encode_features(batch, lv, "readmitted")
    row = enc.first()
    assert row["diabetes_med_yes"] == 1                    # not dropped by the batch
    assert row["other_b"] == 0 and row["other_c"] == 0      # unseen -> reference level
    expected = lv.feature_names() + ["missing_col"]
    aligned = EN.align_columns(enc, expected)
    assert aligned.columns == ["row_id"] + expected and aligned.first()["missing_col"] == 0


def test_one_level_column_fails_encoding_check(spark):
    df = spark.createDataFrame([(1, "x", 1), (2, "x", 0)], "row_id long, change string, readmitted int")
    lv = EN.fit_levels(df, ["change"], "readmitted")
    enc = EN.encode_features(df, lv, "readmitted")
    rows = {r["name"]: r["passed"] for r in
            QA.encoding_checks(spark, enc, ["change"], "readmitted").collect()}
    assert rows["configured_categoricals_encoded"] == 0


def test_many_levels_become_sparse_vectors(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.format_string("v%06d", F.col("id") % (n - 7)).alias("wide"),
                               F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("few"))
    lv = EN.fit_levels(df, ["wide", "few"], "readmitted", max_levels=1000)
    assert lv.columns == ["few"] and lv.sparse.sizes == {"wide": n - 7} and lv.feature_names() == ["few_b", "wide__onehot"]
    batch = spark.createDataFrame([(1, "v000000", "b"), (2, "v000001", "a"), (3, "v099992", None), (4, "unseen", "zzz"), (5, None, "b")],
                                  "row_id long, wide string, few string")
    got = {r["row_id"]: (r["wide__onehot"], r["few_b"]) for r in EN.encode_features(batch, lv, "readmitted").collect()}
    assert {k: (v.size, v.indices.tolist(), v.values.tolist(), f) for k, (v, f) in got.items()} == {
        1: (n - 8, [], [], 1), 2: (n - 8, [0], [1.0], 0), 3: (n - 8, [n - 9], [1.0], 0), 4: (n - 8, [], [], 0), 5: (n - 8, [], [], 1)}
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=lv.feature_names(), outputCol="f").transform(EN.encode_features(batch, lv, "readmitted"))
    assert v.first()["f"].size == n - 7
    seen = EN.unseen_levels(batch, lv.as_dataframe(spark), ["wide", "few"], small=False)
    assert sorted(tuple(r) for r in seen.collect()) == [("few", "zzz"), ("wide", "unseen")]


def test_running_totals_equal_plain_windows(spark):
    from cohortlens.functions.ranges import running_totals
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.col("id").cast("string")).alias("g"),
                                  (F.col("id") * 7919 % 5003).alias("o"), (F.col("id") % 13).alias("x"))
    w = Window.partitionBy("g").orderBy(F.desc("o"))
    want = {r["id"]: (r["n"], r["s"]) for r in df.select("id", F.row_number().over(w).alias("n"), F.sum("x").over(w).alias("s")).collect()}
    got = running_totals(df, ["g"], [F.col("o").desc()], {"n": F.lit(1), "s": F.col("x")})
    assert {r["id"]: (r["n"], r["s"]) for r in got.collect()} == want
    out = running_totals(df, ["g"], [F.col("o").desc()], {"n": F.lit(1), "s": F.col("x")}, inclusive=False)
    assert {r["id"]: (r["n"] + 1, r["s"] + r["x"]) for r in out.collect()} == want
    assert running_totals(df.where("1 = 0"), ["g"], [F.col("o").asc()], {"n": F.lit(1)}).count() == 0


# ------------------------------------------------------------------ scores_ties
def _scored(spark, pairs, model="m", split="val"):
    return spark.createDataFrame([(model, split, i, y, s) for i, (y, s) in enumerate(pairs)],
                                 "model string, split string, row_id long, label int, score double")


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def _brute_ap(pairs):
    P = sum(y for y, _ in pairs)
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_auc_and_ap_with_ties_match_brute_force(spark):
    import random
    rng = random.Random(7)
    pairs = [(rng.randint(0, 1), rng.choice([0.0, 0.1, 0.5, 0.5, 1.0, 0.3, 0.7])) for _ in range(300)]
    r = ME.ranking_metrics(_scored(spark, pairs)).first()
    assert math.isclose(r["roc_auc"], _brute_auc(pairs), abs_tol=1e-12)
    assert math.isclose(r["pr_auc"], _brute_ap(pairs), abs_tol=1e-12)


def test_reliability_edges_go_left(spark):
    pairs = [(1, 0.0), (0, 0.1), (1, 0.5), (1, 1.0), (0, 0.15)]
    bins = {r["bin"]: r["n"] for r in ME.reliability_curve(_scored(spark, pairs)).collect()}
    assert bins == {0: 2, 1: 1, 4: 1, 9: 1}


# ------------------------------------------------------------------ published known answer
def test_published_confusion_counts_give_published_metrics(spark):
    pairs = [(1, 0.9)] * 2061 + [(1, 0.1)] * 290 + [(0, 0.1)] * 684 + [(0, 0.9)] * 1965
    m = ME.threshold_metrics(_scored(spark, pairs), 0.35).first()
    assert (m["tp"], m["fn"], m["tn"], m["fp"]) == (2061, 290, 684, 1965)
    assert round(m["precision"], 4) == 0.5119
    assert round(m["recall"], 4) == 0.8766
    assert round(m["specificity"], 4) == 0.2582
    assert round(m["f1"], 4) == 0.6464


# ------------------------------------------------------------------ sweep_hard
def test_sweep_falls_back_to_max_f1_and_breaks_ties_low(spark):
    pairs = [(1, 0.02), (0, 0.97), (1, 0.5), (0, 0.6)]
    sw = TH.threshold_sweep(_scored(spark, pairs))
    assert sw.count() == 19
    ch = TH.choose_threshold(sw, "recall", 0.99).first()
    assert ch["rule"] == "max_f1"
    best = max(r["f1"] for r in sw.collect())
    lowest = min(r["threshold"] for r in sw.collect() if r["f1"] == best)
    assert ch["threshold"] == lowest


def test_sweep_matches_per_threshold_counts(spark):
    import random
    rng = random.Random(3)
    pairs = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(200)]
    sw = {r["threshold"]: r for r in TH.threshold_sweep(_scored(spark, pairs)).collect()}
    for t in TH.threshold_grid():
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y == 0)
        assert math.isclose(sw[round(t, 3)]["precision"], tp / (tp + fp) if tp + fp else 0.0)


# ------------------------------------------------------------------ groups_empty
def test_all_four_groups_listed_when_one_is_empty(spark):
    pairs = [(1, 0.9), (0, 0.1), (0, 0.8)]
    g = ER.with_groups(_scored(spark, pairs), 0.5).withColumn("x", F.lit(1.0))
    sizes = {r["group"]: r["n"] for r in ER.group_sizes(g).collect()}
    assert sizes == {"TP": 1, "TN": 1, "FP": 1, "FN": 0}
    means = {r["group"]: r["mean_x"] for r in ER.group_means(g, ["x"]).collect()}
    assert means["FN"] is None and means["TP"] == 1.0


# ------------------------------------------------------------------ sources
def test_manifest_read_tolerates_absent_and_malformed(spark, tmp_path):
    from cohortlens.sources import manifest as MF
    assert MF.read_manifest(spark, str(tmp_path / "absent")) is None
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.json").write_text("{not json\n")
    assert MF.read_manifest(spark, str(bad)) is None
    assert MF.freshness_reasons(None, {}, outputs_exist=False) == [
        "outputs missing", "manifest missing or unparsable"]


def test_csv_scan_missing_path_raises_and_markers_become_null(spark, tmp_path):
    from pyspark.errors import AnalysisException
    from cohortlens.sources import csv as CSV
    with pytest.raises(AnalysisException):
        CSV.read_csv(spark, str(tmp_path / "nope.csv"), "a string").collect()
    p = tmp_path / "t.csv"
    p.write_text("a,b\nNA,1\nMissing,2\n,3\n")
    rows = CSV.read_csv(spark, str(p), "a string, b int").orderBy("b").collect()
    assert [r["a"] for r in rows] == [None, "Missing", None]


def test_assign_row_id_is_consecutive(spark):
    from cohortlens.sources.tables import assign_row_id, read_table
    from tests.conftest import SMOKE
    df = read_table(spark, SMOKE, "part").repartition(5)
    out = assign_row_id(df)
    ids = sorted(r[0] for r in out.select("row_id").collect())
    assert ids == list(range(df.count()))
    assert out.columns[0] == "row_id" and out.columns[1:] == df.columns


def test_csv_scan_assigns_row_ids(spark, tmp_path):
    from cohortlens.sources import csv as CSV
    p = tmp_path / "k.csv"
    p.write_text("a,b\nx,1\ny,2\nz,3\n")
    df = CSV.read_csv(spark, str(p), "a string, b int", key="row_id")
    assert sorted((r["row_id"], r["a"]) for r in df.collect()) == [(0, "x"), (1, "y"), (2, "z")]


def test_manifest_schema_not_mutated_by_reads(spark, tmp_path):
    from cohortlens.sources import manifest as MF
    n = len(MF.MANIFEST_SCHEMA.fields)
    MF.read_manifest(spark, str(tmp_path / "absent"))
    MF.read_manifest(spark, str(tmp_path / "absent2"))
    assert len(MF.MANIFEST_SCHEMA.fields) == n


def test_wide_profile_aggregates_are_chunked(spark, monkeypatch):
    from cohortlens.operators import profile as PR
    monkeypatch.setattr(PR, "MAX_AGG_EXPRESSIONS", 4)
    df = spark.createDataFrame([(1, 2.0, None, 4), (2, 3.0, 1.0, 5), (3, 5.0, 2.0, 5)],
                               "a int, b double, c double, d int")
    pairs = {(r["col_a"], r["col_b"]) for r in PR.correlation_pairs(df, ["a", "b", "c", "d"]).collect()}
    assert len(pairs) == 6
    nulls = {r["column"]: r["n_missing"] for r in PR.null_profile(df).collect()}
    assert nulls == {"c": 1}
    assert PR.describe_numeric(df, ["a", "b", "c", "d"]).count() == 4


def test_one_class_group_gives_null_auc_not_an_error(spark):
    one = _scored(spark, [(1, 0.2), (1, 0.9)], split="tiny")
    both = _scored(spark, [(1, 0.9), (0, 0.1)], split="val")
    rows = {r["split"]: r for r in ME.ranking_metrics(one.unionByName(both)).collect()}
    assert rows["tiny"]["roc_auc"] is None and rows["val"]["roc_auc"] == 1.0
    zero_var = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    from cohortlens.operators import profile as PR
    assert PR.correlation_pairs(zero_var, ["a", "b"]).first()["r"] is None


def test_target_check_counts_text_and_fractions(spark):
    txt = spark.createDataFrame([(1, "1"), (2, "yes"), (3, "0")], "row_id long, y string")
    assert QA.target_check(txt, "y").first()["passed"] == 0
    frac = spark.createDataFrame([(1, 0.5), (2, 1.0)], "row_id long, y double")
    r = QA.target_check(frac, "y").first()
    assert r["passed"] == 0 and "no integers" in r["detail"]
    ok = spark.createDataFrame([(1, 0), (2, 1)], "row_id long, y int")
    assert QA.target_check(ok, "y").first()["detail"].endswith("share of 1: 0.500")


@pytest.mark.parametrize("n", [1, 2, 5, 40_000])
def test_exact_quantiles_equal_numpy(spark, n):
    import numpy as np

    from cohortlens.functions.quantile import exact_quantiles
    rng = np.random.default_rng(n)
    smooth, hot = rng.normal(size=n), np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 900, n))
    rows = [(float(a), float(b), None) for a, b in zip(smooth, hot)] + [(None, float("nan"), None)]
    df = spark.createDataFrame(rows, "smooth double, hot double, none double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["smooth", "hot", "none"], probs)
    assert got["smooth"] == pytest.approx(np.quantile(smooth, probs).tolist())
    assert got["hot"] == pytest.approx(np.quantile(hot, probs).tolist())
    assert got["none"] == [None] * 5


def test_exact_quantiles_have_no_size_switch(spark):
    from cohortlens.functions.quantile import exact_quantiles
    n = 1_200_001                                   # more distinct values than any former switch
    df = spark.range(n).select((F.col("id") * 2).alias("v"))
    assert exact_quantiles(df, ["v"], [0.5, 1 / 3])["v"] == pytest.approx([n - 1, 2 * (n - 1) / 3])


def test_nulls_that_no_rule_fills_are_refused(spark):
    from cohortlens.operators import clean as C
    from cohortlens.spec import orders_binding_spec
    spec = orders_binding_spec().with_(required_columns=("x",), drop_columns=())
    df = spark.createDataFrame([(1, 1.0, True, "F"), (2, 2.0, None, "O")], f"row_id long, x double, flag boolean, {spec.target} string")
    with pytest.raises(ValueError, match="flag"):
        C.clean_data(df, spec)


def test_null_scores_are_refused(spark):
    from cohortlens.operators.metrics import ranking_metrics
    frame = spark.createDataFrame([("m", "val", 1, 0.4), ("m", "val", 0, None)], "model string, split string, label int, score double")
    assert "a score is null" in _spark_error(lambda: ranking_metrics(frame).collect())


def test_rare_event_scores_spread_over_buckets(spark):
    from pyspark.sql import functions as F

    from cohortlens.functions.rank import score_bucket_desc
    scores = spark.range(1, 100_001).select((F.col("id") / 2e9).alias("s")).select("s", score_bucket_desc(F.col("s")).alias("b"))
    assert scores.select("b").distinct().count() > 1000
    ends = spark.createDataFrame([(x,) for x in (0.0, 1e-30, 1e-6, 0.3, 0.5, 0.7, 1 - 1e-9, 1.0)], "s double")
    got = [r.b for r in ends.orderBy("s").select(score_bucket_desc(F.col("s")).alias("b")).collect()]
    assert got == sorted(got, reverse=True)


def test_orders_of_every_status_are_bound(spark):
    from cohortlens.sources.binding import orders_patient_frame
    from tests.conftest import SMOKE
    got = orders_patient_frame(spark, SMOKE)
    assert got.count() == spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    assert {r.readmitted for r in got.select("readmitted").distinct().collect()} == {"F", "O"}


def test_order_stream_reads_folders_of_part_files(spark, tmp_path):
    from cohortlens.streaming.scoring import order_stream, run_to_table
    from tests.conftest import SMOKE
    for t in ("orders", "lineitem", "customer", "nation"):
        spark.read.parquet(f"{SMOKE}/{t}.parquet").repartition(2).write.parquet(str(tmp_path / f"{t}.parquet"))
    got = run_to_table(order_stream(spark, str(tmp_path)), "folder")
    assert got.count() == spark.read.parquet(f"{SMOKE}/orders.parquet").count()


def test_quartiles_by_group_equal_numpy_nulls_included(spark):
    import numpy as np

    from cohortlens.functions.quantile import group_key, quartiles_by
    rows = [("a", i % 3 or None, float((i * 7919) % 1013)) for i in range(3000)] + [("b", None, None)]
    long = spark.createDataFrame(rows, "c string, t int, v double")
    got = {r["k"]: r["q"] for r in long.select("c", "t", group_key(["c", "t"]).alias("k")).distinct()
           .join(quartiles_by(long, ["c", "t"], "v").withColumnRenamed("__key", "k"), "k").collect()}
    assert len(got) == 3
    for k, t in (('{"c":"a","t":1}', 1), ('{"c":"a","t":2}', 2), ('{"c":"a"}', None)):
        assert np.allclose(got[k], np.percentile([v for c, x, v in rows if c == "a" and x == t], [25, 50, 75]))


def test_feature_table_without_row_id(spark, tmp_path):
    from cohortlens.sources.artifacts import load_features, write_table
    df = spark.createDataFrame([(0.5, 1, 0), (1.5, 2, 1), (2.5, 3, 0)], "`a b` double, leak int, y int").coalesce(1)
    out, names = load_features(spark, write_table(df, str(tmp_path / "t")), "y", exclude=("leak", "absent"))
    assert names == ["a_b"] and out.columns == ["row_id", "a_b", "y"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0.5, 0), (1, 1.5, 1), (2, 2.5, 0)]
    with pytest.raises(KeyError, match="no column z"):
        load_features(spark, str(tmp_path / "t"), "z")
    clash = spark.createDataFrame([(1, 2, 0)], "`a b` int, a_b int, y int")
    with pytest.raises(ValueError, match="differ only in spaces"):
        load_features(spark, write_table(clash, str(tmp_path / "u")), "y")
