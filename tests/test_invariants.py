"""Invariants for splits, models, calibration, attribution and streaming."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import attribution as XA
from cohortlens.operators import tree_paths as TP
from cohortlens.operators import calibrate as CA
from cohortlens.operators import metrics as ME
from cohortlens.operators import models as MD
from cohortlens.operators import split as SP
from tests.conftest import SMOKE


@pytest.fixture(scope="module")
def planted(spark):
    """Known logistic signal: P(y=1) = sigmoid(2*x1 - x2 + 0.5*c)."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        x1, x2, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.randint(0, 1)
        p = 1 / (1 + math.exp(-(2 * x1 - x2 + 0.5 * c)))
        rows.append((i, x1, x2, c, int(rng.random() < p)))
    df = spark.createDataFrame(rows, "row_id long, x1 double, x2 double, c int, y int")
    split = SP.fold_column(SP.stratified_split(df, "y", seed=42), 5)
    return split.cache()


FEATS = ["x1", "x2", "c"]


def test_split_sizes_exact_per_class(planted):
    n = planted.count()
    sizes = {r["split"]: r["n"] for r in planted.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert (sizes["train"], sizes["val"], sizes["test"]) == SP.expected_sizes(n)
    by = {(r["split"], r["y"]): r["n"] for r in
          planted.groupBy("split", "y").agg(F.count("*").alias("n")).collect()}
    for cls in (0, 1):
        n_c = sum(v for (s, y), v in by.items() if y == cls)
        assert abs(by[("test", cls)] - 0.2 * n_c) < 1.0 + 1e-9


def test_folds_disjoint_and_balanced(planted):
    folds = planted.where(F.col("split") == "train").groupBy("fold").agg(
        F.count("*").alias("n"), F.countDistinct("row_id").alias("d")).collect()
    assert len(folds) == 5 and all(r["n"] == r["d"] for r in folds)
    assert max(r["n"] for r in folds) - min(r["n"] for r in folds) <= 2


def test_split_is_reproducible(spark, planted):
    again = SP.stratified_split(planted.select("row_id", "x1", "x2", "c", "y"), "y", seed=42)
    a = {r[0]: r[1] for r in planted.select("row_id", "split").collect()}
    b = {r[0]: r[1] for r in again.select("row_id", "split").collect()}
    assert a == b


def test_models_learn_planted_signal(planted):
    train = planted.where(F.col("split") == "train")
    val = planted.where(F.col("split") == "val")
    for name, params in (("LogisticRegression", {"C": 1.0}),
                         ("RandomForest", {"n_estimators": 20, "max_depth": 5}),
                         ("GradientBoosting", {"max_iter": 20, "max_depth": 3})):
        model = MD.fit(name, train, FEATS, "y", params)
        auc = ME.ranking_metrics(MD.score(model, val, name, "y")).first()["roc_auc"]
        assert auc > 0.7, (name, auc)


def test_calibration_and_persistence(spark, planted, tmp_path):
    train = planted.where(F.col("split") == "train")
    val = planted.where(F.col("split") == "val")
    base = MD.fit("LogisticRegression", train, FEATS, "y", {"C": 1.0})
    raw = MD.score(base, val, "raw", "y")
    for method in ("sigmoid", "isotonic"):
        cal_rows = CA._raw_scores(base, val).withColumn("label", F.col("y"))
        cal = CA.fit_calibrator(cal_rows, method)
        out = CA.apply_calibrator(cal, cal_rows)
        pts = sorted((r["raw_score"], r["score"]) for r in out.select("raw_score", "score").collect())
        assert all(b[1] >= a[1] - 1e-12 for a, b in zip(pts, pts[1:]))       # monotone
        assert all(0.0 <= s <= 1.0 for _, s in pts)
    model, table = CA.calibrate(base, val, "y", features=FEATS)
    assert table.count() == 2 and table.where("chosen = 1").count() == 1
    if model.method == "sigmoid":                      # positive slope keeps the ranking
        cal_s = model.transform(val).select(F.lit("cal").alias("model"), F.lit("val").alias("split"),
                                            "row_id", F.col("y").alias("label"), "score")
        a1 = ME.ranking_metrics(raw).first()["roc_auc"]
        a2 = ME.ranking_metrics(cal_s).first()["roc_auc"]
        assert math.isclose(a1, a2, abs_tol=1e-9)
    path = str(tmp_path / "model")
    model.threshold = 0.35
    model.save(path)
    loaded = CA.CalibratedModel.load(path)
    assert loaded.threshold == 0.35 and loaded.method == model.method
    a = {r[0]: r[1] for r in model.transform(val).select("row_id", "score").collect()}
    b = {r[0]: r[1] for r in loaded.transform(val).select("row_id", "score").collect()}
    assert a == b
    base.write().overwrite().save(f"{path}-bare")
    bare = CA.CalibratedModel.load(f"{path}-bare")
    assert (bare.threshold, bare.method) == (0.5, "none")
    c = {r[0]: r[1:] for r in bare.predict(val).select("row_id", "score", "prediction").collect()}
    d = {r[0]: r[1] for r in raw.select("row_id", "score").collect()}
    assert {k: v[0] for k, v in c.items()} == d and all(v[1] == int(v[0] >= 0.5) for v in c.values())


def test_shapley_additivity(spark, planted):
    train = planted.where(F.col("split") == "train")
    val = planted.where(F.col("split") == "val")
    base = MD.fit("LogisticRegression", train, FEATS, "y", {"C": 1.0})
    model, _ = CA.calibrate(base, val, "y", features=FEATS)
    sample = SP.uniform_sample(val, 20)
    background = SP.uniform_sample(sample, 8, seed=43)
    phi, base_value = XA.shapley_values(model, sample, background, FEATS, n_perm=3)
    sums = {r[0]: r[1] for r in phi.groupBy("row_id").agg(F.sum("phi")).collect()}
    scores = {r[0]: r[1] for r in model.transform(sample).select("row_id", "score").collect()}
    assert len(sums) == 20
    for rid, s in sums.items():
        assert math.isclose(s + base_value, scores[rid], abs_tol=1e-9)
    top = {r["feature"] for r in XA.global_importance(phi, 2).collect()}
    assert top == {"x1", "x2"}                          # the weak binary term ranks last


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_shapley_short_path_equals_scored_points(spark, planted, method):
    train = planted.where(F.col("split") == "train")
    val = planted.where(F.col("split") == "val")
    base = MD.fit("LogisticRegression", train, FEATS, "y", {"C": 1.0})
    model, _ = CA.calibrate(base, val, "y", methods=(method,), features=FEATS)
    sample = SP.uniform_sample(val, 12)
    background = SP.uniform_sample(sample, 5, seed=43)
    assert model.additive(FEATS) is not None
    short, base_short = XA.shapley_values(model, sample, background, FEATS, n_perm=4)
    model.additive = lambda features: None              # score every masked point
    full, base_full = XA.shapley_values(model, sample, background, FEATS, n_perm=4)
    a, b = ({(r["row_id"], r["feature"]): r["phi"] for r in d.collect()} for d in (short, full))
    assert a.keys() == b.keys() and len(a) == 12 * len(FEATS)
    assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
    assert math.isclose(base_short, base_full, abs_tol=1e-9)


def test_isotonic_pools_equal_plain_pooling(spark):
    """Hulls merged over ranges give what pooling neighbours one by one gives, ties and one-sided labels included."""
    from pyspark.ml.regression import IsotonicRegression

    from cohortlens.operators.isotonic import fit_isotonic, pools
    rng = random.Random(4)
    rows = [(round(rng.random(), 3), int(rng.random() < 0.3 + 0.4 * (i % 2))) for i in range(4000)]
    rows = [(s, y if s < 0.8 else 1) for s, y in rows] + [(0.5, i % 2) for i in range(3000)]       # a hot score
    df = spark.createDataFrame(rows, "raw_score double, label int").repartition(5)
    points = {}
    for s, y in rows:
        n, p = points.get(s, (0, 0))
        points[s] = (n + 1, p + y)
    stack = []
    for s in sorted(points):
        stack.append([s, s, *points[s]])
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            lo, _, n, p = stack.pop(-2)
            stack[-1] = [lo, stack[-1][1], stack[-1][2] + n, stack[-1][3] + p]
    got = sorted((r["lo"], r["hi"], r["n"], r["value"]) for r in pools(df).collect())
    assert [g[:3] for g in got] == [tuple(x[:3]) for x in stack]
    assert all(math.isclose(g[3], x[3] / x[2], abs_tol=1e-12) for g, x in zip(got, stack))
    mine, theirs = fit_isotonic(df), IsotonicRegression(featuresCol="raw_score", labelCol="label").fit(df)
    probe = spark.createDataFrame([(k / 777 - 0.1,) for k in range(950)], "raw_score double")
    a, b = ([r["prediction"] for r in m.transform(probe).orderBy("raw_score").collect()] for m in (mine, theirs))
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip(a, b)) and len(a) == 950
    one = pools(spark.createDataFrame([(0.3, 1), (0.7, 1), (0.3, 1)], "raw_score double, label int")).collect()
    assert [tuple(r) for r in one] == [(0.3, 0.7, 1.0, 3)]
    assert pools(df.where("1 = 0")).count() == 0
    with pytest.raises(Exception, match="null or NaN"):
        pools(spark.createDataFrame([(None, 1), (0.2, 0)], "raw_score double, label int")).count()


def _phi_of(df):
    return {(r["row_id"], r["feature"]): r["phi"] for r in df.collect()}


@pytest.mark.parametrize("family,params,method", [
    ("RandomForest", {"n_estimators": 7, "max_depth": 6}, None), ("RandomForest", {"n_estimators": 5, "max_depth": 5}, "sigmoid"),
    ("GradientBoosting", {"max_iter": 9, "max_depth": 4}, None), ("GradientBoosting", {"max_iter": 6, "max_depth": 3}, "isotonic")])
def test_tree_paths_equal_scored_points(spark, planted, family, params, method):
    """X1 of tree ensembles: the path table gives what scoring every masked point gives."""
    val = planted.where(F.col("split") == "val")
    base = MD.fit(family, planted.where(F.col("split") == "train"), FEATS, "y", params)
    model = TP.UncalibratedModel(base) if method is None else CA.calibrate(base, val, "y", methods=(method,), features=FEATS)[0]
    sample = SP.uniform_sample(val, 10)
    background = SP.uniform_sample(sample, 6, seed=43).unionByName(SP.uniform_sample(sample, 2, seed=43))    # repeated rows
    short, base_short = XA.shapley_values(model, sample, background, FEATS, n_perm=4)
    trees = model.paths(FEATS)
    assert len(trees.trees) == base.stages[-1].getNumTrees and (trees.link is None) == (family == "RandomForest" and method is None)
    short = _phi_of(short)
    scores = {r[0]: r[1] for r in model.transform(sample).select("row_id", "score").collect()}
    for row, score in scores.items():
        assert math.isclose(sum(v for (r, _), v in short.items() if r == row) + base_short, score, abs_tol=1e-9)
    model.paths = lambda features: None                 # score every masked point
    full, base_full = XA.shapley_values(model, sample, background, FEATS, n_perm=4)
    full = _phi_of(full)
    assert full.keys() == short.keys() and len(full) == 10 * len(FEATS)
    assert all(math.isclose(full[k], short[k], abs_tol=1e-9) for k in full)
    assert math.isclose(base_short, base_full, abs_tol=1e-9)


def test_tree_paths_beyond_one_word_of_features():
    """More than 64 features: sets of several words, against the definition row by row."""
    import numpy as np
    r = np.random.default_rng(8)
    n = 70
    tree = TP.Tree(np.array([68, 3, -1, -1, 68, -1, -1]), np.array([0.5, 0.2, 0, 0, 0.8, 0, 0]), np.array([1, 2, -1, -1, 5, -1, -1]),
                   np.array([4, 3, -1, -1, 6, -1, -1]), np.array([0, 0, 1.0, 2.0, 0, 4.0, 8.0]))

    def value(x):
        node = 0
        while tree.feature[node] >= 0:
            node = int(tree.left[node] if x[tree.feature[node]] <= tree.threshold[node] else tree.right[node])
        return tree.value[node]

    background, x = r.random((9, n)), r.random((4, n))
    perms = np.stack([np.stack([r.permutation(n) for _ in range(5)]) for _ in range(4)])
    for link in (None, lambda m: 1 / (1 + np.exp(-m))):
        paths = TP.PathTable([tree, tree], background, link is not None)
        _, failed = TP.failed_splits(tree, x)
        score = (lambda p: 2 * value(p)) if link is None else (lambda p: link(2 * value(p)))
        assert math.isclose(paths.base(link), np.mean([score(b) for b in background]), abs_tol=1e-12)
        for i in range(4):
            got = paths.attribute(np.concatenate([failed[i], failed[i]]), perms[i], link)
            want = np.zeros(n)
            for perm in perms[i]:
                points = background.copy()
                last = np.mean([score(b) for b in points])
                for f in perm:
                    points[:, f] = x[i, f]
                    now = np.mean([score(b) for b in points])
                    want[f] += (now - last) / 5
                    last = now
            assert np.allclose(got, want, atol=1e-12)


def test_boosting_rounds(spark, planted):
    """M5: every round without early stopping; with it the best prefix of the staged losses, after ten flat rounds."""
    train = planted.where(F.col("split") == "train")
    params = {"max_iter": 14, "max_depth": 2, "learning_rate": 0.5, "min_samples_leaf": 5}
    whole = MD.fit("GradientBoosting", train, FEATS, "y", params)
    assert whole.stages[-1].getNumTrees == 14             # fewer rows than the library's bound: no early stop
    on = MD.EarlyStop(enabled=True, first_run=4)
    data = MD.with_class_weights(train, "y")
    stopped = MD.fit_boosting(data, FEATS, "y", {**params, "max_iter": 30}, stop=on)
    n = stopped.stages[-1].getNumTrees
    held = MD.assembler(FEATS).transform(MD.early_stop_indicator(data).where("is_early_stop"))
    rest = MD.early_stop_indicator(data).where("not is_early_stop")
    longest = MD.gradient_boosting(FEATS, "y", **{**params, "max_iter": 30}).fit(rest).stages[-1]
    losses = MD.staged_losses(longest, held, "y")
    best, over = MD.stop_round(losses, on.patience, on.tolerance)
    assert n == best and (n == losses.index(min(losses[:n + on.patience])) + 1 or not over)
    a = {r[0]: r[1] for r in MD.score(stopped, train, "m", "y").select("row_id", "score").collect()}
    short = MD.truncated(longest, n, spark)
    b = {r[0]: r[1] for r in MD.score(MD.PipelineModel([stopped.stages[0], short]), train, "m", "y").select("row_id", "score").collect()}
    assert all(math.isclose(a[k], b[k], abs_tol=1e-12) for k in a) and len(a) == len(b)


def test_stop_round():
    assert MD.stop_round([3, 2, 1], 10, 1e-7) == (3, False)
    assert MD.stop_round([3, 2, 2, 2.5, 1], 2, 1e-7) == (2, True)
    assert MD.stop_round([3, 2, 2 - 1e-9, 2 - 2e-9, 1], 3, 1e-7) == (5, False)
    assert MD.stop_round([1, 2, 3], 2, 1e-7) == (1, True)


def test_streaming_scores_match_batch(spark):
    from cohortlens.plans import registry as R
    from cohortlens.streaming.scoring import order_stream, run_to_table, score_frame
    mf, _, cal, _ = R._calibrated(spark, SMOKE)
    art = mf.artifacts
    streamed = run_to_table(score_frame(order_stream(spark, SMOKE), R.SPEC, art.fit.imputer,
                                        art.levels, mf.features, cal), "test-stream")
    batch = score_frame(R.raw(spark, SMOKE), R.SPEC, art.fit.imputer, art.levels, mf.features, cal)
    a = {r[0]: r[1] for r in streamed.collect()}
    b = {r[0]: r[1] for r in batch.collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[k], b[k], abs_tol=1e-12) for k in a)


def test_search_space_sizes_and_draws():
    from cohortlens.spec import SEARCH_SPACES
    assert len(MD.search_space("LogisticRegression", SEARCH_SPACES)) == 14   # solver not applicable
    assert len(MD.search_space("RandomForest", SEARCH_SPACES)) == 36         # no min_samples_split
    assert len(MD.search_space("GradientBoosting", SEARCH_SPACES)) == 256
    d1 = MD.sample_draws(MD.search_space("GradientBoosting", SEARCH_SPACES), 20, 42)
    d2 = MD.sample_draws(MD.search_space("GradientBoosting", SEARCH_SPACES), 20, 42)
    assert d1 == d2 and len({str(x) for x in d1}) == 20


def test_random_search_picks_best_cv_draw(planted):
    train = planted.where(F.col("split") == "train")
    space = {"LogisticRegression": {"C": [0.001, 1.0], "penalty": ["l2"]}}
    res = MD.random_search("LogisticRegression", train, FEATS, "y", space, n_draws=2, k=3,
                           parallelism=2)
    assert len(res["draws"]) == 2
    assert res["cv_score"] == max(s for _, _, s in res["draws"]) and res["cv_score"] > 0.7


def test_exact_auc_evaluator_matches_operator(planted):
    train = planted.where(F.col("split") == "train")
    val = planted.where(F.col("split") == "val")
    model = MD.fit("LogisticRegression", train, FEATS, "y", {"C": 1.0})
    ev = MD.ExactAUCEvaluator("y").evaluate(model.transform(val))
    op = ME.ranking_metrics(MD.score(model, val, "m", "y")).first()["roc_auc"]
    assert math.isclose(ev, op, abs_tol=1e-12) and MD.ExactAUCEvaluator().isLargerBetter()


def test_rows_without_a_label_stay_in_the_split(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(60)], "row_id long, y int")
    out = SP.stratified_split(df, "y")
    assert out.count() == 60 and out.where("y is null and split = 'test'").count() >= 2


def test_boosting_keeps_more_than_one_tree(planted):
    model = MD.fit("GradientBoosting", planted.where("split = 'train'"), FEATS, "y", {"max_iter": 20, "max_depth": 3})
    assert model.stages[-1].getNumTrees > 5


def test_margin_gains_evaluate_moved_sums_only():
    """X1 of a margin equals running sums of every pair; the link sees no pair whose sum a feature left as it was."""
    r = np.random.default_rng(3)
    n, n_back, n_rows, n_perm = 30, 40, 25, 4
    x, back = ((r.integers(0, 20, (m, n)) == 0).astype(float) for m in (n_rows, n_back))
    x[:, 0], back[:, 0] = r.normal(size=n_rows), r.normal(size=n_back)
    w = r.normal(size=n)
    perms = np.stack([np.stack([r.permutation(n) for _ in range(n_perm)]) for _ in range(n_rows)])
    seen = []

    def link(m):
        seen.append(m.size)
        return 1 / (1 + np.exp(-m))

    for given in (link, None):
        got = XA.margin_gains(XA.AdditiveMargin(w, 0.5, given), x, back, perms)
        want = np.zeros_like(x)
        for i in range(n_rows):
            for perm in perms[i]:
                at = back.copy()
                v = [(link if given else np.array)(at @ w + 0.5).mean()]
                if given:
                    seen.pop()
                for j in perm:
                    at[:, j] = x[i, j]
                    v.append((link if given else np.array)(at @ w + 0.5).mean())
                    if given:
                        seen.pop()
                want[i, perm] += np.diff(v)
        assert np.allclose(got, want / n_perm, atol=1e-12)
    assert sum(seen) < 0.3 * n_rows * n_perm * n_back * n


def test_orders_both_ways_are_the_permutations(spark):
    one = spark.range(3).select(F.col("id").alias("row_id"))
    for n_perm in (3, 4):
        want = one.select(F.array(*[XA.permutation(F.col("row_id"), F.lit(p), 5, 7) for p in range(n_perm)])).collect()
        orders = one.select(XA.drawn_orders(F.col("row_id"), n_perm, 5, 7).alias("o")).toArrow().column(0).combine_chunks()
        assert XA.both_ways(orders, n_perm, 5).tolist() == [r[0] for r in want]


def test_cuts_below_counts_like_a_scan(spark):
    from cohortlens.functions.quantile import CUTS, cuts_below
    cuts = sorted(float(v) for v in range(0, 3 * CUTS, 3))
    for some in (cuts, cuts[:1], cuts[:100]):
        rows = spark.range(-2, 3 * CUTS + 2).select(F.col("id").cast("double").alias("v"), F.array(*map(F.lit, some)).alias("c"))
        assert all(r["b"] == sum(c < r["v"] for c in some) for r in rows.select("v", cuts_below(F.col("c"), F.col("v")).alias("b")).collect())


def test_search_fits_together_equal_single_fits(spark, planted):
    """M8 of logistic regression: fits that advance together score held-out rows as fits of their own do,
    and l1 points meet the optimality condition that the objective sets."""
    from cohortlens.operators import logistic_search as LS
    train = planted.where(F.col("split") == "train").withColumn("fold", F.pmod(F.col("row_id"), F.lit(3)).cast("int"))
    train = train.withColumn("flat", F.lit(2.0)).withColumn("twice", F.col("x1") * 2)     # a constant and a collinear feature
    feats = [*FEATS, "flat", "twice"]
    folds = MD.fold_frames(train, feats, "y", 3)
    draws = [{"C": c, "penalty": p} for c in (0.01, 5.0) for p in ("l1", "l2")]
    together = {(r["model"], r["row_id"]): r["score"] for r in LS.held_scores(folds, draws, feats, "y").collect()}
    n = 0
    for i, draw in enumerate(draws):
        for fold in folds[:2]:
            model = MD.fit_weighted("LogisticRegression", fold.train, feats, "y", draw, 42, fold.n_weight)
            for r in MD.score(model, fold.held, "m", "y").collect():
                assert math.isclose(together[f"draw{i}", r["row_id"]], r["score"], abs_tol=2e-3)
                n += 1
    assert n > 100 and len(together) == len(draws) * train.count()
    fits, scale = LS.fit_all(folds[:1], draws, feats, "y")
    rows = folds[0].train.select(F.lit(0).alias("fold"), F.col("y").cast("double"), "weight", *[F.col(c).cast("double") for c in feats])
    got = LS.pass_over(rows, {0: [(i, fits[0, i].at) for i in range(len(draws))]}, scale)
    for i, draw in enumerate(draws):
        at, sums = fits[0, i].at, got[0, i]
        slope, reg = sums[2:2 + len(at)] / sums[0], fits[0, i].reg
        assert fits[0, i].passes < 40 and abs(slope[-1]) < 1e-6
        if draw["penalty"] == "l1":
            assert all(abs(g + reg * np.sign(b)) < 1e-5 if b else abs(g) <= reg + 1e-6 for g, b in zip(slope[:-1], at[:-1]))
        else:
            assert np.allclose(slope[:-1] + reg * at[:-1], 0, atol=1e-6)


def test_search_adds_few_hessians(planted, monkeypatch):
    """One Hessian per fold at the common start leads most draws on; before, every fit added its own in every pass."""
    from cohortlens.operators import logistic_search as LS
    train = planted.where(F.col("split") == "train")
    folds = MD.fold_frames(train, FEATS, "y", 5)
    draws = [{"C": c, "penalty": p} for c in (0.1, 1.0, 5.0, 10.0) for p in ("l1", "l2")]
    plain, asked = LS.pass_over, []

    def counted(rows, points, scale, curved=frozenset()):
        asked.append((sum(len(p) for p in points.values()), len(curved)))
        return plain(rows, points, scale, curved)

    monkeypatch.setattr(LS, "pass_over", counted)
    LS.fit_all(folds, draws, FEATS, "y")
    assert asked[0] == (40, 5) and sum(c for _, c in asked) < 0.5 * sum(n for n, _ in asked)


def test_l1_step_meets_its_optimum_on_collinear_features(monkeypatch):
    """Nearly collinear features: coordinates alone creep and stop short of the model's minimum."""
    import numpy as np
    from cohortlens.operators import logistic_search as LS
    r = np.random.default_rng(5)
    z = r.normal(size=(500, 4))
    z = np.column_stack([z, z[:, :3].sum(axis=1) + 1e-3 * r.normal(size=500), np.ones(500)])
    curve = z.T @ z / 2000
    slope, reg, at = z.T @ r.normal(size=500) / 500, 1e-6, np.zeros(6)
    monkeypatch.setattr(LS, "SWEEPS", 200)
    new = LS.newton_target(at, slope, curve, reg, True)
    left = slope + curve @ new
    assert all(abs(g + reg * np.sign(b)) < 1e-9 if b else abs(g) <= reg + 1e-9 for g, b in zip(left[:-1], new[:-1])) and abs(left[-1]) < 1e-9
