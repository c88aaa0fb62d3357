"""M4's own growth against MLlib's, and its upper nodes against whole trees."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import forest as FO
from cohortlens.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    df = (spark.range(4000).selectExpr("id row_id", "cast(xxhash64(id,1) % 9 as double) a", "cast(xxhash64(id,2) % 15 as double) b",
                                       "cast(xxhash64(id,3) % 2 as double) c")
          .selectExpr("*", "cast(pmod(xxhash64(row_id,4),10) + a + c*3 + abs(b) > 8 as double) l")
          .selectExpr("*", "1.0 + l*0.7 + pmod(xxhash64(row_id,9),1000)/997 weight"))          # no two splits gain the same
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features_vec").transform(df).cache()


def forest(trees, **kw):
    return RandomForestClassifier(featuresCol="features_vec", labelCol="l", weightCol="weight", numTrees=trees, seed=1, **kw)


@pytest.mark.parametrize("node_rows", [None, 500])
def test_single_tree_is_mllibs(rows, node_rows):
    """All rows, all features: the tree is MLlib's, grown whole or below distributed upper nodes."""
    rf = forest(1, maxDepth=12, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=5)
    ours, theirs = FO.fit_forest(rows, "features_vec", 3, rf, node_rows), rf.fit(rows)
    assert ours.totalNumNodes == theirs.totalNumNodes > 100
    p = lambda m, c: m.transform(rows).select("row_id", vector_to_array("probability")[1].alias(c))
    worst = p(ours, "p").join(p(theirs, "q"), "row_id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert worst < 1e-9
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


def test_bags_and_reruns(rows):
    """Bags are Poisson draws that do not depend on partitions; unlimited depth keeps the least leaf size."""
    rf = forest(6, maxDepth=30, minInstancesPerNode=10, featureSubsetStrategy="sqrt")
    one, two = (FO.fit_forest(rows.repartition(k), "features_vec", 3, rf, 800) for k in (3, 7))
    strip = lambda m: m.toDebugString.replace(m.uid, "")
    assert strip(one) == strip(two)
    assert len({t.toDebugString.split("\n", 1)[1] for t in one.trees}) == 6
    counts = FO.bag_counts(np.arange(200_000, dtype=np.int64), 3, 42)
    assert abs(counts.mean() - 1) < 0.01 and abs((counts == 0).mean() - np.exp(-1)) < 0.005


def test_missing_labels_fail(rows):
    with pytest.raises(ValueError, match="class labels"):
        FO.fit_forest(rows.withColumn("l", F.when(F.col("row_id") > 5, F.col("l"))), "features_vec", 3, forest(2))


def test_many_values_are_cut_at_quantiles(spark):
    x = spark.range(20_000).select(F.array(F.col("id").cast("double"), (F.col("id") % 50 == 0).cast("double"), F.lit(3.0)).alias("x"))
    wide, rare, constant = FO.feature_cuts(x, 3)
    assert len(wide) == 31 and np.abs(wide - np.arange(1, 32) * 625).max() < 10
    assert rare.tolist() == [0.5] and len(constant) == 0


def test_registered_fit_grows_without_mllibs_levels(rows, monkeypatch):
    """The fit of M4 asks MLlib for no level of a tree."""
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *a, **k: pytest.fail("MLlib's level-wise fit was called"))
    model = MD.fit("RandomForest", rows.drop("weight", "features_vec"), ["a", "b", "c"], "l", {"n_estimators": 5, "min_samples_leaf": 10}, 42)
    assert model.stages[-1].getNumTrees == 5 and model.stages[-1].getMaxDepth() == 30


def test_baselines_score_each_row_once(spark, monkeypatch):
    """The metrics of M9 read written scores: no model is applied again in their plan."""
    from cohortlens.plans import registry as RG
    monkeypatch.setattr(RG, "SPEC", RG.SPEC.with_(rf_params={"n_estimators": 3, "max_depth": 4}))
    out = RG.REGISTRY["M9_M10_evaluate_baselines"](spark, "/root/testdata/sf0.001")
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["model"] for r in out.collect()} == {"LogisticRegression", "RandomForest"}


def test_fitted_forest_is_not_loaded(rows, monkeypatch):
    """Scores, importances and attributions of a forest come from its table of subtrees: the driver loads no model."""
    from pyspark.ml.classification import RandomForestClassificationModel
    from cohortlens.operators import attribution as XA
    from cohortlens.operators import tree_paths as TP
    data = rows.drop("weight", "features_vec")
    params = {"n_estimators": 5, "min_samples_leaf": 10}
    whole = MD.fit("RandomForest", data, ["a", "b", "c"], "l", params, 42).stages[-1].mllib()
    want = {r[0]: r[1] for r in whole.transform(rows).select("row_id", vector_to_array("probability")[1]).collect()}
    monkeypatch.setattr(FO, "NODE_ROWS", 500)
    monkeypatch.setattr(FO, "SLICE_BYTES", 4000)
    monkeypatch.setattr(TP, "PATH_BYTES", 4000)
    monkeypatch.setattr(RandomForestClassificationModel, "load", lambda *a, **k: pytest.fail("the whole forest was loaded"))
    model = MD.fit("RandomForest", data, ["a", "b", "c"], "l", params, 42)
    got = {r[0]: r[1] for r in MD.score(model, data.selectExpr("*", "'s' split"), "m", "l").select("row_id", "score").collect()}
    assert got.keys() == want.keys() and np.mean([abs(got[k] - want[k]) for k in got]) < 0.05       # other draws of features below upper nodes
    assert abs(sum(r["importance"] for r in MD.feature_importance(model, ["a", "b", "c"]).collect()) - 1) < 1e-9
    sample = data.where("row_id < 40")
    phi, base = XA.shapley_values(TP.UncalibratedModel(model), sample, data.where("row_id < 7"), ["a", "b", "c"], 4, 42)
    for r in phi.groupBy("row_id").agg(F.sum("phi").alias("s")).collect():
        assert abs(r["s"] + base - got[r["row_id"]]) < 1e-9


def test_stored_forest_is_saved_and_loaded_in_a_pipeline(rows, tmp_path):
    from pyspark.ml import PipelineModel
    data = rows.drop("weight", "features_vec").selectExpr("*", "'s' split")
    model = MD.fit("RandomForest", data, ["a", "b", "c"], "l", {"n_estimators": 3, "max_depth": 4}, 42)
    model.write().overwrite().save(str(tmp_path / "m"))
    a, b = (MD.score(m, data, "m", "l").select("row_id", "score") for m in (model, PipelineModel.load(str(tmp_path / "m"))))
    assert a.join(b.withColumnRenamed("score", "q"), "row_id").agg(F.max(F.abs(F.col("score") - F.col("q")))).first()[0] < 1e-12
