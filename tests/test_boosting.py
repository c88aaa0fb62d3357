"""M5's own growth against MLlib's boosting."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import boosting as BO
from cohortlens.operators import models as MD


@pytest.fixture(scope="module")
def rows(spark):
    df = (spark.range(4000).selectExpr("id row_id", "cast(xxhash64(id,1) % 9 as double) a", "cast(pmod(xxhash64(id,2), 1500) as double) b",
                                       "cast(xxhash64(id,3) % 2 as double) c")
          .selectExpr("*", "cast(pmod(xxhash64(row_id,4),10) + a + c*3 + b/200 > 9 as double) l")
          .selectExpr("*", "1.0 + l*0.7 + pmod(xxhash64(row_id,9),1000)/997 weight"))          # no two splits gain the same
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features_vec").transform(df).cache()


def boosted(rounds, **kw):
    return GBTClassifier(featuresCol="features_vec", labelCol="l", weightCol="weight", maxIter=rounds, seed=1, **kw)


def test_trees_are_mllibs(rows):
    """More rounds than margins stay unwritten, a feature with more values than bins: MLlib's nodes, scores and importances."""
    gbt = boosted(BO.MARGIN_ROUNDS + 4, maxDepth=4, minInstancesPerNode=20, stepSize=0.2)
    ours, theirs = BO.fit_boosted(rows, "features_vec", 3, gbt), gbt.fit(rows)
    assert ours.getNumTrees == theirs.getNumTrees and ours.totalNumNodes == theirs.totalNumNodes > 100
    p = lambda m, c: m.transform(rows).select("row_id", vector_to_array("probability")[1].alias(c))
    worst = p(ours, "p").join(p(theirs, "q"), "row_id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert worst < 1e-9
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


def test_rows_alike_and_joint_codes(spark, rows, monkeypatch):
    """Rows that agree in all bins, label and weight are one row with a count; codes of one feature each give the same trees."""
    twice = rows.withColumn("weight", F.lit(1.5)).unionByName(rows.withColumn("weight", F.lit(1.5)).where("row_id % 3 = 0"))
    gbt = boosted(3, maxDepth=4, minInstancesPerNode=20)
    ours, theirs = BO.fit_boosted(twice, "features_vec", 3, gbt), gbt.fit(twice)
    assert ours.totalNumNodes == theirs.totalNumNodes and np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())
    monkeypatch.setattr(BO, "JOINT", 32)
    alone = BO.fit_boosted(twice, "features_vec", 3, gbt)
    assert len(BO.Layout([32, 17, 2]).width) == 3 and alone.totalNumNodes == ours.totalNumNodes
    assert np.allclose(ours.featureImportances.toArray(), alone.featureImportances.toArray())


def test_staged_losses_are_mllibs(rows):
    """The held-out loss of every prefix, from the passes that grow the trees."""
    flagged = rows.withColumn("held", F.col("row_id") % 7 == 0)
    x = flagged.select(vector_to_array("features_vec").alias("x"), F.col("l").alias("label"), "weight", "held")
    trees, _, losses = BO.fit_trees(x, 3, boosted(6, maxDepth=3), patience=10, tolerance=1e-7)
    theirs = boosted(6, maxDepth=3).fit(flagged.where("not held"))
    assert np.allclose(losses, MD.staged_losses(theirs, flagged.where("held"), "l"), atol=1e-10)
    assert len(trees) == MD.stop_round(losses, 10, 1e-7)[0]


def test_many_values_are_cut_at_quantiles(rows, monkeypatch):
    monkeypatch.setattr(BO, "EXACT_VALUES", 100)
    cuts = BO.weighted_cuts(rows.select(vector_to_array("features_vec").alias("x"), "weight"), 3)
    assert [len(c) for c in cuts] == [16, 31, 2]


def test_one_class_and_missing_labels(rows):
    """No split gains: every tree is a leaf. Rows without a label fail."""
    one = BO.fit_boosted(rows.where("l = 1"), "features_vec", 3, boosted(2))
    assert one.totalNumNodes == 2 and one.transform(rows).agg(F.min("prediction")).first()[0] == 1.0
    with pytest.raises(ValueError):
        BO.fit_boosted(rows.withColumn("l", F.when(F.col("row_id") > 5, F.col("l"))), "features_vec", 3, boosted(2))


def test_registered_fit_goes_on_from_its_trees(rows, monkeypatch):
    """No run starts again from the first tree, as MLlib's runs of doubling length did."""
    monkeypatch.setattr(GBTClassifier, "fit", lambda *a, **k: pytest.fail("MLlib's boosting"))
    grown = []
    one = BO._grown
    monkeypatch.setattr(BO, "_grown", lambda *a: grown.append(1) or one(*a))
    stop = MD.EarlyStop(enabled=True, patience=40)
    model = MD.fit_boosting(rows.drop("features_vec"), ["a", "b", "c"], "l", {"max_iter": 30, "max_depth": 2, "min_samples_leaf": 20}, stop=stop)
    assert len(grown) == 31 and model.stages[-1].getNumTrees <= 30
