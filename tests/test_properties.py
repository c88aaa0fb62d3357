"""Property tests: exact metrics and exact split quotas on random inputs."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.operators import metrics as ME
from cohortlens.operators import split as SP
from tests.test_guards import _brute_ap, _brute_auc, _scored

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

pairs_st = st.lists(st.tuples(st.integers(0, 1),
                              st.sampled_from([0.0, 0.05, 0.1, 0.33, 0.5, 0.5, 0.77, 1.0])),
                    min_size=4, max_size=120).filter(
    lambda ps: 0 < sum(y for y, _ in ps) < len(ps))


@SETTINGS
@given(pairs=pairs_st)
def test_auc_ap_equal_brute_force(spark, pairs):
    r = ME.ranking_metrics(_scored(spark, pairs)).first()
    assert math.isclose(r["roc_auc"], _brute_auc(pairs), abs_tol=1e-12)
    assert math.isclose(r["pr_auc"], _brute_ap(pairs), abs_tol=1e-12)


@SETTINGS
@given(n_pos=st.integers(1, 300), n_neg=st.integers(1, 300), seed=st.integers(0, 1000))
def test_split_quotas_exact(spark, n_pos, n_neg, seed):
    rows = [(i, 1) for i in range(n_pos)] + [(n_pos + i, 0) for i in range(n_neg)]
    df = spark.createDataFrame(rows, "row_id long, y int")
    out = SP.stratified_split(df, "y", seed=seed)
    got = {(r["split"], r["y"]): r["n"]
           for r in out.groupBy("split", "y").agg(F.count("*").alias("n")).collect()}
    train, val, test = SP.expected_sizes(n_pos + n_neg)
    totals = {s: sum(v for (k, _), v in got.items() if k == s) for s in ("train", "val", "test")}
    assert (totals["train"], totals["val"], totals["test"]) == (train, val, test)
    for cls, n_c in ((1, n_pos), (0, n_neg)):            # largest remainder: within one row
        assert abs(got.get(("test", cls), 0) - test * n_c / (n_pos + n_neg)) < 1.0 + 1e-9
    assert out.select("row_id").distinct().count() == n_pos + n_neg
