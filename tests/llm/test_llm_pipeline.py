"""The pipeline's stages take effect, checked by brute force on small tables."""

import corpus_pipeline as P
from tests.conftest import SMOKE
from tests.llm.test_llm_operators import brute_components, documents, edge_rows, empty, shingles


def test_stages_on_edge_rows(spark):
    docs = documents(spark, edge_rows())
    for name, stage in P.STAGES:
        out = P.stored(stage(spark, docs, SMOKE))
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        assert stage(spark, empty(spark), SMOKE).count() == 0
        docs = out
    assert out.count() > 0


def test_run_keeps_one_of_each_group_and_no_leak(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    component = brute_components({d: shingles(t) for d, t in texts.items()})
    named = P.language(spark, docs, SMOKE)
    assert named.count() == sum(any(c.isalpha() for c in t or "") for t in texts.values())
    alone = {r["doc_id"] for r in P.near_dedup(spark, docs, SMOKE).collect()}
    assert alone == set(component.values())
    items = [r["text"] for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in P.decontamination(spark, docs, SMOKE).collect()}
    assert not any(i in texts[d] for d in clean for i in items) and len(clean) > 0.8 * len(texts)
    out = P.run(spark, SMOKE).collect()
    assert {r["doc_id"] for r in out} <= alone & clean
    assert {r["shard"] for r in out} == set(range(24))
