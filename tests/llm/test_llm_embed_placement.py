"""op2: where its vectors are compared, against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from cohortlens.llm import embed


@pytest.mark.parametrize("clustered", [False, True])
def test_cells_only_where_they_save_products(spark, monkeypatch, clustered):
    """Vectors without clusters are guests nearly everywhere: each is then held once, in blocks of one cell; the links are all pairs' either way."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 24))
    if clustered:
        x = 8 * np.eye(24)[rng.integers(0, 12, 600)] + 0.9 * x
    x[300:340] = x[:40] + rng.normal(size=(40, 24)) * 0.1
    x[400:430] = x[7] + rng.normal(size=(30, 24)) * 0.02
    x = x.astype(np.float32)
    monkeypatch.setattr(embed, "PER_CELL", 64)
    monkeypatch.setattr(embed, "BLOCK", 150)
    written = []
    one = embed._assigned
    monkeypatch.setattr(embed, "_assigned", lambda *a, **k: written.append(k.get("places_only", False)) or one(*a, **k))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embed.near_duplicates(df).collect()}
    assert (False in written) == clustered
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(600)
    for _ in range(600):
        low = np.minimum(label, np.where(near, label[None, :], 600).min(axis=1))
        if (low == label).all():
            break
        label = low
    assert near.sum() > 900
    assert [got[i]["n_links"] for i in range(600)] == near.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(600)] == label.tolist()
