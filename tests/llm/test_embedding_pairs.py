"""Links and groups against all pairs in double precision."""

from __future__ import annotations

import math

import numpy as np

from seriesloom.llm.embedding_pairs import embedding_links, quantised, tile_links
from seriesloom.llm.unions import smallest_labels

KIND = "vec_id long, embedding array<float>, label int, n_links int"


def _brute(x, threshold=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, 0)
    return np.nonzero(s >= threshold)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    for d in (1, 3, 64, 1500):
        x, y = rng.normal(size=(50, d)), rng.standard_t(1, size=(50, d))
        x, y = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
        (a, s, e), (b, t, f) = quantised(x), quantised(y)
        near = (a.astype(float) @ b.astype(float).T) * s[:, None] * t
        assert (np.abs(near - x @ y.T) <= e[:, None] + (1 + e[:, None]) * f + 1e-9).all()


def test_tiles_near_the_threshold():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 64))
    y = np.concatenate([base + rng.normal(size=base.shape) * w for w in (0.2, 0.47, 0.48, 0.49, 1)])
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (base, y))
    for threshold in (0.9, 0.3, -0.2):
        i, j = tile_links(x, y, threshold)
        assert set(zip(i, j)) == set(zip(*np.nonzero(x @ y.T >= threshold)))


def test_links_and_groups(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.3, 0.6]) for i in range(300)]).reshape(-1, 16)
    x = np.concatenate([x, x[:40], x[:1].repeat(30, axis=0), x[:10] * 3]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0, 9) for i, v in enumerate(x)], KIND)
    i, j = _brute(x.astype(float))
    links, labels = np.bincount(i, minlength=len(x)), smallest_labels(len(x), i, j)
    for options in ({}, {"tile": 16, "most_pivots": 5, "sample": 50}):
        got = embedding_links(df, **options).orderBy("vec_id").collect()
        assert [r.n_links for r in got] == links.tolist()
        assert [r.component_id for r in got] == labels.tolist()
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, -0.0]), (5, [1.0, None]), (6, [1.0, math.nan]), (7, [math.inf, 1.0]),
        (8, [2.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (12, [1e-38, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], KIND)
    got = {}
    for r in embedding_links(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert len(got[1]) == 2 and got[1][0] == (4, 1, True) and got[8] == [(4, 1, False)] and got[12] == [(4, 1, False)]
    assert got[None] == [(4, 1, False)]
    for k in (2, 3, 4, 5, 6, 7, 9):
        assert got[k] == [(0, k, True)]
    assert got[10] == [(1, 10, True)] and got[11] == [(1, 10, False)]
    for empty in ([], [(1, None, 0, 0)]):
        assert embedding_links(spark.createDataFrame(empty, KIND)).count() == len(empty)
