"""Nearest neighbours: recall and the share verified, over several blocks, on clustered and on evenly spread vectors."""

import numpy as np
import pytest

from termweave.llm import ann


def made(kind, n=4000, dim=32, seed=3):
    rng = np.random.default_rng(seed)
    if kind == "even":
        return rng.standard_normal((n, dim)).astype(np.float32)
    centres = rng.standard_normal((40, dim))
    return (centres[rng.integers(0, 40, n)] + 0.15 * rng.standard_normal((n, dim))).astype(np.float32)


def brute(x, every, top=5):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u[::every] @ u.T
    s[np.arange(len(s)), np.arange(0, len(x), every)] = -9
    return np.argsort(-s, axis=1, kind="stable")[:, :top], s


@pytest.mark.parametrize(("kind", "most"), [("clustered", 0.1), ("even", 0.75)])
def test_recall_and_share_verified(kind, most):
    x = made(kind)
    ids = np.arange(len(x))
    _, found, verified = ann.search_block(ids, x.astype(float), ids[::50], x[::50].astype(float), 5)
    want, _ = brute(x, 50)
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(want, found, strict=True)]) >= 0.9
    assert verified.mean() / len(x) < most


@pytest.mark.parametrize("kind", ["clustered", "even"])
def test_several_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "BLOCK", 500)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    x = made(kind)
    got = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).toPandas()
    want, s = brute(x, 50)
    hits = 0
    for k, (q, g) in enumerate(got.sort_values(["query_id", "rank"]).groupby("query_id")):
        assert q == 50 * k and g["rank"].tolist() == [1, 2, 3, 4, 5] and g.vec_id.is_unique
        assert np.allclose(g.score, s[k, g.vec_id], atol=1e-12) and (np.diff(g.score) <= 0).all()
        hits += len(set(g.vec_id) & set(want[k]))
    assert hits >= 0.9 * 5 * len(want)


def test_blocks_are_ruled_out():
    x = made("clustered").astype(float)
    p = ann.unit(x) @ ann.projection(x.shape[1])
    tree = ann.grow_tree(p, 32)
    home = ann.home_leaves(tree, p)
    at, leaf = ann.leaves_within(tree, p, np.full(len(p), 1.0))
    assert set(zip(range(len(p)), home.tolist(), strict=True)) <= set(zip(at.tolist(), leaf.tolist(), strict=True))
    assert len(at) < 0.3 * 32 * len(p)
    near = ((p[:200, None] - p[None]) ** 2).sum(2) <= 1.0  # every point within reach lies in a leaf that is visited
    met = set(zip(at.tolist(), leaf.tolist(), strict=True))
    assert all((int(i), int(home[j])) in met for i, j in np.argwhere(near))


def test_ties_repeats_lengths_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (50, [1.0, 1.0, 1.0], 1), (51, [1.0, 1.0, 0.5], 1), (100, [1.0], 1), (7, None, 1)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, `rank` int"))
    assert [tuple(r) for r in got.orderBy("query_id", "rank").collect() if r.query_id == 0] == [(0, 1, 1, 1.0), (0, 2, 3, 1.0), (0, 3, 2, 0.0)]
    assert [(r.query_id, r.vec_id) for r in got.collect() if r.query_id != 0] == [(50, 51)]


def test_chi_square():
    from math import exp

    assert abs(ann.chi_square_cdf(2.0, 2) - (1 - exp(-1))) < 1e-12
    x = (np.random.default_rng(1).standard_normal((200_000, ann.PROJECTED)) ** 2).sum(1)
    assert abs((x <= ann.chi_square_quantile(0.9, ann.PROJECTED)).mean() - 0.9) < 0.005
