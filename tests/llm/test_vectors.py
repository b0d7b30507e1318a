"""Links of vectors against all pairs, over many cells and blocks, with odd rows."""

import numpy as np
import pytest

from termweave.llm import embed_dedup
from termweave.llm.components import star_edges


def made(n=900, dim=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[n // 3 : n // 2] = x[0] + 0.12 * rng.standard_normal((n // 2 - n // 3, dim))  # a large group of different near copies
    x[n // 2 : n // 2 + 60] = x[1]
    for i in range(n - 100, n, 2):
        x[i] = x[i - 1] + 0.15 * rng.standard_normal(dim)
    return x.astype(np.float32)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_and_components(spark, monkeypatch, kind):
    for name, value in (("CELL_ROWS", 60), ("BLOCK_ROWS", 25), ("GUEST_ROWS", 30), ("MOST_COSINES", 500)):
        monkeypatch.setattr(embed_dedup, name, value)
    x = made()
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, True)
    label = np.arange(len(x))
    for _ in range(40):
        label = np.array([label[n].min() for n in near])
    assert [got[i].n_links for i in range(len(x))] == (near.sum(1) - 1).tolist()
    assert [got[i].component_id for i in range(len(x))] == label.tolist()
    assert [got[i].kept for i in range(len(x))] == (label == np.arange(len(x))).tolist()


def test_repeated_and_null_ids_lengths_and_clashing_names(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, v, 1), (5, v, 1), (5, w, 1), (3, w, 1), (9, [1.0, 0.01, 0.0], 1), (None, v, 1), (20, [2.0, 0.0], 1), (21, [4.0, 0.0], 1), (30, [0.0, 0.0], 1)]
    got = embed_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, `k1` int")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted([("5", 2, "3", False), ("5", 2, "3", False), ("5", 1, "3", False), ("3", 1, "3", True), ("9", 2, "3", False), ("None", 0, "None", True), ("20", 1, "20", True), ("21", 1, "20", False), ("30", 0, "30", True)])


def test_star_edges():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(2, 60))
        a, b = rng.integers(0, n, (2, n // 2))
        want = np.arange(n)
        for _ in range(n):
            low = np.minimum(want[a], want[b])
            np.minimum.at(want, a, low)
            np.minimum.at(want, b, low)
        got = np.arange(n)
        star_edges(a[: n // 4], b[: n // 4], got)
        star_edges(a[n // 4 :], b[n // 4 :], got)
        assert got.tolist() == want.tolist()
