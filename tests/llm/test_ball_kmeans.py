"""Ball k-means against plain Lloyd rounds in integers."""

import hashlib

import numpy as np
import pytest

from termweave.llm import ball_kmeans


def plain(rows, dim, clusters, rounds, scale=256, seed=2):
    """rows: (id, list) that are kept.  [(id, cluster, distance, cluster inertia, inertia, digest)]"""
    q = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows]
    c = [v for _, v in sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in q if i is not None)][:clusters]
    def nearest():
        out = []
        for _, v in q:
            d = [sum((a - b) ** 2 for a, b in zip(v, k)) for k in c]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        at = [a for a, _ in nearest()]
        for k in range(len(c)):
            own = [v for (_, v), a in zip(q, at) if a == k]
            if own:
                c[k] = [sum(x) // len(own) for x in zip(*own)]
    last = nearest()
    each = [sum(d for a, d in last if a == k) for k in range(len(c))]
    return [(i, a, d, each[a], sum(each), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for (i, _), (a, d) in zip(q, last)]


def made(n, dim, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, dim))
    x = centres[rng.integers(0, 7, n)] + 0.2 * rng.standard_normal((n, dim))
    x[: n // 3] = centres[0] + 0.01 * rng.standard_normal((n // 3, dim))  # a hot cluster
    x[-5:] = x[0]
    return x.astype(np.float32)


def key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize("clusters,rows", [(12, 400), (12, 8), (1, 50)])
def test_against_plain_rounds(spark, monkeypatch, clusters, rows):
    monkeypatch.setattr(ball_kmeans, "ROWS", 37)
    x = [(i, v.tolist()) for i, v in enumerate(made(rows, 6))]
    frame = spark.createDataFrame(x, "vec_id long, embedding array<float>").repartition(3)
    told = []
    got = ball_kmeans.assign(frame, clusters, 4, dim=6, told=told).collect()
    assert sorted(map(key, got)) == sorted(map(key, plain(x, 6, clusters, 4)))
    if clusters > 1 and rows > 100:  # later passes look at far fewer than all pairs
        assert max(told[1:]) < 0.6 * told[0]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.1, 0.2]), (3, [0.1, 0.2]), (3, [9.0, 9.0]), (4, [0.0, 0.0]), (None, [5.0, -5.0]), (5, None), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (11, [-0.001, 0.001])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, q int")
    kept = [r for r in rows if r[1] is not None and len(r[1]) == 2 and all(x is not None and np.isfinite(x) for x in r[1])]
    for clusters in (3, 40):
        got = ball_kmeans.assign(frame, clusters, 2, dim=2).collect()
        assert sorted(map(key, got)) == sorted(map(key, plain(kept, 2, clusters, 2)))
    assert ball_kmeans.assign(frame.limit(0), 3, 2, dim=2).count() == 0
    with pytest.raises(Exception, match="reaches"):
        ball_kmeans.assign(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>"), 1, 1, dim=1).collect()
    with pytest.raises(ValueError):
        ball_kmeans.assign(frame, 0)


def test_ties_and_borders():
    rng = np.random.default_rng(8)
    for _ in range(60):
        c = rng.integers(-3, 4, (9, 2))
        x = rng.integers(-4, 5, (200, 2))
        apart = ball_kmeans.squared(c, c)
        want, d = ball_kmeans.nearest(x, c)
        at, best, looked = ball_kmeans.reassign(x, rng.integers(0, 9, 200), c, apart, np.argsort(apart, axis=1, kind="stable"))
        assert at.tolist() == want.tolist() and best.tolist() == d.tolist()
        at, _, fewer = ball_kmeans.reassign(x, want, c, apart, np.argsort(apart, axis=1, kind="stable"))
        assert at.tolist() == want.tolist() and fewer < looked


def test_large_components():
    big = (1 << 27) - 1
    x = np.array([[big, -big], [-big, big], [1, 2]])
    assert ball_kmeans.squared(x, x).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in x] for u in x]
