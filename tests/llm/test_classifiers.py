"""The two classifiers' fits against plain versions, and their out-of-fold part."""

import numpy as np
from pyspark.sql import functions as F

from termweave.llm import pu_quality, toxicity


def samples(prior, n=4000, seed=1):
    rng = np.random.default_rng(seed)
    draw = lambda pos, k: rng.standard_normal((k, 3)) + (1.5 if pos else -1.0)
    k = int(prior * n)
    return draw(True, n // 2), np.concatenate([draw(True, k), draw(False, n - k)])


def test_prior_from_positives_and_unlabelled():
    for prior in (0.15, 0.4, 0.75):
        assert abs(pu_quality.class_prior(*samples(prior)) - prior) < 0.06


def test_risk_against_plain_differences():
    p, u = samples(0.3, 60)
    p, u = np.c_[p, np.ones(len(p))], np.c_[u, np.ones(len(u))]
    rng = np.random.default_rng(2)
    signs = set()
    for prior in (0.3, 0.95):
        for _ in range(20):
            w = rng.standard_normal(4)
            g, positive, negative = pu_quality.nnpu_risk(w, p, u, prior)
            signs.add(negative < 0)

            def loss(v, prior=prior, negative=negative):
                as_positive = prior * np.mean([np.log1p(np.exp(-x @ v)) for x in p])
                part = np.mean([np.log1p(np.exp(x @ v)) for x in u]) - prior * np.mean([np.log1p(np.exp(x @ v)) for x in p])
                return as_positive + part if negative >= 0 else -part

            plain = np.array([(loss(w + 1e-5 * e) - loss(w - 1e-5 * e)) / 2e-5 for e in np.eye(4)])
            assert np.allclose(g, plain, atol=1e-6)
            assert positive >= 0
    assert signs == {True, False}


def test_nnpu_separates():
    p, u = samples(0.3)
    shift, scale, w, b = pu_quality.fit_nnpu(p, u, 0.3)
    s = (u - shift) / scale @ w + b
    k = int(0.3 * len(u))
    assert ((s[:k] > 0).mean() + (s[k:] <= 0).mean()) / 2 > 0.97


def test_held_probabilities_never_see_their_own_label():
    rng = np.random.default_rng(7)
    n = 80
    y, fold = rng.random(n) < 0.5, np.arange(n) % 4
    x = (rng.random((n, 12)) < 0.2 + 0.3 * y[:, None] * (np.arange(12) < 4)).astype(np.float32)

    def fit(y):
        columns, marks = [], []
        for k in range(5):
            use = fold != k
            lift = np.abs(x[use & y].mean(0) - x[use & ~y].mean(0))
            columns.append(np.argsort(-lift)[:6].tolist())
            marks.append(columns[-1][:3])
        return toxicity.fit_chain(x, y, fold, columns, marks)

    chain, held = fit(y)
    flipped = y.copy()
    flipped[fold == 2] = ~flipped[fold == 2]
    assert np.array_equal(fit(flipped)[1][fold == 2, 0], held[fold == 2, 0])
    assert not np.array_equal(fit(flipped)[1][fold != 2, 0], held[fold != 2, 0])
    assert [len(w) for w, _ in chain] == [6, 7, 8]


def test_logistic_comes_near_the_least_loss():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 4)).astype(np.float32)
    y = (x[:, 0] + 0.5 * rng.standard_normal(300) > 0).astype(np.float32)
    w, b = toxicity._logistic(x, y)
    loss = lambda w, b: float(np.mean(np.logaddexp(0, -(2 * y - 1) * (x @ w + b))))
    best, c = np.zeros(4), 0.0
    for _ in range(5000):
        r = 1 / (1 + np.exp(-(x @ best + c))) - y
        best, c = best - 0.5 * x.T @ r / 300, c - 0.5 * r.mean()
    assert loss(w, b) < loss(best, c) + 0.02


def test_scores_equal_the_plain_sum():
    names, chain = ["abc", "abcd-", "xyz"], [([1.0, -2.0, 0.5], 0.1), ([0.3, 0.2, 0.1, 2.0], -0.2), ([1.0, 1.0, -1.0, 0.5, -0.5], 0.0)]
    texts = ["ABC xyz xyz", "abcdef", "", None, "abcd 12 abc_d"]
    got = toxicity._probabilities((names, chain), texts)
    for t, g in zip(texts, got, strict=True):
        found = {f for w in toxicity.WORDS.findall((t or "").lower()) for f in toxicity.word_features(w)}
        p = []
        for w, b in chain:
            z = b + sum(w[i] for i, f in enumerate(names) if f in found) + sum(a * c for a, c in zip(w[3:], p, strict=True))
            p.append(1 / (1 + np.exp(-z)))
        assert np.allclose(g, p)


def test_reruns_agree_where_ids_repeat(spark):
    rows = [(i // 2, f"{'good fine words' if i % 4 < 2 else 'bad worse!! 1 2'} w{i}", "x") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `score` string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    for score in (pu_quality.score, toxicity.score):
        one = sorted(map(tuple, score(docs, labels).collect()))
        assert one == sorted(map(tuple, score(docs.orderBy(F.desc("text")).repartition(3), labels).collect())) and len(one) == 80
