"""Sums of vectors over documents, in blocks, against plain Python."""

import random

import pytest

from termweave.operators import profiles as P


@pytest.mark.parametrize("per_block", [3, 50_000])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_sums(spark, per_block, kind):
    rng, k = random.Random(4), len(P.SEMANTIC_TYPES)
    vec = {f"T{i}": [rng.choice([None, -5, 0, 7, 2**31 - 1]) for _ in range(k)] for i in range(25)}
    name = (lambda d: d) if kind == "long" else (lambda d: f"doc {d}")
    counts = {(name(d), f"T{t}"): rng.randint(1, 9) for d in range(40) for t in rng.sample(range(30), 6)}
    counts |= {(name(d), "T0"): d + 1 for d in range(40)}  # a term of every document
    counts[name(99), "T29"] = 3  # no vector
    tf = spark.createDataFrame([(d, t, n) for (d, t), n in counts.items()], f"doc_id {kind}, term string, tf long")
    got = {r.doc_id: (r.n, r.sums) for r in P.profile_sums(tf, spark.createDataFrame(list(vec.items()), "term string, vec array<int>"), per_block).collect()}
    want = {}
    for (d, t), n in counts.items():
        if t in vec:
            m, s = want.get(d, (0, [0] * k))
            want[d] = m + n, [a + n * (b or 0) for a, b in zip(s, vec[t], strict=True)]
    assert got == want and name(99) not in got
    assert P.profile_sums(tf.limit(0), spark.createDataFrame(list(vec.items()), "term string, vec array<int>")).count() == 0
