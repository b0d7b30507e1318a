"""Mixing against a plain version in Python, on sources of uneven weights, and its plan."""

import math
from hashlib import md5

from termweave.llm import mixing

TEXTS = [(i, "abcde " * (i % 9) + "x" * (i % 50), ["hot", "hot", "b", None][i % 4] if i % 11 else "c") for i in range(1500)]


def plain(docs):
    """taken words of each document, by sorting every source's keys."""
    size = {d: len(t.split()) for d, t, _ in docs}
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[d] for d, _, q in docs if q == s) for s in sources}
    w = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), float(sum(total.values()))
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if 3 * total[s] <= level * w[s]}
        for s in full or free:
            target[s] = 3.0 * total[s] if full else level * w[s]
            left -= target[s]
        free = free - full if full else set()
    out = {}
    for s in sources:
        epochs = int(target[s] // total[s]) if total[s] else 0
        budget = target[s] - epochs * total[s]
        rows = []
        for d, t, q in docs:
            if q == s:
                u = (int(md5(f"mix-1{d}".encode()).hexdigest()[:12], 16) + 1.0) / 281474976710657.0
                weight = max(0.1, min(1.0, 1 - abs(len(t) / max(1, size[d]) - 6) / 1.5))
                rows.append((-math.log(u) / weight, d))
        upto, best, taken, n = 0, (budget, 0), 0, 0
        for k, (_, d) in enumerate(sorted(rows), 1):
            upto += size[d]
            best = min(best, (abs(upto - budget), k)) if budget > 0 else best
        for k, (_, d) in enumerate(sorted(rows), 1):
            out[d] = size[d] * (epochs + (budget > 0 and k <= best[1]))
    return out


def test_against_plain(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    want = plain(TEXTS)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == want
    for name, value in (("FEW_ROWS", 6), ("BINS", 3), ("BROADCAST_SOURCES", 1), ("SALTS", 3)):
        monkeypatch.setattr(mixing, name, value)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == want


def test_rows_equal_in_key_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_ROWS", 2)
    same = spark.createDataFrame([(7, "a b", "s", "x", "y", 1)] * 50 + [(8, "c", "s", "x", "y", 1), (9, None, "t", "x", "y", 1)], "doc_id long, text string, source string, `key` string, `src` string, `__row` int")
    out = mixing.mix(same).collect()
    assert len(out) == 52 and len({r.taken for r in out if r.doc_id == 7}) == 1
    mixed = mixing.mixed_documents(same)
    assert mixed.columns == same.columns and mixed.count() == sum(r.copies for r in out)
    assert mixing.mixed_documents(same.limit(0)).count() == 0


def test_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    plan = mixing.mixed_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
