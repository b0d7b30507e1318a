import numpy as np

import corpus_pipeline
from termweave.llm import near_copies

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    cut = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b)


def brute(texts):
    """The smallest number of each text's group, by all pairs."""
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and jaccard(texts[i], texts[j]) >= 0.8:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def planted():
    rng = np.random.default_rng(8)
    texts = []
    for k in range(30):
        words = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        texts.append(" ".join(words))
        for share in (0.01, 0.02, 0.08):  # the last falls below the similarity
            w = list(words)
            for at in rng.choice(len(w), int(share * len(w)), replace=False):
                w[at] = f"edit{k}"
            texts.append(" ".join(w))
    return [*texts, "a b", "A  b", "a c", "a b c d e f", "a b c d e f a b c d e f"]


def test_stage_drops_edited_copies(spark):
    texts = planted()
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (900, None), (901, " ")], "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    want = sorted(set(brute(texts)))
    assert len(want) < len(texts) - 55
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == [*want, 900] and ids.count(None) == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SF).count() == 0


def test_similarity_of_just_the_bound_links():
    sets = [np.arange(0, 9, dtype=np.uint64), np.arange(1, 10, dtype=np.uint64), np.arange(3, 10, dtype=np.uint64), np.empty(0, np.uint64)]
    assert sorted(tuple(sorted(e)) for e in near_copies.similar_forest(sets)) == [(0, 1)]
    assert near_copies.similar_forest([np.arange(4, dtype=np.uint64), np.arange(5, dtype=np.uint64)]) == [(0, 1)]


def test_rows_that_share_an_id_but_not_a_text(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (2, "h i j k l m n"), (2, "o p q r s t u")]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF)
    assert sorted(map(tuple, got.collect())) == [rows[0], rows[3], rows[4]]


def test_large_groups_in_blocks(spark, monkeypatch):
    """Copies of one text whose edits keep them apart from each other, but not from it; and texts that only some of them link."""
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", 12)
    monkeypatch.setattr(near_copies, "PIVOTS", 2)
    rng = np.random.default_rng(12)
    base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    texts = []
    for k in range(60):
        w = list(base)
        for at in rng.choice(len(w), 1 + k % 5, replace=False):
            w[at] = f"edit{k}"
        texts.append(" ".join(w))
    far = texts[7].split()
    far[3:12] = [f"far{i}" for i in range(9)]
    texts += [" ".join(far), " ".join(far[:190] + ["tail"] * 4), " ".join(base)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(set(brute(texts)))
    assert sorted(r.doc_id for r in near_copies.keep_one_of_each(docs).collect()) == want


def test_rows_beyond_the_broadcast_bound_and_clashing_names(spark, monkeypatch):
    from termweave.llm import simhash

    rows = [(1, "a b c d e f g", 1, 2), (1, "a b c d e f g", 1, 2), (2, "A b c d e f g", 1, 2), (2, "h i j k l m n", 1, 2), (2, "o p q r s t u", 1, 2), (None, "a b c d e f g", 1, 2), (5, None, 1, 2), (6, "", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__kept` int, `text_key` int")
    want = sorted(map(str, [rows[0], rows[3], rows[4], rows[5], rows[6]]))
    for keep in (simhash.keep_one_of_each, near_copies.keep_one_of_each):
        for bound in (10, 0):
            monkeypatch.setattr(simhash, "BROADCAST_ROWS", bound)
            got = keep(docs)
            assert got.columns == docs.columns and sorted(str(tuple(r)) for r in got.collect()) == want
        assert keep(docs.limit(0)).count() == 0
