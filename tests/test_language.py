"""The tagger against plain Viterbi and all sequences, the closure of variants against shortest paths, trees against prefixes."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from termweave.operators import tagger as TG
from termweave.operators import trees as TR
from termweave.operators import variants as VA

SENTENCES = [
    [("noun", "pain"), ("prep", "of"), ("noun", "chest")], [("adj", "lung"), ("noun", "cancer")], [("noun", "lung"), ("verb", "hurts")], [("det", "the"), ("adj", "old"), ("noun", "Man")],
    [("noun", "pain"), ("prep", "in"), ("det", "the"), ("noun", "lung")], [("verb", "pain"), ("noun", "man")], [("noun", "of")], [],
]
WORDS = [["pain", "of", "lung"], ["lung", "pain"], ["unseen", "of", "man"], ["the", "lung", "Hurts", "new"], ["of"], ["of", "of", "of", "of"], [], None, ["pain", None, "of"], ["lung", "pain"]]


@pytest.fixture(scope="module")
def model(spark):
    return TG.train(spark.createDataFrame([([{"category": c, "word": w} for c, w in s] + [{"category": None, "word": "x"}],) for s in SENTENCES], "items array<struct<category:string,word:string>>"))


def plain_costs():
    cats = sorted({c for s in SENTENCES for c, _ in s})
    emit, step, total = {}, {}, dict.fromkeys([*cats, "^"], 0)
    for s in SENTENCES:
        if s:
            for c, w in s:
                emit[c, w.lower()] = emit.get((c, w.lower()), 0) + 1
            for a, b in itertools.pairwise(["^", *[c for c, _ in s], "^"]):
                step[a, b] = step.get((a, b), 0) + 1
                total[a] += 1
    kinds = len({w for _, w in emit})
    of = lambda n, t, k: math.floor(-1000 * math.log((n + 1) / (t + k)) + 0.5)
    return cats, lambda c, w: of(emit.get((c, (w or "").lower()), 0), total[c], kinds + 1), lambda a, b: of(step.get((a, b), 0), total[a], len(cats) + 1)


def price(path, words, emit, step):
    return sum(emit(c, w) for c, w in zip(path, words, strict=True)) + sum(step(a, b) for a, b in itertools.pairwise(["^", *path, "^"]))


@pytest.mark.parametrize("broadcast", [TG.BROADCAST_WORDS, 0])
def test_tags_are_the_cheapest(spark, model, broadcast):
    cats, emit, step = plain_costs()
    df = spark.createDataFrame([(i, w, "x") for i, w in enumerate(WORDS)], "n int, words array<string>, tag string")
    got = {r.n: r.tags for r in TG.tag(df, model, broadcast_words=broadcast).collect()}
    assert len(got) == len(WORDS) and got[6] == [] and got[7] is None
    for i, w in enumerate(WORDS):
        if w:
            assert len(got[i]) == len(w)
            assert price(got[i], w, emit, step) == min(price(p, w, emit, step) for p in itertools.product(cats, repeat=len(w)))
    assert got[1] == got[9]


def test_long_sentences_against_plain_viterbi(spark, model):
    cats, emit, step = plain_costs()
    rng = random.Random(3)
    pool = ["pain", "of", "lung", "the", "man", "old", "new", "hurts", "in", "cancer"]
    df = spark.createDataFrame([(i, [rng.choice(pool) for _ in range(n)]) for i, n in enumerate((40, 300, 2000))], "n int, words array<string>")
    for r in TG.tag(df, model).collect():
        cost = {c: step("^", c) + emit(c, r.words[0]) for c in cats}
        for w in r.words[1:]:
            cost = {c: min(cost[b] + step(b, c) for b in cats) + emit(c, w) for c in cats}
        assert price(r.tags, r.words, emit, step) == min(cost[c] + step(c, "^") for c in cats)


def test_ties_go_to_the_first_category(spark):
    both = TG.train(spark.createDataFrame([([{"category": c, "word": "w"}],) for c in ("b", "a")], "items array<struct<category:string,word:string>>"))
    assert TG.tag(spark.createDataFrame([(["w", "w"],)], "words array<string>"), both).first().tags == ["a", "a"]
    empty = TG.train(spark.createDataFrame([], "items array<struct<category:string,word:string>>"))
    with pytest.raises(ValueError):
        TG.tag(spark.createDataFrame([(["w"],)], "words array<string>"), empty)


def test_saved_models(spark, model, tmp_path):
    TG.write_model(model, str(tmp_path / "m"))
    df = spark.createDataFrame([(w,) for w in WORDS], "words array<string>")
    rows = lambda m: sorted(map(str, TG.tag(df, m).collect()))
    assert rows(TG.read_model(spark, str(tmp_path / "m"))) == rows(model)


def test_chunker(spark):
    cases = {
        "noun": (1, True), "adj noun": (1, True), "noun prep noun": (2, True), "noun prep": (2, False), "noun prep noun prep noun": (3, True), "noun verb noun": (3, False), "noun noun det noun": (2, False),
        "prep noun prep noun": (2, True), "verb aux verb": (1, True), "noun conj noun": (2, False), "": (0, False),
    }
    df = spark.createDataFrame([(c, ["of" if t == "prep" else t for t in c.split()], c.split()) for c in cases], "c string, w array<string>, t array<string>")
    ph = TG.tagged_chunks(F.col("w"), F.col("t"))
    got = {r.c: (r.n, r.s) for r in df.select("c", F.size(ph).alias("n"), TG.is_simple_tagged(ph).alias("s")).collect()}
    assert got == cases
    row = df.where("c = 'noun prep noun prep noun'").select(TG.shown_phrases(ph).alias("v")).first()
    assert row.v == "[noun:noun][prep:of,noun:noun][prep:of,noun:noun]"
    inner = spark.createDataFrame([(["a", "in", "b", "in", "c"], ["noun", "prep", "noun", "prep", "noun"])], "w array<string>, t array<string>")
    assert inner.select(TG.is_simple_tagged(ph).alias("s")).first().s is False


def best_paths(terms, edges):
    out = {}
    for t, c in terms:
        todo, seen = [(0, 0, (), t, c)], {}
        while todo:
            d, n, h, w, k = todo.pop(0)
            if (w, k) in seen and seen[w, k] <= (d, n, h):
                continue
            seen[w, k] = d, n, h
            todo += [(d + x, n + 1, (*h, kind), w2, k2) for b, bc, w2, k2, kind, x in edges if b == w and (k is None or k == bc) and w2 is not None]
            todo.sort(key=lambda z: z[:3])
        out.update({(t, c, w, k): (d, "".join(h)) for (w, k), (d, n, h) in seen.items()})
    return out


def test_closure(spark):
    chain = [(f"w{i}", "noun", f"w{i + 1}", "noun", "i", 1) for i in range(12)]
    edges = [*chain, ("w12", "noun", "w0", "noun", "d", 2), ("w0", "noun", "w5", "noun", "s", 5), ("w3", "noun", "w3", "noun", "p", 0), ("w1", "noun", "a1", "adj", "d", 3), ("a1", "adj", "w9", "noun", "d", 0), ("w4", "verb", "z", "verb", "i", 1), (None, "noun", "w1", "noun", "x", 1), ("w2", "noun", None, "noun", "x", 1), ("w0", "noun", "w1", "noun", "bb", 1), chain[0]]
    terms = [("w0", "noun"), ("w4", None), ("a1", "adj"), ("nowhere", "noun"), ("w4", "verb")]
    with_cats = spark.createDataFrame([*terms, terms[0]], "term string, cat string")
    e = spark.createDataFrame(edges, "base string, base_cat string, word string, cat string, kind string, distance int")
    got = {(r.term, r.term_cat, r.word, r["cat"]): (r.var_level, r.history) for r in VA.closure(with_cats, e).collect()}
    assert got == best_paths(terms, edges)
    assert got["w0", "noun", "w12", "noun"][0] == 7 and ("w4", None, "z", "verb") in got
    with pytest.raises(RuntimeError):
        VA.closure(with_cats, e, most_rounds=3)
    with pytest.raises(Exception, match="negative"):
        VA.closure(with_cats, e.withColumn("distance", -F.col("distance"))).collect()
    assert VA.closure(with_cats.limit(0), e).count() == 0 and VA.closure(with_cats, e.limit(0)).count() == len(set(terms))


def test_codes(spark):
    rows = [(["C04.588.33", "C04.588", "C04.588.33.7"],), (["C04.5", "C04.58"],), (["A", "B.1"],), (["C1"],), ([],), (None,), ([None, "A.1"],), (["C04", "C040.1"],), (["C04-1.2", "C04.9", "C04.1"],)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "c array<string>").select(TR.common_ancestor(F.col("c")), TR.deepest(F.col("c"))).collect()]
    assert got == [("C04.588", "C04.588.33.7"), ("C04", "C04.5"), ("", "B.1"), ("C1", "C1"), (None, None), (None, None), ("A.1", "A.1"), ("", "C040.1"), ("", "C04-1.2")]
    one = spark.createDataFrame([("C04.588.33",), ("C",), (None,), ("",)], "c string").select(TR.ancestors(F.col("c")).alias("a"), TR.depth(F.col("c")).alias("d")).collect()
    assert one[0].a == ["C04", "C04.588"] and [r.d for r in one] == [3, 1, 0, 0] and one[1].a == []


@pytest.mark.parametrize("proper", [True, False])
@pytest.mark.parametrize("partitions", [1, 7])
def test_nearest_node(spark, proper, partitions):
    rng = random.Random(5)
    code = lambda: ".".join(rng.choice(["A", "A1", "B", "C-1", "C/2", "é"]) for _ in range(rng.randint(1, 6)))
    nodes = [code() for _ in range(120)] + [None, "", "A"]
    rows = [(i, code()) for i in range(600)] + [(1000 + i, "A.B.B1.A") for i in range(900)] + [(-1, None), (-2, "")]
    known = {n for n in nodes if n}

    def plain(c):
        if not c:
            return None
        s = c.split(".")
        return next((p for p in (".".join(s[:n]) for n in range(len(s) - proper, 0, -1)) if p in known), None)

    df = spark.createDataFrame([(*r, "x") for r in rows], "n long, code string, node string")
    got = TR.nearest_node(df, "code", spark.createDataFrame([(n,) for n in nodes], "node string"), proper=proper, partitions=partitions)
    assert got.columns == ["n", "code", "node", "nearest"]
    assert sorted((r.n, r.nearest) for r in got.collect()) == sorted((n, plain(c)) for n, c in rows)
    assert TR.nearest_node(df.limit(3), "code", spark.createDataFrame([], "node string")).where("nearest IS NULL").count() == 3
