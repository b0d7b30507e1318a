"""A hidden-Markov tagger for the words of terms and phrases, and a finite-state chunker over its tags.

Spark counts words by category and neighbouring categories over annotated sentences; costs are whole numbers, so that equal inputs
give equal tags everywhere.  Decoding joins words with their costs and folds over each sentence's array: built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What stands before and after a sentence.
EDGE = "^"
#: Categories of a model; the table of their neighbours is sent along with the query.
MOST_CATEGORIES = 64
#: Different words whose costs are broadcast; beyond it they are joined by a shuffle.
BROADCAST_WORDS = 200_000


def cost(n: Column, total: Column, kinds: Column) -> Column:
    """A thousandth of a nat, rounded: how unlikely one of n in total is, each of `kinds` counted once more."""
    return F.round(-1000 * F.ln((n + 1) / (total + kinds))).cast("long")


@dataclass
class Model:
    """words: (word, category, n); neighbours: (category, following, n), EDGE before the first and after the last."""

    words: DataFrame
    neighbours: DataFrame


def train(sentences: DataFrame, items: str = "items") -> Model:
    """Counts over sentences, whose column `items` is array<struct<category, word>>; items without a category or word are left out,
    sentences without items count nothing.  Both counts are summed before they are shuffled."""
    kept = F.filter(items, lambda i: i["category"].isNotNull() & i["word"].isNotNull())
    x = sentences.select(kept.alias("s")).where(F.size("s") > 0)
    words = x.select(F.explode("s").alias("i")).groupBy(F.lower("i.word").alias("word"), F.col("i.category").alias("category")).agg(F.count("*").alias("n"))
    cats = F.transform("s", lambda i: i["category"])
    pairs = F.zip_with(F.concat(F.array(F.lit(EDGE)), cats), F.concat(cats, F.array(F.lit(EDGE))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    neighbours = x.select(F.explode(pairs).alias("p")).groupBy(F.col("p.a").alias("category"), F.col("p.b").alias("following")).agg(F.count("*").alias("n"))
    return Model(words, neighbours)


def write_model(model: Model, folder: str) -> None:
    model.words.write.mode("overwrite").parquet(f"{folder}/words")
    model.neighbours.write.mode("overwrite").parquet(f"{folder}/neighbours")


def read_model(spark: SparkSession, folder: str) -> Model:
    return Model(spark.read.parquet(f"{folder}/words"), spark.read.parquet(f"{folder}/neighbours"))


def _cost(n: int, total: int, kinds: int) -> int:
    """`cost` for a few numbers on the driver."""
    return math.floor(-1000 * math.log((n + 1) / (total + kinds)) + 0.5)


def _tables(model: Model) -> tuple[list[str], list[list[int]], list[int], list[int], list[int], int]:
    """Categories in order, costs between them, at the start, at the end, totals by category, and how many different words there are."""
    rows = model.neighbours.limit(MOST_CATEGORIES**2 + 2 * MOST_CATEGORIES + 1).collect()
    cats = sorted({c for r in rows for c in (r.category, r.following)} - {EDGE})
    if len(cats) > MOST_CATEGORIES:
        raise ValueError(f"more than {MOST_CATEGORIES} categories")
    n = {(r.category, r.following): r.n for r in rows}
    total = {c: sum(v for (a, _), v in n.items() if a == c) for c in [EDGE, *cats]}
    of = lambda a, b: _cost(n.get((a, b), 0), total[a], len(cats) + 1)
    kinds = model.words.agg(F.count_distinct("word")).first()[0]
    return cats, [[of(a, b) for b in cats] for a in cats], [of(EDGE, b) for b in cats], [of(a, EDGE) for a in cats], [total[c] for c in cats], kinds


def _longs(x: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in x]) if x else F.array().cast("array<bigint>")


def best_path(costs: Column, between: Column, first: Column, last: Column, k: int) -> Column:
    """The cheapest path through array<array<bigint>> costs (a word's cost in each of k categories), as category numbers from 0.

    A fold forwards keeps, for each category, the least cost and the category before it, the smaller number among equals; a fold
    backwards follows them.  `between` has k lists: the costs of coming from each category.
    """
    least = lambda options: F.array_min(options)
    state = lambda cost, back: F.struct(cost.alias("cost"), back.alias("back"))
    begin = state(F.zip_with(first, F.get(costs, F.lit(0)), lambda a, b: a + b), F.array().cast("array<array<int>>"))

    def step(s: Column, emit: Column) -> Column:
        to = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: least(F.zip_with(s["cost"], F.sequence(F.lit(0), F.lit(k - 1)), lambda c, i: F.struct((c + F.get(F.get(between, i), j)).alias("c"), i.alias("i")))))
        both = F.transform(F.array(to), lambda t: state(F.zip_with(t, emit, lambda m, e: m["c"] + e), F.array_append(s["back"], F.transform(t, lambda m: m["i"]))))
        return both[0]  # the one-element array computes `to` once

    end = F.aggregate(F.slice(costs, 2, F.greatest(F.size(costs), F.lit(1))), begin, step)
    done = F.transform(F.array(end), lambda s: F.struct(least(F.zip_with(F.zip_with(s["cost"], last, lambda a, b: a + b), F.sequence(F.lit(0), F.lit(k - 1)), lambda c, i: F.struct(c.alias("c"), i.alias("i"))))["i"].alias("i"), s["back"].alias("back")))[0]
    path = F.transform(F.array(done), lambda d: F.aggregate(F.reverse(d["back"]), F.array(d["i"]), lambda p, b: F.array_append(p, F.get(b, F.element_at(p, -1)))))[0]
    return F.when(F.size(costs) > 0, F.reverse(path)).otherwise(F.array().cast("array<int>"))


def tag(sentences: DataFrame, model: Model, words: str = "words", name: str = "tags", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """sentences with `name`, the category of each of their words (array<string>): the likeliest sequence, ties to the category first in order.

    Each different sentence is decoded once, so that repeated ones cost nothing more.  Words that the model has not seen are equally
    unlikely in each category but for its size.  Null sentences have null tags, empty ones none; null words count as unseen; a model
    without categories raises an error.  Costs of words reach their places by a broadcast below broadcast_words different words, by a
    shuffle beyond it, in which very frequent words are split by adaptive execution.
    """
    cats, between, first, last, totals, kinds = _tables(model)
    k = len(cats)
    if not k:
        raise ValueError("the model has no categories")
    unseen = _longs([_cost(0, t, kinds + 1) for t in totals])
    seen = model.words.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("category", "n"))).alias("n"))
    seen = seen.select(F.col("word").alias("w"), F.array(*[cost(F.coalesce(F.col("n")[c], F.lit(0)), F.lit(t), F.lit(kinds + 1)) for c, t in zip(cats, totals, strict=True)]).alias("costs"))
    # A sentence travels as its digest: its words are not copied to every place.
    x = sentences.withColumn("__id", F.when(F.size(words) > 0, F.sha2(F.to_json(words), 256)))
    places = x.where("__id IS NOT NULL").select(F.col("__id").alias("id"), F.col(words).alias("s")).dropDuplicates(["id"]).select("id", F.posexplode("s").alias("at", "word"))
    joined = places.join(F.broadcast(seen) if kinds <= broadcast_words else seen, F.lower("word") == F.col("w"), "left")
    whole = joined.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("costs", unseen).alias("costs")))).alias("p"))
    path = best_path(F.transform("p", lambda p: p["costs"]), F.array(*[_longs(r) for r in between]), _longs(first), _longs(last), k)
    names = F.array(*[F.lit(c) for c in cats])
    tags = whole.select("id", F.transform(path, lambda i: F.get(names, i)).alias("__t"))
    x = x.join(tags, F.col("__id") == F.col("id"), "left")
    return x.withColumn(name, F.when(F.col(words).isNotNull(), F.coalesce("__t", F.array().cast("array<string>")))).drop("__id", "id", "__t")


# The chunker: an automaton whose states are kinds of categories.

#: Categories that open a phrase, and those of verbs; all others are nominal.
OPENING, VERBAL = ("prep", "conj", "compl"), ("verb", "aux", "modal")


def kind(tag: Column) -> Column:
    return F.when(tag.isin(*OPENING), "o").when(tag.isin(*VERBAL), "v").when(tag == "det", "d").otherwise("n")


#: Where one kind after another begins a phrase: an opening word always, verbs after all but verbs, other words after verbs, and a determiner after a noun.
CUTS = ("oo", "vo", "do", "no", "ov", "dv", "nv", "vn", "vd", "nd")


def tagged_chunks(words: Column, tags: Column) -> Column:
    """Phrases of tagged words: array<array<struct<word, tag>>>; none for no words."""
    kinds = F.transform(tags, kind)
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i == 0) | F.concat(F.get(kinds, i - 1), F.get(kinds, i)).isin(*CUTS))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(words)))
    both = F.arrays_zip(words.alias("word"), tags.alias("tag"))
    cut = F.zip_with(starts, ends, lambda a, b: F.slice(both, a + 1, b - a))
    return F.when(F.size(words) > 0, cut).otherwise(F.array().cast("array<array<struct<word:string,tag:string>>>"))


def is_simple_tagged(phrases: Column) -> Column:
    """One phrase; or more where the second is a preposition with something after it, and all later ones are `of` with something after it."""
    pp = lambda p: (p[0]["tag"] == "prep") & (F.size(p) > 1)
    later = F.forall(F.slice(phrases, 3, F.greatest(F.size(phrases), F.lit(1))), lambda p: pp(p) & (F.lower(p[0]["word"]) == "of"))
    return F.when(F.size(phrases) == 1, True).when(F.size(phrases) >= 2, pp(F.get(phrases, F.lit(1))) & later).otherwise(False)


def shown_phrases(phrases: Column) -> Column:
    """Phrases as they print: [tag:word,...][...]."""
    return F.array_join(F.transform(phrases, lambda p: F.concat(F.lit("["), F.array_join(F.transform(p, lambda i: F.concat_ws(":", i["tag"], i["word"])), ","), F.lit("]"))), "")
