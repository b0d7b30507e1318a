"""Lexical variants of terms over a relational lexicon."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import steps


def categories(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(term, cat): each term with each of its categories; without any, a row with a null category.  lexicon: (form, cat)."""
    cats = lexicon.groupBy("form").agg(F.array_sort(F.collect_set("cat")).alias("cats"))
    x = terms.where("term <> ''").select("term").distinct()
    return x.join(cats, F.col("term") == F.col("form"), "left").select("term", F.explode_outer("cats").alias("cat"))


def expand(with_cats: DataFrame, edges: DataFrame, depth: int = 2) -> DataFrame:
    """(term, term_cat, word, cat, var_level, history): words reached over at most depth edges, by their least distance.

    edges: (base, base_cat, word, cat, kind, distance).  Level 0 is the term itself.  Of paths as short, the first history counts.
    """
    frontier = with_cats.select("term", F.col("cat").alias("term_cat"), F.col("term").alias("word"), "cat", F.lit(0).alias("var_level"), F.lit("").alias("history"))
    out = [frontier]
    e = edges.select(F.col("base").alias("e_base"), F.col("base_cat").alias("e_cat"), F.col("word").alias("e_word"), F.col("cat").alias("e_to"), "kind", "distance")
    for _ in range(depth):
        hop = frontier.join(e, (F.col("word") == F.col("e_base")) & (F.col("cat").isNull() | (F.col("cat") == F.col("e_cat"))))
        frontier = hop.select("term", "term_cat", F.col("e_word").alias("word"), F.col("e_to").alias("cat"), (F.col("var_level") + F.col("distance")).alias("var_level"), F.concat("history", "kind").alias("history"))
        out.append(frontier)
    rows = reduce(DataFrame.unionByName, out)
    return rows.groupBy("term", "term_cat", "word", "cat").agg(F.min(F.struct("var_level", "history")).alias("m")).select("term", "term_cat", "word", "cat", "m.var_level", "m.history")


def variant_rows(expanded: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(term, term_cats, word, cats, var_level, history, first_word, roots): the eight output columns; `none` for no category, [] for no roots."""
    x = expanded.groupBy("term", "term_cat", "word").agg(F.array_sort(F.collect_set("cat")).alias("cs"), F.min(F.struct("var_level", "history")).alias("m"))
    x = x.withColumn("roots", F.lit("[]")) if roots is None else x.join(roots, "word", "left").withColumn("roots", F.coalesce("roots", F.lit("[]")))
    return x.select("term", F.coalesce("term_cat", F.lit("none")).alias("term_cats"), "word", T.simplify_categories(F.col("cs")).alias("cats"), F.col("m.var_level").alias("var_level"), F.col("m.history").alias("history"), F.get(T.words(F.lower("word")), F.lit(0)).alias("first_word"), "roots")


def variant_lines(rows: DataFrame) -> DataFrame:
    """(term, word, value): the eight columns of variant_rows as lines."""
    return rows.select("term", "word", F.concat_ws("|", "term", "term_cats", "word", "cats", "var_level", "history", "first_word", "roots").alias("value"))


#: A path's worth: its distance, then its number of edges, then their kinds in order.
PATH = "struct<var_level:int,steps:int,kinds:array<string>>"


def closure(with_cats: DataFrame, edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(term, term_cat, word, cat, var_level, history): every word that edges lead to, over any number of them, by its best path.

    edges as for `expand`; distances must not be negative, and null ends lead nowhere.  Of paths to a word the shortest counts, of
    those the one with fewest edges, then the first kinds; so cycles, loops and repeated edges improve nothing and the rounds end.
    In a round only words whose path has just become better go on; each is kept at its best before anything is shuffled.  A round writes
    those alone to the checkpoint folder, where they stay, since the result is read from them; as many rounds are needed as the
    longest best path has edges, and more than most_rounds raise an error.  Edges are never broadcast: what Spark expects of their
    size comes from files that they were made from, and a fraction of their bytes may be all that it sees.
    """
    key = ("term", "term_cat", "word", "cat")
    bad = F.when(F.col("distance") < 0, F.raise_error(F.lit("a negative distance"))).otherwise(F.col("distance").cast("int"))
    e = edges.where("base IS NOT NULL AND word IS NOT NULL").select(F.col("base").alias("e_base"), F.col("base_cat").alias("e_cat"), F.col("word").alias("e_word"), F.col("cat").alias("e_to"), "kind", bad.alias("distance")).distinct()
    folder = f"{steps.checkpoint_root(edges.sparkSession)}/closure-{uuid.uuid4().hex}"
    e = steps.stored(e, f"{folder}/edges").hint("merge")
    start = F.struct(F.lit(0).alias("var_level"), F.lit(0).alias("steps"), F.array().cast("array<string>").alias("kinds"))
    better = steps.stored(with_cats.select("term", F.col("cat").alias("term_cat"), F.col("term").alias("word"), "cat", start.alias("path")).distinct(), f"{folder}/rounds/round=0")
    for k in range(most_rounds):
        hop = better.join(e, (F.col("word") == F.col("e_base")) & (F.col("cat").isNull() | (F.col("cat") == F.col("e_cat"))))
        path = F.struct((F.col("path.var_level") + F.col("distance")).alias("var_level"), (F.col("path.steps") + 1).alias("steps"), F.array_append("path.kinds", F.col("kind")).alias("kinds"))
        found = hop.select("term", "term_cat", F.col("e_word").alias("word"), F.col("e_to").alias("cat"), path.alias("path")).groupBy(*key).agg(F.min("path").alias("path")).withColumn("new", F.lit(True))
        # One minimum by key over what all rounds wrote and what is found says whether it is better.
        known = edges.sparkSession.read.schema(better.schema).parquet(f"{folder}/rounds").select(*better.columns)
        both = known.withColumn("new", F.lit(False)).unionByName(found).groupBy(*key).agg(F.min(F.struct("path", "new")).alias("b"))
        better = steps.stored(both.where("b.new").select(*key, F.col("b.path").alias("path")), f"{folder}/rounds/round={k + 1}")
        if better.isEmpty():
            return known.groupBy(*key).agg(F.min("path").alias("path")).select(*key, "path.var_level", F.array_join("path.kinds", "").alias("history"))
    raise RuntimeError(f"variants did not settle in {most_rounds} rounds")
