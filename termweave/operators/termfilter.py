"""The term filter: status and duplicate exclusions within concept runs, restored preferred names, tagged lines and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .runs import with_runs

PREPOSITIONS = ("of", "in", "to", "for", "with", "by", "on", "at", "from", "without", "due")


def prepare(terms: DataFrame, assume_sorted: bool = False) -> DataFrame:
    """terms with run_id, nmstr, nm_types, pref and tss; with assume_sorted a concept is one run, and nothing is sorted for it."""
    n = T.normalize(F.col("str"))
    x = terms.withColumn("n", n).withColumn("nmstr", F.col("n.norm")).withColumn("nm_types", F.col("n.types")).drop("n")
    x = x.withColumn("pref", F.col("ts").isin("P", "p") & (F.col("stt") == "PF")).withColumn("tss", F.col("ts").isin("p", "s"))
    return x.withColumn("run_id", F.col("cui")) if assume_sorted else with_runs(x, "cui", "line_no")


def filter_terms(prepared: DataFrame, simple: Column | None = None) -> DataFrame:
    """prepared with status (y, ntss, nnorm or nsynt), final_status, out_line, out_ts, restored and restored_from.

    Within a run: equal lines count once, save those excluded by status; of rows equal in (nmstr, cui, sab) the greatest (lui, sui,
    aui, line) stays; with `simple`, strings for which it is false go too.  Where a row of the run survives, each preferred row that
    does not, and is the greatest preferred one of its string, comes back with status P.  All windows share the run's partitioning.
    """
    order = [F.desc(c) for c in ("lui", "sui", "aui", "line", "line_no")]
    x = prepared.withColumn("dup_rn", F.row_number().over(Window.partitionBy("run_id", "line").orderBy(F.desc("line_no"))))
    x = x.where("tss or dup_rn = 1")
    key = ("run_id", "nmstr", "cui", "sab")
    x = x.withColumn("norm_rn", F.row_number().over(Window.partitionBy(*key, "tss").orderBy(*order)))
    status = F.when(F.col("tss"), "ntss").when(F.col("norm_rn") > 1, "nnorm")
    if simple is not None:
        status = status.when(~simple, "nsynt")
    x = x.withColumn("status", status.otherwise("y"))
    eligible = F.col("pref") & (F.col("dup_rn") == 1)
    x = x.withColumn("eligible", eligible).withColumn("pref_rn", F.when(F.col("eligible"), F.row_number().over(Window.partitionBy(*key, "eligible").orderBy(*order))))
    x = x.withColumn("survivor", F.max(F.col("status") == "y").over(Window.partitionBy("run_id")))
    restored = F.coalesce((F.col("pref_rn") == 1) & (F.col("status") != "y") & F.col("survivor"), F.lit(False))
    x = x.withColumn("restored", restored).withColumn("final_status", F.when(F.col("restored"), "y").otherwise(F.col("status")))
    x = x.withColumn("out_line", F.when(F.col("restored"), T.restore_status(F.col("line"))).otherwise(F.col("line"))).withColumn("out_ts", F.when(F.col("restored"), F.lit("P")).otherwise(F.col("ts")))
    # What a row that came back had been excluded for.
    x = x.withColumn("restored_from", F.when(F.col("restored"), F.col("status")))
    return x.drop("dup_rn", "norm_rn", "eligible")


def types_text(types: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(types, ","), F.lit("]"))


def tagged_lines(filtered: DataFrame) -> DataFrame:
    """(value): `y|line`, or the reason, the line, its normalization types and normalized string."""
    s = F.col("final_status")
    return filtered.select(F.when(s == "y", F.concat(F.lit("y|"), F.col("out_line"))).otherwise(F.concat_ws("|", s, F.col("line"), types_text(F.col("nm_types")), F.col("nmstr"))).alias("value"))


def ordered_tagged_lines(filtered: DataFrame, *keep: str) -> DataFrame:
    """(ord, value), and the columns to keep: tagged_lines with what orders them in a text file: by run, exclusions by status, duplicate and syntax, then what is kept."""
    rank = F.when(F.col("final_status") == "ntss", 0).when(F.col("final_status") == "nnorm", 1).when(F.col("final_status") == "nsynt", 2).otherwise(3)
    x = filtered.withColumn("ord", F.struct(F.col("run_id"), rank.alias("rank"), "nmstr", "cui", "sab", "lui", "sui", "aui", "out_line"))
    s = F.col("final_status")
    return x.select("ord", *keep, F.when(s == "y", F.concat(F.lit("y|"), F.col("out_line"))).otherwise(F.concat_ws("|", s, F.col("line"), types_text(F.col("nm_types")), F.col("nmstr"))).alias("value"))


def normalization_counts(filtered: DataFrame) -> DataFrame:
    """(indicator, n, types): of rows excluded as duplicates, each list of types (icn) and each single type (ibn); restoring changes nothing."""
    x = filtered.where("status = 'nnorm'")
    both = F.concat(F.array(F.struct(F.lit("icn").alias("indicator"), types_text(F.col("nm_types")).alias("types"))), F.transform("nm_types", lambda t: F.struct(F.lit("ibn").alias("indicator"), t.alias("types"))))
    return x.select(F.explode(both).alias("c")).groupBy("c.indicator", "c.types").agg(F.count("*").alias("n")).select("indicator", "n", "types")


def status_counts(filtered: DataFrame) -> DataFrame:
    """One row: rows excluded by status p and s and by syntax, less those restored, and preferred rows restored."""
    count = lambda c: F.count_if(c)
    gone = ~F.col("restored")
    return filtered.agg(count((F.col("status") == "ntss") & (F.col("ts") == "p") & gone).alias("p"), count((F.col("status") == "ntss") & (F.col("ts") == "s") & gone).alias("s"), count(F.col("restored")).alias("pref"), count((F.col("status") == "nsynt") & gone).alias("synt"))


def counter_lines(filtered: DataFrame) -> DataFrame:
    """(ord, value): all counters as lines, normalization lists first and descending; a few rows, in the order of ord."""
    n = normalization_counts(filtered).select(F.concat_ws("|", "indicator", "n", "types").alias("value"), F.row_number().over(Window.orderBy(F.desc("indicator"), F.desc("types"))).alias("ord"))
    kinds = (("it", "p"), ("it", "s"), ("is", "pref"), ("is", "synt"))
    s = status_counts(filtered).select(F.posexplode(F.array(*[F.concat_ws("|", F.lit(k), F.col(c), F.lit(c)) for k, c in kinds])).alias("at", "value"))
    # There are fewer lists of types than a thousand.
    return n.select("ord", "value").unionByName(s.select((F.col("at") + 1001).alias("ord"), "value"))


STEPS = ("nos", "uninv", "parenth", "case", "hyphen", "poss")


class ObservedLines:
    """The lines of counter_lines from what was observed while filtered rows were written."""

    def __init__(self, observation):
        self.observation = observation

    def terms(self) -> int:
        return self.observation.get["terms"]

    def __call__(self) -> list[str]:
        seen = self.observation.get
        lists = {f"[{','.join(s for j, s in enumerate(STEPS) if i >> j & 1)}]": seen[f"c{i}"] for i in range(1 << len(STEPS)) if seen[f"c{i}"]}
        single = {s: sum(seen[f"c{i}"] for i in range(1 << len(STEPS)) if i >> j & 1) for j, s in enumerate(STEPS)}
        icn = [f"icn|{n}|{t}" for t, n in sorted(lists.items(), reverse=True)]
        ibn = [f"ibn|{n}|{t}" for t, n in sorted(single.items(), reverse=True) if n]
        return icn + ibn + [f"{kind}|{seen[c]}|{c}" for kind, c in (("it", "p"), ("it", "s"), ("is", "pref"), ("is", "synt"))]


def observed_lines(filtered: DataFrame) -> tuple[DataFrame, ObservedLines]:
    """(value): ordered_tagged_lines in order, and what gives the counter lines once they have been written: no second pass.

    Steps of normalization come in one order, so a list of them is one of 64 numbers, each counted as rows go by.  Rows are counted
    after they are sorted, as sorting reads what comes before it twice.
    """
    observation = Observation("counters")
    at = sum((F.when(F.array_contains("nm_types", s), 1 << j).otherwise(0) for j, s in enumerate(STEPS)), F.lit(0))
    x = filtered.select("*", at.alias("__steps"))
    x = ordered_tagged_lines(x, "status", "ts", "restored", "__steps").orderBy("ord")
    one = lambda c: F.count_if(c)
    gone = ~F.col("restored")
    counts = [one((F.col("status") == "nnorm") & (F.col("__steps") == i)).alias(f"c{i}") for i in range(1 << len(STEPS))]
    status = [one((F.col("status") == "ntss") & (F.col("ts") == t) & gone).alias(t) for t in ("p", "s")]
    x = x.observe(observation, F.count(F.lit(1)).alias("terms"), *counts, *status, one(F.col("restored")).alias("pref"), one((F.col("status") == "nsynt") & gone).alias("synt"))
    return x.select("value"), ObservedLines(observation)


def preferred_counts(prepared: DataFrame) -> DataFrame:
    """(cui, before, after): preferred rows of a concept's runs, and those left when equal lines and equal strings of a source count once."""
    x = prepared.where("pref")
    return x.groupBy("cui", "run_id").agg(F.count("*").alias("b"), F.countDistinct("nmstr", "sab").alias("a")).groupBy("cui").agg(F.sum("b").alias("before"), F.sum("a").alias("after"))


def duplicate_pairs(prepared: DataFrame) -> DataFrame:
    """(loser, winner): ids of duplicates by normalized string, and of the row that stays."""
    w = Window.partitionBy("run_id", "nmstr", "cui", "sab").orderBy(*[F.desc(c) for c in ("lui", "sui", "aui", "line")])
    x = prepared.where("not tss").withColumn("rn", F.row_number().over(w)).withColumn("winner", F.first("aui").over(w))
    return x.where("rn > 1").select(F.col("aui").alias("loser"), "winner")


def chunks(words: Column) -> Column:
    """Phrases of a word list, cut before each preposition: array<array<string>>."""
    is_prep = lambda w: w.isin(*PREPOSITIONS)
    begins = F.filter(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.when((i == 1) | is_prep(F.get(words, i - 1)), i)), lambda i: i.isNotNull())
    ends = F.concat(F.transform(F.slice(begins, 2, F.size(begins)), lambda i: i - 1), F.array(F.size(words)))
    return F.when(F.size(words) > 0, F.zip_with(begins, ends, lambda a, b: F.slice(words, a, b - a + 1))).otherwise(F.array().cast("array<array<string>>"))


def is_simple(phrases: Column) -> Column:
    """One phrase; or more where the second is a preposition with something after it, and all later ones are `of` with something after it."""
    pp = lambda p: p[0].isin(*PREPOSITIONS) & (F.size(p) > 1)
    later = F.forall(F.slice(phrases, 3, F.greatest(F.size(phrases), F.lit(1))), lambda p: (p[0] == "of") & (F.size(p) > 1))
    return F.when(F.size(phrases) == 1, True).when(F.size(phrases) >= 2, pp(F.get(phrases, F.lit(1))) & later).otherwise(False)


def syntax_dump(prepared: DataFrame, *keep: str) -> DataFrame:
    """(value), and the columns to keep: phrases | items | concept | source | code | normalized string | words of each phrase; 1|1 where there are no items."""
    x = prepared.withColumn("ph", chunks(T.words(F.col("nmstr"))))
    n = F.aggregate("ph", F.lit(0), lambda a, p: a + F.size(p))
    shape = F.when(n == 0, "1|1").otherwise(F.concat_ws("|", F.size("ph"), n))
    return x.select(*keep, F.concat_ws("|", shape, "cui", "sab", "code", "nmstr", F.to_json("ph")).alias("value"))


def tagged_syntax_dump(tagged: DataFrame, *keep: str) -> DataFrame:
    """(value), and the columns to keep: as syntax_dump, of frames with `ph`, phrases of tagged words, which print as [tag:word,...]."""
    from .tagger import shown_phrases

    n = F.aggregate("ph", F.lit(0), lambda a, p: a + F.size(p))
    shape = F.when(n == 0, "1|1").otherwise(F.concat_ws("|", F.size("ph"), n))
    return tagged.select(*keep, F.concat_ws("|", shape, "cui", "sab", "code", "nmstr", shown_phrases(F.col("ph"))).alias("value"))
