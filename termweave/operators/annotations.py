"""Annotated documents as nested frames, and the reports over them.

An utterance row: doc_id, utt_no, label, text, phrases; a phrase: no, text, items, counts, cands, mappings, pos.  An item: category, tag,
inputmatch, lexmatch, tokens; a candidate: the thirteen fields of EV; a mapping: neg_score, evs.  match_map pairs words p1 to p2 of
the phrase with words m1 to m2 of the term.  Lists print as [a,b].  Reports whose source form cannot work are built as they are meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

KEYS = ("doc_id", "utt_no", "label")
SPAN = "struct<start:int,length:int>"
EV = f"struct<neg_value:int,cui:string,meta_term:string,preferred_name:string,meta_words:array<string>,sem_types:array<string>,match_map:array<struct<p1:int,p2:int,m1:int,m2:int,lex:int>>,involves_head:string,is_overmatch:string,sources:array<string>,pos:array<{SPAN}>,status:int,negated:int>"
ITEM = "struct<category:string,tag:string,inputmatch:array<string>,lexmatch:array<string>,tokens:array<string>>"
PHRASE = f"struct<no:int,text:string,items:array<{ITEM}>,counts:struct<total:int,excluded:int,pruned:int,remaining:int>,cands:array<{EV}>,mappings:array<struct<neg_score:int,evs:array<{EV}>>>,pos:{SPAN}>"


def shown(items: Column) -> Column:
    """A list as it prints: [a,b]."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def spans(pos: Column) -> Column:
    return shown(F.transform(pos, lambda s: F.concat_ws("/", s["start"], s["length"])))


def phrase_words(items: Column) -> Column:
    """All tokens of a phrase, in order."""
    return F.flatten(F.transform(items, lambda i: i["tokens"]))


def matched_words(words: Column, match_map: Column) -> Column:
    """The words at the positions, from 1, that a match map names, in its order."""
    at = F.flatten(F.transform(match_map, lambda m: F.sequence(m["p1"], m["p2"])))
    return F.filter(F.transform(at, lambda i: F.get(words, i - 1)), lambda w: w.isNotNull())


def phrases(u: DataFrame) -> DataFrame:
    return u.select(*KEYS, F.explode("phrases").alias("p")).select(*KEYS, "p.*")


def items(u: DataFrame) -> DataFrame:
    return phrases(u).select(*KEYS, "no", "text", F.posexplode("items").alias("item_no", "i")).select(*KEYS, "no", "text", "item_no", "i.*")


def candidates(u: DataFrame) -> DataFrame:
    return phrases(u).select(*KEYS, "no", "text", F.posexplode("cands").alias("cand_no", "ev"))


def mapped(u: DataFrame, first_only: bool = False) -> DataFrame:
    """One row a mapping: i of n."""
    m = F.slice("mappings", 1, 1) if first_only else F.col("mappings")
    return phrases(u).select(*KEYS, "no", "text", F.size(m).alias("n"), F.posexplode(m).alias("k", "m")).select(*KEYS, "no", "text", (F.col("k") + 1).alias("i"), "n", "m.neg_score", "m.evs")


def _where(u: DataFrame, keep) -> DataFrame:
    return u.withColumn("phrases", F.filter("phrases", keep)).where(F.size("phrases") > 0)


def alnum_only(u: DataFrame) -> DataFrame:
    return u.withColumn("phrases", F.filter("phrases", lambda p: T.has_alnum(p["text"])))


def without_stop_phrases(ph: DataFrame, stop: DataFrame) -> DataFrame:
    """Phrases whose lower-cased text is not in stop (phrase)."""
    return ph.withColumn("__lc", F.lower("text")).join(stop.select(F.col("phrase").alias("__lc")).distinct(), "__lc", "left_anti").drop("__lc")


def _trivial(p: Column) -> Column:
    one = p["cands"][0]
    return (F.size(p["cands"]) == 0) | ((F.size(p["cands"]) == 1) & ((F.lower(p["text"]) == F.lower(one["meta_term"])) | (T.normalize(p["text"])["norm"] == T.normalize(one["meta_term"])["norm"])))


def drop_trivial(u: DataFrame) -> DataFrame:
    """Without phrases that have no candidate, or one that matches the whole phrase; utterances without any other phrase go."""
    return _where(u, lambda p: ~_trivial(p))


def with_null(u: DataFrame) -> DataFrame:
    return u.where(F.exists("phrases", lambda p: F.size(p["cands"]) == 0))


def with_candidates(u: DataFrame) -> DataFrame:
    return u.where(F.exists("phrases", lambda p: F.size(p["cands"]) > 0))


def threshold_prefix(ph: DataFrame, threshold: int) -> DataFrame:
    """Candidates, best first, up to the first whose score is below the threshold."""
    bad = F.array_position(F.transform("cands", lambda e: -e["neg_value"] < threshold), F.lit(True)).cast("int")
    return ph.withColumn("cands", F.when(bad > 0, F.slice("cands", 1, bad - 1)).otherwise(F.col("cands")))


def first_of_concept(ph: DataFrame) -> DataFrame:
    """The first candidate of each preferred name, in order."""
    first = lambda names: F.filter("cands", lambda e, k: F.array_position(names, e["preferred_name"]) == k + 1)
    return ph.withColumn("cands", F.transform(F.array(F.transform("cands", lambda e: e["preferred_name"])), first)[0])


def truncated(ph: DataFrame, n: int, column: str) -> DataFrame:
    """The first n of an array, and how many were not printed."""
    return ph.withColumn("unprinted", F.greatest(F.size(column) - n, F.lit(0))).withColumn(column, F.slice(column, 1, n))


def semtype_rows(u: DataFrame, first_only: bool = False) -> DataFrame:
    """(label, no, semtype, term, concept): mappings to candidates to semantic types."""
    x = mapped(u, first_only).select(*KEYS, "no", F.explode("evs").alias("ev")).select(*KEYS, "no", F.explode("ev.sem_types").alias("semtype"), F.col("ev.meta_term").alias("term"), F.col("ev.preferred_name").alias("concept"))
    return x


def running_union(u: DataFrame) -> DataFrame:
    """(doc_id, utt_no, n, saved): after each utterance, the sorted set of (semtype, term, concept) seen in its document so far."""
    x = semtype_rows(u).groupBy("doc_id", "utt_no").agg(F.collect_set(F.concat_ws("|", "semtype", "term", "concept")).alias("s"))
    x = u.select("doc_id", "utt_no").distinct().join(x, ["doc_id", "utt_no"], "left")
    w = Window.partitionBy("doc_id").orderBy("utt_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("saved", F.array_sort(F.array_distinct(F.flatten(F.collect_list("s").over(w)))))
    return x.select("doc_id", "utt_no", F.size("saved").alias("n"), F.array_join("saved", ";").alias("saved"))


def headings(rows: DataFrame) -> DataFrame:
    """(doc_id, semtype, term, concept, heading): distinct rows in order, marked where the semantic type changes."""
    x = rows.select("doc_id", "semtype", "term", "concept").distinct()
    w = Window.partitionBy("doc_id").orderBy("semtype", "term", "concept")
    return x.withColumn("heading", ~F.col("semtype").eqNullSafe(F.lag("semtype").over(w)))


def type_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with the name of their semtype, <unknown> where names (abbrev, name) has none."""
    return rows.join(names.select(F.col("abbrev").alias("semtype"), "name"), "semtype", "left").withColumn("name", F.coalesce("name", F.lit("<unknown>")))


def composite_phrases(u: DataFrame) -> DataFrame:
    """(doc_id, utt_no, island, value): a phrase and one or more prepositional phrases after it as `length|[prepositions]|[lower-cased texts]`; islands count on.

    A prepositional phrase begins with a preposition, and gives the words that its item matched in the lexicon.
    """
    x = phrases(u).withColumn("pp", F.coalesce(F.get("items", F.lit(0))["category"] == "prep", F.lit(False)))
    w = Window.partitionBy("doc_id", "utt_no").orderBy("no")
    x = x.withColumn("island", F.sum((~F.col("pp")).cast("int")).over(w))
    # A composite phrase is within one utterance.
    g = x.groupBy("doc_id", "utt_no", "island").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("no", "pp", F.lower("text").alias("t"), F.get("items", F.lit(0))["lexmatch"].alias("prep")))).alias("ps"))
    g = g.where("n >= 2")
    preps = F.flatten(F.transform(F.filter("ps", lambda p: p["pp"]), lambda p: p["prep"]))
    return g.select("doc_id", "utt_no", "island", F.concat_ws("|", "n", shown(preps), shown(F.transform("ps", lambda p: p["t"]))).alias("value"))


# Reports: each gives (doc_id, utt_no, value), the lines of an utterance in order.


def _report(x: DataFrame, value: Column) -> DataFrame:
    return x.select("doc_id", "utt_no", value.alias("value"))


def _lines(x: DataFrame, *parts) -> DataFrame:
    return _report(x, F.concat_ws("|", *parts))


def label_text(u: DataFrame) -> DataFrame:
    return _lines(u, "label", "text")


def headed(u: DataFrame) -> DataFrame:
    return _report(u, F.concat(F.lit("Processing "), "label", F.lit(": "), "text"))


def mapping_summary(u: DataFrame, first_only: bool = False) -> DataFrame:
    """Lines for each utterance, phrase, and candidate of a mapping, in that order: `label|i|n|score|cui|term|concept|[types]|[positions]`."""
    bar = lambda *c: F.concat_ws("|", "label", *c)

    def of_phrase(p: Column) -> Column:
        maps = F.slice(p["mappings"], 1, 1) if first_only else p["mappings"]
        one = lambda m, k: F.transform(m["evs"], lambda e: bar(k + 1, F.size(p["mappings"]), -m["neg_score"], e["cui"], e["meta_term"], e["preferred_name"], shown(e["sem_types"]), spans(e["pos"])))
        return F.concat(F.array(bar(F.lit("PHRASE"), p["text"])), F.flatten(F.transform(maps, one)))

    return _report(u, F.explode(F.concat(F.array(bar(F.lit("UTTERANCE"), "text")), F.flatten(F.transform("phrases", of_phrase)))))


def concepts_joined(u: DataFrame) -> DataFrame:
    return _lines(mapped(u), "label", F.array_join(F.transform("evs", lambda e: e["preferred_name"]), " AND "))


def not_in_lexicon(u: DataFrame) -> DataFrame:
    """`tokens|input|utterance|label|` for each item that the lexicon lacks; the utterance's text goes along with its phrases."""
    x = u.select(*KEYS, F.col("text").alias("utt"), F.explode("phrases").alias("p")).select(*KEYS, "utt", F.explode("p.items").alias("i")).where("i.category = 'not_in_lex'")
    return _lines(x, F.array_join("i.tokens", " "), F.array_join("i.inputmatch", " "), "utt", "label", F.lit(""))


def syntax(u: DataFrame) -> DataFrame:
    return _report(items(u), F.concat_ws(":", "category", shown(F.col("tokens"))))


def syntactic_pattern(u: DataFrame, with_text: bool = False) -> DataFrame:
    x = phrases(u).where(F.size("items") > 0).withColumn("pattern", F.array_join(F.transform("items", lambda i: i["category"]), "|"))
    return _report(x, F.concat("pattern", F.lit(":"), "text") if with_text else F.col("pattern"))


def potential_stop_phrases(u: DataFrame) -> DataFrame:
    return _lines(phrases(u).where(F.size("cands") == 0), F.lower("text"), shown(F.transform("items", lambda i: i["category"])))


def phrase_texts(u: DataFrame) -> DataFrame:
    return _report(phrases(u), F.lower("text"))


def match_differences(u: DataFrame) -> DataFrame:
    """`[input]|[lexical]|item|text` of items whose input and lexical matches differ in more than case."""
    from ..sources.annotated import item_text

    low = lambda c: F.transform(c, F.lower)
    x = phrases(u).select(*KEYS, "text", F.explode("items").alias("i")).where((F.size("i.lexmatch") > 0) & (low("i.inputmatch") != low("i.lexmatch")))
    return _lines(x, shown(F.col("i.inputmatch")), shown(F.col("i.lexmatch")), item_text(F.col("i")), "text")


def candidate_counts(u: DataFrame) -> DataFrame:
    """The number of each phrase's candidates, on a line of its own."""
    return _lines(phrases(u), F.size("cands"))


def _candidate_text(x: DataFrame) -> DataFrame:
    """`concept|term|[words of the phrase that it matched]|label`."""
    return _lines(x, "ev.preferred_name", "ev.meta_term", shown(matched_words(F.col("words"), F.col("ev.match_map"))), "label")


def candidate_texts(u: DataFrame) -> DataFrame:
    return _candidate_text(phrases(u).select(*KEYS, phrase_words(F.col("items")).alias("words"), F.explode("cands").alias("ev")))


def mapping_texts(u: DataFrame, unique: bool = False) -> DataFrame:
    x = phrases(u).where("size(mappings) = 1") if unique else phrases(u)
    x = x.select(*KEYS, phrase_words(F.col("items")).alias("words"), F.explode("mappings").alias("m"))
    return _candidate_text(x.select(*KEYS, "words", F.explode("m.evs").alias("ev")))


def mapping_counts(u: DataFrame) -> DataFrame:
    """The number of each phrase's mappings, on a line of its own."""
    return _lines(phrases(u), F.size("mappings"))


def odd_mappings(u: DataFrame) -> DataFrame:
    """For each phrase with candidates and no mapping five lines: an empty one, `No mappings for`, label, text, and its candidates as terms."""
    from ..sources.annotated import evs_text

    x = phrases(u).where((F.size("cands") > 0) & (F.size("mappings") == 0))
    return _report(x, F.concat_ws("\n", F.lit(""), F.lit("No mappings for"), "label", "text", evs_text(F.col("cands"))))


def inversions(e: Column) -> Column:
    """How many pairs of spans of a candidate's match map stand in another order in the phrase than in the term."""
    by_term = lambda m: F.array_sort(F.transform(m, lambda s: F.struct(s["m1"].alias("m"), s["p1"].alias("p"))))
    after = lambda s, x, i: F.size(F.filter(F.slice(s, i + 2, F.size(s)), lambda y: y["p"] < x["p"]))
    return F.transform(F.array(by_term(e["match_map"])), lambda s: F.aggregate(F.transform(s, lambda x, i: after(s, x, i)), F.lit(0), lambda a, n: a + n))[0]


def non_monotonic(u: DataFrame) -> DataFrame:
    """(label, no, value): phrases whose best mapping scores less than their best candidate: an empty line, a heading, `label text`, then both lists."""
    x = phrases(u).where(F.get("mappings", F.lit(0))["neg_score"] > F.get("cands", F.lit(0))["neg_value"])
    line = lambda e: _evaluation(e, False, False, True, None)
    maps = F.array_join(F.transform("mappings", lambda k: F.concat(F.lit("Meta Mapping ("), (-k["neg_score"]).cast("string"), F.lit("):\n"), F.array_join(F.transform(k["evs"], line), "\n"))), "\n")
    return x.select("doc_id", "utt_no", "label", "no", F.concat_ws("\n", F.lit(""), F.lit("Non-monotonic mapping for"), F.concat_ws(" ", "label", "text"), F.lit("Candidates:"), F.array_join(F.transform("cands", line), "\n"), maps).alias("value"))


def mapping_inversions(u: DataFrame) -> DataFrame:
    """(label, no, i, inversions): of each mapping, pairs of spans out of order within its candidates."""
    return mapped(u).select("label", "no", "i", F.aggregate(F.transform("evs", inversions), F.lit(0), lambda a, n: a + n).alias("inversions"))


def _names_map(names: dict | None) -> Column | None:
    """Abbreviations of semantic types to names, as a literal: there are a hundred-odd types."""
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else None


def _evaluation(e: Column, show_cuis: bool, preferred_only: bool, semantic_types: bool, names: dict | None) -> Column:
    """A candidate's line: its score six wide, then CUI:Term (Concept) [types], as far as asked for."""
    name = e["preferred_name"] if preferred_only else F.when(e["meta_term"] == e["preferred_name"], e["preferred_name"]).otherwise(F.concat(e["meta_term"], F.lit(" ("), e["preferred_name"], F.lit(")")))
    by = _names_map(names)
    types = e["sem_types"] if by is None else F.transform(e["sem_types"], lambda t: F.coalesce(by[t], t))
    return F.concat(F.lpad((-e["neg_value"]).cast("string"), 6, " "), F.lit(" "), *([e["cui"], F.lit(":")] if show_cuis else []), name, *([F.lit(" "), shown(types)] if semantic_types else []))


def phrase_report(
    u: DataFrame, candidates: bool = True, mappings: bool = True, show_cuis: bool = True, preferred_only: bool = False, semantic_types: bool = True, names: dict | None = None, threshold: int | None = None, truncate: bool = False, stop: DataFrame | None = None, simple_syntax: bool = True, syntax: bool = False,
) -> DataFrame:
    """(doc_id, utt_no, label, no, value): the default text block of a phrase, as far as its parts are asked for.

    simple_syntax: an empty line and its text; syntax: an empty line, `msu` and its items as terms; candidates, up to the threshold,
    ten if truncated; mappings, two if truncated.  A candidate's line holds its score, six wide, and `CUI:Term (Concept) [types]`; the
    term goes where it equals the concept or preferred names alone are asked for; names gives types by name.  Without any mapping the
    block says `Meta Mapping: <none>`.  Phrases for which nothing prints have no row.
    """
    from ..sources.annotated import items_text

    x = phrases(u) if stop is None else without_stop_phrases(phrases(u), stop)
    x = x if threshold is None else threshold_prefix(x, threshold)
    n, m = (10, 2) if truncate else (1 << 30, 1 << 30)
    line = lambda e: _evaluation(e, show_cuis, preferred_only, semantic_types, names)
    rest = lambda c, most, what: F.when(F.size(c) > most, F.concat(F.lit("     ["), (F.size(c) - most).cast("string"), F.lit(f" {what} were not printed]")))
    parts = [F.concat(F.lit('\nPhrase: "'), "text", F.lit('"'))] if simple_syntax else []
    parts += [F.concat(F.lit("\nmsu\n"), items_text(F.col("items")))] if syntax else []
    if candidates:
        head = F.concat(F.lit("Meta Candidates (Total="), "counts.total", F.lit("; Excluded="), "counts.excluded", F.lit("; Pruned="), "counts.pruned", F.lit("; Remaining="), "counts.remaining", F.lit("):"))
        some = F.size("cands") > 0
        parts += [F.when(some, head), F.when(some, F.array_join(F.transform(F.slice("cands", 1, n), line), "\n")), rest("cands", n, "candidates")]
    if mappings:
        one = lambda k: F.concat(F.lit("Meta Mapping ("), (-k["neg_score"]).cast("string"), F.lit("):\n"), F.array_join(F.transform(k["evs"], line), "\n"))
        parts += [F.when(F.size("mappings") > 0, F.array_join(F.transform(F.slice("mappings", 1, m), one), "\n")).otherwise(F.lit("Meta Mapping: <none>")), rest("mappings", m, "mappings")]
    return x.select(*KEYS, "no", F.concat_ws("\n", *parts).alias("value")).where("value <> ''")


def _by_type(rows: Column, names: dict | None) -> Column:
    """Rows (semtype, term, concept) as text: a heading wherever the type changes, then a line a concept."""
    by = _names_map(names)
    name = lambda t: F.lit("<unknown>") if by is None else F.coalesce(by[t], F.lit("<unknown>"))
    head = lambda r: F.concat(F.lit("\n"), name(r["semtype"]), F.lit(" ("), r["semtype"], F.lit("):\n"))
    row = lambda r: F.concat(F.lit("  "), r["term"], F.when(r["term"] == r["concept"], F.lit("\n")).otherwise(F.concat(F.lit(" ("), r["concept"], F.lit(")\n"))))
    text = lambda rs: F.array_join(F.transform(rs, lambda r, i: F.concat(F.when((i == 0) | (F.get(rs, i - 1)["semtype"] != r["semtype"]), head(r)).otherwise(F.lit("")), row(r))), "")
    return F.transform(F.array(rows), text)[0]


def organized_types(u: DataFrame, names: dict | None = None, first_only: bool = False, over: str = "doc_id") -> DataFrame:
    """(doc_id, utt_no, label, value, combined): an utterance's concepts by semantic type, in the order of its mappings, and then all
    of its document so far, sorted and each once; <unknown> where names has no name for a type.

    over="all" gathers over all documents in order: the first place of each concept is found first, so an utterance's list is made
    of those with an earlier place.  As every utterance prints all that came before it, the output itself then grows with its square.
    """
    maps = lambda p: F.slice(p["mappings"], 1, 1) if first_only else p["mappings"]
    rows = F.flatten(F.transform(F.flatten(F.transform(F.flatten(F.transform("phrases", maps)), lambda m: m["evs"])), lambda e: F.transform(e["sem_types"], lambda t: F.struct(t.alias("semtype"), e["meta_term"].alias("term"), e["preferred_name"].alias("concept")))))
    x = u.select("doc_id", "utt_no", "label", rows.alias("rows"))
    if over == "all":
        so_far = _union_so_far(x)
    else:
        w = Window.partitionBy("doc_id").orderBy("utt_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        so_far = x.withColumn("so_far", F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_distinct("rows")).over(w)))))
    return so_far.select("doc_id", "utt_no", "label", _by_type(F.col("rows"), names).alias("value"), F.concat(F.lit("\n\n\nCombined concepts by semantic type:\n"), _by_type(F.col("so_far"), names)).alias("combined"))


def _union_so_far(x: DataFrame) -> DataFrame:
    """x (doc_id, utt_no, rows) with so_far: all different rows of utterances up to each, over all documents in order.

    Utterances are numbered over ranges; each row's first number is found by a sum; lists of new rows then run on over blocks of
    utterances, and a block starts with all that blocks before it found.
    """
    from .runs import BLOCK, ranked

    n = ranked(x.withColumn("__o", F.struct("doc_id", "utt_no")), "__o", "__n").drop("__o")
    kind = "array<struct<semtype:string,term:string,concept:string>>"
    first = n.select("__n", F.explode("rows").alias("r")).groupBy("r").agg(F.min("__n").alias("f"))
    new = first.groupBy("f").agg(F.collect_list("r").alias("new"))
    y = n.join(new, F.col("__n") == F.col("f"), "left").withColumn("__b", F.floor(F.col("__n") / BLOCK))
    w = Window.partitionBy("__b").orderBy("__n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = first.groupBy(F.floor(F.col("f") / BLOCK).alias("b")).agg(F.collect_list("r").alias("all"))
    blocks = y.select(F.col("__b").alias("b")).distinct().join(found, "b", "left").select(F.col("b").alias("__q"), F.flatten(F.collect_list("all").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))).alias("__before"))
    own = F.flatten(F.collect_list("new").over(w))
    y = y.withColumn("own", own).join(blocks, F.col("__b") == F.col("__q"))
    return y.withColumn("so_far", F.array_sort(F.concat(F.coalesce("__before", F.array().cast(kind)), "own"))).drop("__n", "__b", "f", "new", "__q", "__before", "own")


def phrase_coverage(u: DataFrame) -> DataFrame:
    """(label, no, covered, words): positions of a phrase that the match maps of its first mapping's candidates name, and its words.

    Positions count once for each candidate that has them; more of them than words raise an error.
    """
    m = F.get("mappings", F.lit(0))["evs"]
    each = lambda e: F.aggregate(e["match_map"], F.lit(0), lambda a, s: a + s["p2"] - s["p1"] + 1)
    covered, words = F.coalesce(F.aggregate(m, F.lit(0), lambda a, e: a + each(e)), F.lit(0)), F.size(phrase_words(F.col("items")))
    wrong = F.raise_error(F.concat(F.lit("match maps name more words than there are in a phrase of "), "label")).cast("int")
    return phrases(u).select("label", "no", F.when(covered <= words, covered).otherwise(wrong).alias("covered"), words.alias("words"))


def integrity_errors(u: DataFrame) -> DataFrame:
    """Utterances without phrases."""
    return u.where((F.size("phrases") == 0) | F.col("phrases").isNull()).select("label")


def to_json(u: DataFrame) -> DataFrame:
    """(doc_id, value): a document's utterances as JSON."""
    g = u.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("utt_no", "label", "text", "phrases"))).alias("utterances"))
    return g.select("doc_id", F.to_json(F.struct("doc_id", "utterances")).alias("value"))


XML_HEADER, XML_FOOTER = '<?xml version="1.0" encoding="UTF-8"?>\n<documents>', "</documents>"


def _element(name: str, *inside) -> Column:
    return F.concat(F.lit(f"<{name}>"), *inside, F.lit(f"</{name}>"))


def _escaped(x: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def to_xml(u: DataFrame) -> DataFrame:
    """(doc_id, utt_no, value): each utterance as XML with its phrases, their candidates and mappings; between XML_HEADER and XML_FOOTER they are a file."""
    plain = lambda name, x: _element(name, x.cast("string"))
    ev = lambda e: _element("candidate", plain("score", -e["neg_value"]), plain("cui", e["cui"]), _element("term", _escaped(e["meta_term"])), _element("concept", _escaped(e["preferred_name"])), F.array_join(F.transform(e["sem_types"], lambda t: plain("type", t)), ""), plain("negated", e["negated"]))
    mapping = lambda m: _element("mapping", plain("score", -m["neg_score"]), F.array_join(F.transform(m["evs"], ev), ""))
    phrase = lambda p: _element("phrase", plain("no", p["no"]), _element("text", _escaped(p["text"])), _element("candidates", F.array_join(F.transform(p["cands"], ev), "")), _element("mappings", F.array_join(F.transform(p["mappings"], mapping), "")))
    return u.select("doc_id", "utt_no", _element("utterance", plain("label", F.col("label")), _element("text", _escaped(F.col("text"))), F.array_join(F.transform("phrases", phrase), "")).alias("value"))


def flat_sequence(u: DataFrame) -> DataFrame:
    """(doc_id, utt_no, seq, kind, value): utterances as the flat sequence utterance, (phrase, candidates, mappings)..., EOU; JSON for each part."""
    parts = F.flatten(F.transform("phrases", lambda p: F.array(
        F.struct(F.lit("phrase").alias("kind"), F.to_json(F.struct(p["no"].alias("no"), p["text"].alias("text"), p["items"].alias("items"), p["counts"].alias("counts"), p["pos"].alias("pos"))).alias("value")),
        F.struct(F.lit("candidates").alias("kind"), F.to_json(F.struct(p["cands"].alias("cands"))).alias("value")),
        F.struct(F.lit("mappings").alias("kind"), F.to_json(F.struct(p["mappings"].alias("mappings"))).alias("value")))))
    head = F.array(F.struct(F.lit("utterance").alias("kind"), F.to_json(F.struct("label", "text")).alias("value")))
    tail = F.array(F.struct(F.lit("EOU").alias("kind"), F.lit("").alias("value")))
    return u.select("doc_id", "utt_no", F.posexplode(F.concat(head, parts, tail)).alias("seq", "e")).select("doc_id", "utt_no", "seq", "e.kind", "e.value")


def from_sequence(flat: DataFrame) -> DataFrame:
    """The nested utterances of a flat_sequence frame: phrases are numbered by their starts, then gathered."""
    w = Window.partitionBy("doc_id", "utt_no").orderBy("seq")
    x = flat.withColumn("k", F.sum((F.col("kind") == "phrase").cast("int")).over(w))
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value")))
    ph = x.where("kind in ('phrase', 'candidates', 'mappings')").groupBy("doc_id", "utt_no", "k").agg(pick("phrase").alias("p"), pick("candidates").alias("c"), pick("mappings").alias("m"))
    one = F.from_json("p", f"no int, text string, items array<{ITEM}>, counts struct<total:int,excluded:int,pruned:int,remaining:int>, pos {SPAN}")
    ph = ph.select("doc_id", "utt_no", "k", F.struct(one["no"].alias("no"), one["text"].alias("text"), one["items"].alias("items"), one["counts"].alias("counts"), F.from_json("c", f"cands array<{EV}>")["cands"].alias("cands"), F.from_json("m", f"mappings array<struct<neg_score:int,evs:array<{EV}>>>")["mappings"].alias("mappings"), one["pos"].alias("pos")).alias("p"))
    ph = ph.groupBy("doc_id", "utt_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "p")), lambda a, b: (a["k"] - b["k"]).cast("int")), lambda s: s["p"]).alias("phrases"))
    head = flat.where("kind = 'utterance'").select("doc_id", "utt_no", F.from_json("value", "label string, text string").alias("h"))
    return head.join(ph, ["doc_id", "utt_no"], "left").select("doc_id", "utt_no", "h.label", "h.text", F.coalesce("phrases", F.array().cast(f"array<{PHRASE}>")).alias("phrases"))
