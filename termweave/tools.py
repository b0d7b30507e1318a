"""The tools from file to file: `python -m termweave.tools <tool> ...`, or the functions.

Outputs are folders of text files in order; --one_file makes a single one.  All readers take files or folders.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import annotations as A
from .operators import profiles as P
from .operators import saved
from .operators import tagger as TG
from .operators import termfilter as TF
from .operators import terminput as TI
from .operators import trees as TR
from .operators import variants as VA
from .operators import wordindex as W
from .operators.steps import checkpoint_root, stored
from .functions import text as T
from .sources import readers as R
from .sources.annotated import read_annotated

END_MARK = "<<< EOT >>>"


def _write(x: DataFrame, path: str, *order: str, one_file: bool = False) -> None:
    """The value column as text in the order of the columns given, or as x is ordered; one_file has one task write all of it."""
    x = (x.orderBy(*order) if order else x).select("value")
    (x.coalesce(1) if one_file else x).write.mode("overwrite").text(path)


def _sections(*parts: DataFrame, end: bool) -> DataFrame:
    """(section, ord, value): parts one after the other, each by its column ord, and the end mark if asked for."""
    out = None
    for k, x in enumerate(parts):
        # A sort key for any ord: it is ranked only within its section, so sections may order by columns of different types.
        own = x.select(F.lit(k).alias("section"), *[(F.col("ord") if j == k else F.lit(None).cast(p.schema["ord"].dataType)).alias(f"ord{j}") for j, p in enumerate(parts)], "value")
        out = own if out is None else out.unionByName(own)
    if end:
        mark = out.sparkSession.range(1).select(F.lit(len(parts)).alias("section"), *[F.lit(None).cast(p.schema["ord"].dataType).alias(f"ord{j}") for j, p in enumerate(parts)], F.lit(END_MARK).alias("value"))
        out = out.unionByName(mark)
    return out


def _write_sections(path: str, *parts: DataFrame, end: bool, one_file: bool) -> None:
    _write(_sections(*parts, end=end), path, "section", *[f"ord{j}" for j in range(len(parts))], one_file=one_file)


def _append_lines(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A few lines as one more file of a folder of text, after all that are there."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [s.getPath().getName() for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(path))]
    n = 1 + max((int(p.split("-")[1]) for p in parts if p.startswith("part-")), default=-1)
    # The number of a file is that of its partition, and only the last partition has rows.
    x = spark.range(0, n + 1, 1, n + 1).where(F.col("id") == n).select(F.explode(F.lit(lines)).alias("value"))
    x.write.mode("append").text(path)


def filter_terms(spark: SparkSession, infile: str, outfile: str, strict_filtering: bool = False, dump_syntax_only: bool = False, end_of_processing: bool = False, assume_sorted: bool = False, tagger: str | None = None, one_file: bool = False) -> None:
    """A term table to tagged lines and counters; or, with dump_syntax_only, to the syntax of its terms.

    tagger: the folder of a saved tagger, by whose tags terms are cut into phrases; without it phrases are cut before prepositions.
    Lines are written and counted by one pass: counters are observed as rows go by, printed, and added as a last file.  one_file
    sorts and writes in one task.
    """
    prepared, simple = TF.prepare(R.read_terms(spark, infile), assume_sorted), None
    if tagger:
        x = prepared.withColumn("w", T.words(F.col("nmstr")))
        prepared = TG.tag(x, TG.read_model(spark, tagger), "w").withColumn("ph", TG.tagged_chunks(F.col("w"), F.col("tags")))
    if dump_syntax_only:
        x = TF.tagged_syntax_dump(prepared, "line_no") if tagger else TF.syntax_dump(prepared, "line_no")
        _write_sections(outfile, x.withColumnRenamed("line_no", "ord"), end=end_of_processing, one_file=one_file)
        return
    if strict_filtering:
        simple = TG.is_simple_tagged(F.col("ph")) if tagger else TF.is_simple(TF.chunks(T.words(F.col("nmstr"))))
    observed, lines = TF.observed_lines(TF.filter_terms(prepared, simple))
    if one_file:
        mark = [END_MARK] if end_of_processing else []
        began = f"{outfile}/_lines"
        _write(observed, began)
        counters = lines()
        whole = spark.read.text(began).select(F.lit(0).alias("part"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
        last = spark.range(1).select(F.lit(1).alias("part"), F.lit("").alias("file"), F.posexplode(F.lit([*counters, *mark])).alias("at", "value"))
        made = whole.unionByName(last).orderBy("part", "file", "at").select("value").coalesce(1)
        made.write.mode("overwrite").text(f"{outfile}.one")
        fs = spark._jvm.org.apache.hadoop.fs.Path(outfile).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(outfile), True)
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{outfile}.one"), spark._jvm.org.apache.hadoop.fs.Path(outfile))
    else:
        _write(observed, outfile)
        counters = lines()
        _append_lines(spark, outfile, [*counters, *([END_MARK] if end_of_processing else [])])
    print("\n".join([f"{lines.terms()} terms", *counters]))


def glean_terms(spark: SparkSession, infile: str, filterfile: str, wordoutfile: str, suioutfile: str, cuioutfile: str, first_term_is_concept: bool = True, generate_words: bool = True, generate_strings: bool = True, generate_cuis: bool = True, pair_folder: str | None = None, one_file: bool = False) -> None:
    """A filtered term table to its words (without strings that open and end as a listed pair), strings and concepts, in the order of its lines.

    pair_folder keeps the table of pairs, which is read again while the lines of filterfile stay the same.
    """
    pairs = saved.reuse(spark.read.text(filterfile), pair_folder, lambda x: R.parse_pairs(x).distinct()) if pair_folder else R.read_pairs(spark, filterfile)
    flagged = W.concept_flags(R.read_terms(spark, infile), first_term_is_concept)
    bar = lambda x, *c: x.select("*", F.concat_ws("|", *c).alias("value"))
    if generate_words:
        _write(bar(W.words(flagged, pairs, "line_no"), "i", "n", "word", "sui", "cui"), wordoutfile, "line_no", "i", one_file=one_file)
    if generate_strings:
        _write(bar(W.strings(flagged, "line_no"), "sui", "norm_string", "string"), suioutfile, "line_no", one_file=one_file)
    # The dummy concept comes first, and also where no concepts are asked for.
    dummy = spark.range(1).select(F.lit(-1).cast("long").alias("line_no"), F.lit(f"{T.CONCEPT_PLACEHOLDER}|X").alias("value"))
    named = flagged.where("is_concept").select("line_no", F.concat_ws("|", "cui", "str").alias("value"))
    _write(dummy.unionByName(named) if generate_cuis else dummy, cuioutfile, "line_no", one_file=one_file)


def variants(spark: SparkSession, infile: str, lexicon: str, edges: str, outfile: str | None = None, depth: int | None = None, end_of_processing: bool = False, one_file: bool = False) -> None:
    """Terms, one a line, to their variants: all that edges lead to, or those over at most depth edges.  lexicon: lines form|category; edges: lines base|category|word|category|kind|distance."""
    cut = lambda path, names: spark.read.text(path).select(F.split("value", "[|]", -1).alias("f")).select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])
    e = cut(edges, ("base", "base_cat", "word", "cat", "kind", "distance")).withColumn("distance", F.col("distance").cast("int"))
    terms = R.read_term_list(spark, infile)
    first = terms.groupBy("term").agg(F.min("line_no").alias("line_no"))
    known = VA.categories(terms, cut(lexicon, ("form", "cat")))
    x = VA.variant_lines(VA.variant_rows(VA.closure(known, e) if depth is None else VA.expand(known, e, depth)))
    x = x.join(first.withColumnRenamed("term", "t"), F.col("term") == F.col("t")).select(F.struct("line_no", "word", "value").alias("ord"), "value")
    _write_sections(outfile or f"{infile}.out", x, end=end_of_processing, one_file=one_file)


def lexicon(spark: SparkSession, infile: str, outfile: str | None = None, end_of_processing: bool = False, one_file: bool = False) -> None:
    """Lexical records to `EUI|record` lines, in their order."""
    x = R.lexicon_lines(R.parse_lexicon(R.read_lexicon(spark, infile).withColumn("ord", F.monotonically_increasing_id()), "ord"), "ord").select("ord", "value")
    _write_sections(outfile or f"{infile}.out", x, end=end_of_processing, one_file=one_file)


#: Reports by the option that asks for them; each keeps the order of utterances.
REPORTS = {
    "label_text_field_dump": A.label_text, "mapping_summary_dump": A.mapping_summary, "not_in_lex_dump": A.not_in_lexicon, "syntax_dump": A.syntax, "syntactic_pattern_dump": A.syntactic_pattern, "potential_stopphrase_dump": A.potential_stop_phrases,
    "phrase_dump": A.phrase_texts, "inputmatch_lexmatch_dump": A.match_differences, "candidate_count_dump": A.candidate_counts, "candidate_text_dump": A.candidate_texts, "mapping_text_dump": A.mapping_texts, "mapping_count_dump": A.mapping_counts, "odd_mapping_dump": A.odd_mappings,
}
LAST = (1 << 63) - 1


def print_annotated(
    spark: SparkSession, infile: str, outfile: str | None = None, report: str = "default", format: str = "text", stop_phrase_file: str | None = None, alnum_filter: bool = False, filter_out_01: bool = False, null_only: bool = False, non_null_only: bool = False,
    threshold: int | None = None, truncate_output: bool = False, show_cuis: bool = False, show_preferred_names_only: bool = False, semantic_types: bool = False, with_text: bool = False, first_mappings_only: bool = False, simple_syntax: bool = True, syntax: bool = False, candidates: bool = True, mappings: bool = True, one_file: bool = False,
    whole_input_union: bool = False, code_file: str | None = None, concept_file: str | None = None,
) -> None:
    """A file of annotation terms to a report; XML and JSON take its place where asked for.

    report: an option of REPORTS, unique_mapping_text_dump, prepositional_phrase_dump, organize_semantic_types, non_monotonic_mapping_dump,
    phrase_specificity_dump (code_file: lines cui|code), filter_for_meta or filter_for_meta_with_sy_id (concept_file: lines cui|name),
    documents (`PMID n: id` lines), or default: a heading and the phrases of each utterance.  infile may name several files, by commas,
    folders or patterns: documents are numbered on over them in the order of their paths.  An empty line follows each utterance, save
    in the reports label_text_field_dump and documents.  whole_input_union has organize_semantic_types gather over all documents.
    """
    outfile = outfile or f"{infile}.out"
    u = read_annotated(spark, infile.split(","))
    u = A.alnum_only(u) if alnum_filter else u
    u = A.drop_trivial(u) if filter_out_01 else u
    u = A.with_null(u) if null_only else u
    u = A.with_candidates(u) if non_null_only else u
    # A document is known by its number over all files.  Rows are written once and read again by the columns that a report asks for;
    # an utterance is one row, so its lines stay in order without a sort of the rows, and only lines are sorted.
    parsed = f"{checkpoint_root(spark)}/parsed-{uuid.uuid4().hex}"
    u = stored(u.where("label is not null").withColumn("id", F.col("doc_id")).withColumn("doc_id", F.col("doc_ord")), parsed)
    try:
        if format == "json":
            return _write(A.to_json(u), outfile, "doc_id", one_file=one_file)
        if format == "xml":
            body = A.to_xml(u).select(F.struct("doc_id", "utt_no").alias("ord"), "value")
            line = lambda text: spark.range(1).select(F.lit(0).alias("ord"), F.lit(text).alias("value"))
            return _write_sections(outfile, line(A.XML_HEADER), body, line(A.XML_FOOTER), end=False, one_file=one_file)
        if report == "documents":
            x = u.groupBy("doc_id").agg(F.min_by("id", "utt_no").alias("id")).select("doc_id", F.concat(F.lit("PMID "), "doc_id", F.lit(": "), "id").alias("value"))
            return _write(x, outfile, "doc_id", one_file=one_file)
        x = _report_lines(spark, u, report, stop_phrase_file, threshold, truncate_output, show_cuis, show_preferred_names_only, semantic_types, with_text, first_mappings_only, simple_syntax, syntax, candidates, mappings, whole_input_union, code_file, concept_file)
        if report != "label_text_field_dump":
            x = x.unionByName(u.select("doc_id", "utt_no", F.lit(LAST).alias("at"), F.lit("").alias("value")))
        return _write(x, outfile, "doc_id", "utt_no", "at", one_file=one_file)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(parsed)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _report_lines(spark, u, report, stop_phrase_file, threshold, truncate, show_cuis, preferred_only, semantic_types, with_text, first_only, simple_syntax, syntax, candidates, mappings, whole_input_union, code_file, concept_file) -> DataFrame:
    """(doc_id, utt_no, at, value): a report's lines, by their places within utterances."""
    placed = lambda x, at=None: x.select("doc_id", "utt_no", (F.monotonically_increasing_id() if at is None else at).alias("at"), "value")
    long = lambda c: F.col(c).cast("long")
    cut = lambda path, *names: spark.read.text(path).select(F.split("value", "[|]", 2).alias("f")).select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)])
    if report == "prepositional_phrase_dump":
        return placed(A.composite_phrases(u), long("island"))
    if report == "organize_semantic_types":
        x = A.organized_types(u, first_only=first_only, over="all" if whole_input_union else "doc_id")
        return placed(x.withColumn("value", F.concat("value", "combined")), F.lit(0).cast("long"))
    if report == "non_monotonic_mapping_dump":
        return placed(A.non_monotonic(u), long("no"))
    if report == "phrase_specificity_dump":
        return placed(TR.phrase_specificity(u, cut(code_file, "cui", "code")), long("no"))
    if report in ("filter_for_meta", "filter_for_meta_with_sy_id"):
        stop = R.read_stop_phrases(spark, stop_phrase_file) if stop_phrase_file else None
        return placed(TI.filtered_for_input(u, cut(concept_file, "cui", "name"), report == "filter_for_meta_with_sy_id", threshold, stop), long("no"))
    if report == "unique_mapping_text_dump":
        return placed(A.mapping_texts(u, unique=True))
    if report == "syntactic_pattern_dump":
        return placed(A.syntactic_pattern(u, with_text))
    if report == "mapping_summary_dump":
        return placed(A.mapping_summary(u, first_only))
    if report in REPORTS:
        return placed(REPORTS[report](u))
    if report != "default":
        raise ValueError(f"no report {report}")
    stop = R.read_stop_phrases(spark, stop_phrase_file) if stop_phrase_file else None
    blocks = A.phrase_report(u, candidates, mappings, show_cuis, preferred_only, semantic_types, None, threshold, truncate, stop, simple_syntax, syntax)
    return placed(A.headed(u), F.lit(-1).cast("long")).unionByName(placed(blocks, long("no")))


def index_vectors(spark: SparkSession, source: str, folder: str) -> None:
    R.write_vectors(R.load_vectors(R.numbered_lines(spark, source)), folder)


def get_vector(spark: SparkSession, folder: str, term: str) -> list[int] | None:
    """The vector of a term, or None: one row at most is read from the files of its length."""
    row = R.read_vectors(spark, folder, term).select("vec").first()
    return row.vec if row else None


def top_types(spark: SparkSession, infile: str, outfile: str, config: str | None = None, n: int = 10, one_file: bool = False) -> None:
    """The best semantic types of each file as one document, by the index and word lists that the configuration names."""
    keys = R.read_configuration(spark, config) if config else R.CONFIGURATION
    docs = R.read_document(spark, infile)
    words = lambda key: R.word_set(spark.read.text(keys[key]))
    kept = P.allowed(P.term_frequencies(docs, "path"), words("DISAMB_SERVER_STI_RESTRICTWORDSFILE"), words("DISAMB_SERVER_STI_STOPWORDSFILE"))
    prof = P.profiles(docs, P.profile_sums(kept, R.read_vectors(spark, keys["DISAMB_SERVER_STI_INDEXPATH"])), "path")
    _write(P.display_lines(P.top_types(prof, n)), outfile, "doc_id", "rank", one_file=one_file)


def imports(spark: SparkSession, infile: str, outfile: str, one_file: bool = False) -> None:
    """`predicate|arity|module` lines of what source files import, sorted."""
    lines = spark.read.text(infile).select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line_no"), "value")
    _write(R.import_list(lines).select("*", F.concat_ws("|", "predicate", "arity", "module").alias("value")), outfile, "predicate", "arity", "module", one_file=one_file)


TOOLS = {"filter": filter_terms, "glean": glean_terms, "variants": variants, "lexicon": lexicon, "print": print_annotated, "index": index_vectors, "get": get_vector, "types": top_types, "imports": imports}


def parser() -> argparse.ArgumentParser:
    """Arguments of a tool are its function's: those without a default by place, the others as options; on-off options take --no-."""
    import inspect

    top = argparse.ArgumentParser(prog="termweave.tools", description=__doc__)
    tools = top.add_subparsers(dest="tool", required=True)
    for name, f in TOOLS.items():
        p = tools.add_parser(name, help=(f.__doc__ or "").strip().split("\n")[0].replace("%", "%%"))
        for key, arg in list(inspect.signature(f).parameters.items())[1:]:
            if arg.default is inspect.Parameter.empty:
                p.add_argument(key)
            elif isinstance(arg.default, bool):
                p.add_argument(f"--{key}", action=argparse.BooleanOptionalAction, default=arg.default)
            else:
                p.add_argument(f"--{key}", type=int if "int" in str(arg.annotation) else str, default=arg.default)
    return top


def main(args: list[str] | None = None) -> None:
    how = vars(parser().parse_args(args))
    spark = SparkSession.builder.appName(f"termweave {how['tool']}").getOrCreate()
    out = TOOLS[how.pop("tool")](spark, **how)
    if out is not None:
        print(*out)


if __name__ == "__main__":
    main()
