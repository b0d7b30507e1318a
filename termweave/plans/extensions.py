"""Queries of functions in SQL, saved tables, counters of one pass, streams, and reports on match maps of several words."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sqlfunctions, tools
from ..operators import annotations as A
from ..operators import saved
from ..operators import termfilter as TF
from ..operators import terminput as TI
from ..operators import wordindex as W
from ..operators.steps import checkpoint_root, stored
from ..sources import readers as R
from ..streaming import running
from . import views as V
from .catalog import AN, COUNTERS, IDX, SQL, STYLED, VEC_LINES, _filtered, _terms, query


def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


# Functions in SQL


@query(STYLED + "SELECT aui, nmstr, types FROM norm")
def p1_sql_normalize(spark, sf):
    sqlfunctions.register(spark)
    _terms(spark, sf).createOrReplaceTempView("tw_terms")
    return spark.sql("SELECT aui, tw_normal(str) AS nmstr, concat('[', array_join(tw_normal_types(str), ','), ']') AS types FROM tw_terms")


@query(SQL["a16_composite_phrase"])
def a16_sql_composite_phrase(spark, sf):
    sqlfunctions.register(spark)
    ph = A.phrases(V.utterances(spark, sf))
    ph.createOrReplaceTempView("tw_phrases")
    return spark.sql("""SELECT doc_id, utt_no, value FROM tw_composite_phrases(TABLE(SELECT doc_id, utt_no, no, text, get(items, 0).category AS category, get(items, 0).lexmatch AS preps FROM tw_phrases)
      PARTITION BY (doc_id, utt_no) ORDER BY no)""")


@query(AN + """, c AS (SELECT doc_id, utt_no, no, string_agg(w, ' ' ORDER BY cn) AS cs FROM ca GROUP BY ALL), i AS (SELECT doc_id, utt_no, no, string_agg(category || ':' || w, ' ' ORDER BY pos) AS ws FROM it GROUP BY ALL)
SELECT u0.doc_id, u0.utt_no, u0.label, u0.text, ph.no::INT AS no, ph.text AS phrase, coalesce(ws, '') AS items, coalesce(cs, '') AS cands FROM u0 JOIN ph USING (doc_id, utt_no) LEFT JOIN c USING (doc_id, utt_no, no) LEFT JOIN i USING (doc_id, utt_no, no)""")
def s14_sql_utterances(spark, sf):
    sqlfunctions.register(spark)
    A.flat_sequence(V.utterances(spark, sf)).createOrReplaceTempView("tw_flat")
    return spark.sql(f"""SELECT doc_id, utt_no, label, text, p.no, p.text AS phrase, array_join(transform(p.items, i -> concat(i.category, ':', i.tokens[0])), ' ') AS items, array_join(p.cands.meta_term, ' ') AS cands
      FROM (SELECT doc_id, utt_no, label, text, explode(from_json(phrases, 'array<{A.PHRASE}>')) AS p
        FROM tw_utterances(TABLE(SELECT doc_id, utt_no, seq, kind, value FROM tw_flat) PARTITION BY (doc_id, utt_no) ORDER BY seq))""")


# Saved tables and one pass


@query(IDX + ", k AS (SELECT x.* FROM x ANTI JOIN pairs ON x.w[1] = pairs.first AND x.w[-1] = pairs.last) SELECT len(w)::INT AS n, unnest(w) AS word, generate_subscripts(w, 1)::INT AS i, sui, ic AS cui FROM k")
def k10_saved_pairs(spark, sf):
    folder = f"{checkpoint_root(spark)}/pairs"
    return W.words(W.concept_flags(_terms(spark, sf)), saved.reuse(V.pairs(spark, sf), folder, lambda x: x.repartition(1)))


@query(f"WITH {V.GROUPED}, {V.FILTER_SQL}, {COUNTERS}".replace("SELECT row_number() OVER (ORDER BY i DESC, t DESC)::INT AS ord, i", "SELECT i").replace("SELECT 1001, ", "SELECT ").replace("SELECT 1002, ", "SELECT ").replace("SELECT 1003, ", "SELECT ").replace("SELECT 1004, ", "SELECT "))
def k21_observed_counters(spark, sf):
    folder = _folder(spark, "lines")
    x, lines = TF.observed_lines(_filtered(spark, sf))
    x.write.text(folder)
    return spark.createDataFrame([(v,) for v in lines()], "value string")


@query("SELECT replace(p_brand, ' ', '') AS term, length(replace(p_brand, ' ', ''))::INT AS term_len, arg_max(p_size || ',' || (p_partkey % 10), p_partkey) AS vec FROM part GROUP BY ALL")
def k16_vector_index(spark, sf):
    lines = V.table(spark, sf, "part").selectExpr("p_partkey AS line_no", VEC_LINES.replace("p_brand", "replace(p_brand, ' ', '')") + " AS value")
    folder = _folder(spark, "vectors")
    R.write_vectors(R.load_vectors(lines), folder)
    return R.read_vectors(spark, folder).select("term", F.length("term").alias("term_len"), F.array_join("vec", ",").alias("vec"))


@query(AN + ", s AS (SELECT DISTINCT doc_id, utt_no FROM ph) SELECT concat_ws('|', pn, w, '[' || w || ']', label) AS value FROM ca UNION ALL SELECT '' FROM s")
def r0_printed_file(spark, sf):
    from ..sources import annotated as A2

    infile, outfile = _folder(spark, "terms"), _folder(spark, "report")
    # Ranges are sampled from plain turns, so that turns are annotated once.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = A2.term_lines(V.utterances(spark, sf, ranges=n).where(F.size("phrases") > 0))
    x.sortWithinPartitions("doc_id", "utt_no").select("value").write.text(infile)
    tools.print_annotated(spark, infile, outfile, report="candidate_text_dump")
    return spark.read.text(outfile)


# Streams


@query(SQL["a14_running_union"])
def a14_streamed_union(spark, sf):
    u = V.utterances(spark, sf)
    items = A.semtype_rows(u).groupBy("doc_id", "utt_no").agg(F.collect_set(F.concat_ws("|", "semtype", "term", "concept")).alias("items"))
    folder, out = _folder(spark, "items"), _folder(spark, "union")
    u.select("doc_id", "utt_no").join(items, ["doc_id", "utt_no"], "left").write.parquet(folder)
    running.to_folder(running.running_union(spark.readStream.schema("doc_id long, utt_no long, items array<string>").parquet(folder)), out, _folder(spark, "checkpoint"))
    return spark.read.parquet(out)


@query(f"WITH {V.INTERLEAVED}, {V.RUNS_SQL} SELECT line_no, cui, run_id FROM runs")
def a1_streamed_runs(spark, sf):
    folder, out = _folder(spark, "terms"), _folder(spark, "runs")
    V.terms(spark, sf, interleaved=True).select(F.lit("terms").alias("source"), "line_no", "cui").write.parquet(folder)
    running.to_folder(running.runs(spark.readStream.schema("source string, line_no long, cui string").parquet(folder)), out, _folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("line_no", "cui", "run_id")


# Match maps of several words

PAIRED = f"{AN}, {V.PAIRED_SQL}"
#: A candidate as a term, and as a line of a report.
EV = """'ev(' || neg || ',''' || cui || ''',''' || term || ''',''' || w1 || ''',[''' || replace(term, ' ', ''',''') || '''],[''' || st || '''],' || CASE WHEN fwd THEN '[[[' || i || ',' || (i + 1) || '],[1,2],0]]' ELSE '[[[' || i || ',' || i || '],[2,2],0],[[' || (i + 1) || ',' || (i + 1) || '],[1,1],0]]' END || ',no,no,[''SRC''],[' || (i - 1) || '/2],0,0)'"""
LINE = "lpad(CAST(-neg AS VARCHAR), 6, ' ') || ' ' || term || ' (' || w1 || ') [' || st || ']'"


def _paired(spark, sf) -> DataFrame:
    return V.paired(V.utterances(spark, sf))


@query(f"{PAIRED} SELECT concat_ws('|', w1, term, '[' || w1 || ',' || w2 || ']', label) AS value FROM qc")
def r12_words_of_spans(spark, sf):
    return A.candidate_texts(_paired(spark, sf)).select("value")


@query(f"{PAIRED} SELECT pw.label, pw.no::INT AS no, (2 * coalesce(qm.n, 0))::INT AS covered, len(ws)::INT AS words FROM pw LEFT JOIN qm USING (doc_id, utt_no, no)")
def a13_match_coverage(spark, sf):
    return A.phrase_coverage(_paired(spark, sf))


@query(f"{PAIRED}, o AS (SELECT doc_id, utt_no, no, label, text, string_agg({EV}, ',' ORDER BY cn) AS evs FROM qc GROUP BY ALL) SELECT chr(10) || 'No mappings for' || chr(10) || label || chr(10) || text || chr(10) || '[' || evs || ']' AS value FROM o LEFT JOIN qm USING (doc_id, utt_no, no) WHERE qm.n IS NULL")
def r16_odd_mapping_terms(spark, sf):
    return A.odd_mappings(_paired(spark, sf)).select("value")


@query(f"""{PAIRED}, l AS (SELECT *, {LINE} AS line FROM qc), o AS (SELECT l.doc_id, l.utt_no, l.no, label, text, score, min(neg) AS best, string_agg(line, chr(10) ORDER BY cn) AS cands, string_agg(line, chr(10) ORDER BY cn) FILTER (i % 2 = 1) AS maps FROM l JOIN qm USING (doc_id, utt_no, no) GROUP BY ALL)
SELECT label, no::INT AS no, concat_ws(chr(10), '', 'Non-monotonic mapping for', label || ' ' || text, 'Candidates:', cands, 'Meta Mapping (' || (-score) || '):', maps) AS value FROM o WHERE score > best""")
def r20_non_monotonic(spark, sf):
    return A.non_monotonic(_paired(spark, sf)).select("label", "no", "value")


@query(f"{PAIRED} SELECT pw.label, pw.no::INT AS no, 1 AS i, qm.inv::INT AS inversions FROM pw JOIN qm USING (doc_id, utt_no, no)")
def r20_inversions(spark, sf):
    return A.mapping_inversions(_paired(spark, sf))


#: Names of concepts: each document's are the terms of its turns of even number; and each turn's text and its longer terms name one more.
NAMES = """names AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS cui, term AS name FROM qc WHERE utt_no % 2 = 0 UNION SELECT DISTINCT 'U' || label, term FROM qc WHERE length(w1) > 4 UNION SELECT DISTINCT 'U' || label, text FROM u0)"""


def _names(u: DataFrame) -> DataFrame:
    """(cui, name): what NAMES has, and rows without a concept, which named_concepts() drops; candidates are read once."""
    terms = u.select("doc_id", "utt_no", "label", F.explode("phrases").alias("p")).select("doc_id", "utt_no", "label", F.explode("p.cands").alias("e")).select("doc_id", "utt_no", "label", "e.meta_term", "e.preferred_name")
    own = F.when(F.col("utt_no") % 2 == 0, F.col("doc_id").cast("string"))
    longer = F.when(F.length("preferred_name") > 4, F.concat(F.lit("U"), "label"))
    named = terms.select(F.explode(F.array(own, longer)).alias("cui"), F.col("meta_term").alias("name"))
    return named.unionByName(u.selectExpr("concat('U', label) AS cui", "text AS name"))


def _named_paired(spark, sf) -> DataFrame:
    """What the filter and the names of concepts need of the annotated conversations, written once: both read it several times."""
    # Work for each byte is large here, so turns are dealt out before it.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    u = V.paired_candidates(spark, sf, n)
    return stored(u, _folder(spark, "paired"))


def _meta_sql(own: str, head: str) -> str:
    """The first candidate of each concept, those below 640 cut off, without the input's own."""
    return f"""{PAIRED}, {NAMES}, own AS ({own}),
f1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, utt_no, no, w1 ORDER BY cn) AS rn, coalesce(min(cn) FILTER (-neg < 640) OVER (PARTITION BY doc_id, utt_no, no), 1000000) AS bad FROM qc),
f2 AS (SELECT * FROM f1 WHERE rn = 1 AND cn < bad AND term <> utt AND w1 <> utt AND NOT EXISTS (SELECT 1 FROM names n JOIN own o ON n.cui = o.cui WHERE n.name = f1.term AND o.doc_id = f1.doc_id AND o.utt_no = f1.utt_no)),
f3 AS (SELECT doc_id, utt_no, no, label, utt, string_agg(lpad(CAST(-neg AS VARCHAR), 6, ' ') || ' ' || term || ' (' || w1 || ')', chr(10) ORDER BY cn) AS ls FROM f2 GROUP BY ALL)
SELECT label, no::INT AS no, CASE WHEN no = min(no) OVER (PARTITION BY doc_id, utt_no) THEN chr(10) || chr(10) || {head} || chr(10) ELSE '' END || ls AS value FROM f3"""


@query(_meta_sql("SELECT doc_id, utt_no, CAST(doc_id AS VARCHAR) AS cui FROM u0", "utt"))
def r20_filter_for_meta(spark, sf):
    u = _named_paired(spark, sf)
    return TI.filtered_for_input(u, _names(u), threshold=640).select("label", "no", "value")


@query(_meta_sql("SELECT u0.doc_id, u0.utt_no, n.cui FROM u0 JOIN names n ON n.name = u0.text", "split_part(label, '.', 1) || '|' || split_part(label, '.', 2) || '|' || utt"))
def r20_filter_for_meta_with_sy_id(spark, sf):
    u = _named_paired(spark, sf)
    return TI.filtered_for_input(u, _names(u), with_sy_id=True, threshold=640).select("label", "no", "value")


# Contents of what is written and read again

CONTENTS = SQL["s14_sql_utterances"]


def _contents(u: DataFrame) -> DataFrame:
    """Each phrase of utterances with its items and candidates as text."""
    x = u.select("doc_id", "utt_no", "label", "text", F.explode("phrases").alias("p"))
    items = F.array_join(F.transform("p.items", lambda i: F.concat_ws(":", i["category"], i["tokens"][0])), " ")
    return x.select("doc_id", "utt_no", "label", "text", "p.no", F.col("p.text").alias("phrase"), items.alias("items"), F.array_join("p.cands.meta_term", " ").alias("cands"))


@query(CONTENTS)
def k14_json_contents(spark, sf):
    schema = f"doc_id bigint, utterances array<struct<utt_no:bigint,label:string,text:string,phrases:array<{A.PHRASE}>>>"
    x = A.to_json(V.utterances(spark, sf)).select("doc_id", F.explode(F.from_json("value", schema)["utterances"]).alias("u"))
    return _contents(x.select("doc_id", "u.*"))


@query(CONTENTS)
def s13_segment_contents(spark, sf):
    return _contents(A.from_sequence(A.flat_sequence(V.utterances(spark, sf))))


@query(AN + """, c AS (SELECT doc_id, utt_no, no, string_agg(w, ' ' ORDER BY cn) AS cs FROM ca GROUP BY ALL), m AS (SELECT doc_id, utt_no, no, string_agg(neg_score, ' ' ORDER BY i) AS ms FROM mp GROUP BY ALL)
SELECT doc_id, utt_no, 0 AS seq, 'utterance' AS kind, label || '|' || text AS said FROM u0 UNION ALL SELECT doc_id, utt_no, (1 + 3 * no)::INT, 'phrase', text FROM ph
UNION ALL SELECT doc_id, utt_no, (2 + 3 * no)::INT, 'candidates', coalesce(cs, '') FROM ph LEFT JOIN c USING (doc_id, utt_no, no) UNION ALL SELECT doc_id, utt_no, (3 + 3 * no)::INT, 'mappings', coalesce(ms, '') FROM ph LEFT JOIN m USING (doc_id, utt_no, no)
UNION ALL SELECT doc_id, utt_no, (1 + 3 * len(ps))::INT, 'EOU', '' FROM u0""")
def k15_sequence_contents(spark, sf):
    x = A.flat_sequence(V.utterances(spark, sf))
    get = lambda path: F.get_json_object("value", path)
    terms = F.array_join(F.from_json("value", f"cands array<{A.EV}>")["cands"]["meta_term"], " ")
    scores = F.array_join(F.from_json("value", "mappings array<struct<neg_score:int>>")["mappings"]["neg_score"].cast("array<string>"), " ")
    kind = F.col("kind")
    said = F.when(kind == "utterance", F.concat_ws("|", get("$.label"), get("$.text"))).when(kind == "phrase", get("$.text")).when(kind == "candidates", terms).when(kind == "mappings", scores).otherwise("")
    return x.select("doc_id", "utt_no", "seq", "kind", said.alias("said"))
