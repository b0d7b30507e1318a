"""Inputs for the queries, derived from the provided tables by plain expressions that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import annotations as A
from ..operators.termfilter import PREPOSITIONS
from ..sources.readers import TERM_FIELDS

SEM5 = ("dsyn", "fndg", "gngm", "hlca", "qlco")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def terms(spark: SparkSession, sf_dir: str, interleaved: bool = False) -> DataFrame:
    """(line_no, line, 18 fields) from part: names in seven styles; with `interleaved`, concepts come in short runs and come back."""
    first, rest = "substring_index(p_name, ' ', 1)", "substring(p_name, length(substring_index(p_name, ' ', 1)) + 2)"
    styled = f"""CASE p_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat({rest}, ', ', {first}) WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN concat('[X]', p_name)
      WHEN 4 THEN concat(p_name, ', NOS') WHEN 5 THEN concat({first}, '''s ', {rest}) ELSE p_name END"""
    cui = "(p_partkey div 5) % 40" if interleaved else "p_partkey % 40"
    x = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS line_no" if interleaved else "(p_partkey % 40) * 1000000000 + p_partkey AS line_no",
        f"concat('C', lpad(cast({cui} AS string), 7, '0')) AS cui", "'ENG' AS lat",
        "CASE WHEN p_partkey % 7 IN (0, 3) THEN 'P' WHEN p_partkey % 7 IN (1, 4) THEN 'S' WHEN p_partkey % 7 = 2 THEN 'p' ELSE CASE WHEN p_partkey % 2 = 0 THEN 's' ELSE 'S' END END AS ts",
        "concat('L', lpad(cast(p_partkey % 300 AS string), 7, '0')) AS lui", "CASE WHEN p_partkey % 3 = 0 THEN 'PF' ELSE 'VO' END AS stt",
        "concat('S', lpad(cast(p_partkey % 500 AS string), 7, '0')) AS sui", "'Y' AS ispref", "concat('A', lpad(cast(p_partkey AS string), 9, '0')) AS aui",
        "'' AS saui", "'' AS scui", "'' AS sdui", "concat('SAB', cast(p_size % 3 AS string)) AS sab", "'PT' AS tty", "p_brand AS code", f"{styled} AS str", "'0' AS srl", "'N' AS suppress", "'' AS cvf",
    )
    return x.select("line_no", F.concat(F.concat_ws("|", *TERM_FIELDS), F.lit("|")).alias("line"), *TERM_FIELDS)


#: The same in DuckDB, as the body of a WITH clause; {cui} and {no} choose the order.
TERMS_SQL = """
t0 AS (SELECT *, split_part(p_name, ' ', 1) AS f, substr(p_name, length(split_part(p_name, ' ', 1)) + 2) AS r FROM part),
t1 AS (SELECT {no} AS line_no, 'C' || lpad(CAST({cui} AS VARCHAR), 7, '0') AS cui, 'ENG' AS lat,
  CASE WHEN p_partkey % 7 IN (0, 3) THEN 'P' WHEN p_partkey % 7 IN (1, 4) THEN 'S' WHEN p_partkey % 7 = 2 THEN 'p' WHEN p_partkey % 2 = 0 THEN 's' ELSE 'S' END AS ts,
  'L' || lpad(CAST(p_partkey % 300 AS VARCHAR), 7, '0') AS lui, CASE WHEN p_partkey % 3 = 0 THEN 'PF' ELSE 'VO' END AS stt,
  'S' || lpad(CAST(p_partkey % 500 AS VARCHAR), 7, '0') AS sui, 'Y' AS ispref, 'A' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS aui,
  '' AS saui, '' AS scui, '' AS sdui, 'SAB' || CAST(p_size % 3 AS VARCHAR) AS sab, 'PT' AS tty, p_brand AS code,
  CASE p_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN r || ', ' || f WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN '[X]' || p_name
    WHEN 4 THEN p_name || ', NOS' WHEN 5 THEN f || '''s ' || r ELSE p_name END AS str, '0' AS srl, 'N' AS suppress, '' AS cvf FROM t0),
terms AS (SELECT *, concat_ws('|', cui, lat, ts, lui, stt, sui, ispref, aui, saui, scui, sdui, sab, tty, code, str, srl, suppress, cvf) || '|' AS line FROM t1),
n1 AS (SELECT *, regexp_replace(str, ',? NOS$', '') AS a FROM terms),
n2 AS (SELECT *, CASE WHEN regexp_matches(a, '^[^,]*[^, ][^,]*(, [^, ][^,]*)+$') AND NOT regexp_matches(lower(a), '(^|[^a-z])(of|in|to|for|with|by|on|at|from|and|or|the)([^a-z]|$)')
  THEN array_to_string(list_reverse(string_split(a, ', ')), ' ') ELSE a END AS b FROM n1),
n3 AS (SELECT *, regexp_replace(b, '^(\\[(X|V|D|M|EDTA|SO|Q)\\][ \\t]*)+', '') AS c FROM n2),
n4 AS (SELECT *, lower(c) AS d FROM n3),
n5 AS (SELECT *, regexp_replace(replace(d, '-', ' '), ' {{2,}}', ' ', 'g') AS e FROM n4),
n6 AS (SELECT *, regexp_replace(e, '([A-Za-z0-9]+)''s([^A-Za-z0-9]|$)|([A-Za-z0-9]*s)''([^A-Za-z0-9]|$)', '\\1\\2\\3\\4', 'g') AS g FROM n5),
norm AS (SELECT *, trim(g) AS nmstr, '[' || concat_ws(',', CASE WHEN a <> str THEN 'nos' END, CASE WHEN b <> a THEN 'uninv' END, CASE WHEN c <> b THEN 'parenth' END,
  CASE WHEN d <> c THEN 'case' END, CASE WHEN e <> d THEN 'hyphen' END, CASE WHEN g <> e THEN 'poss' END) || ']' AS types,
  stt = 'PF' AND ts IN ('P', 'p') AS pref, ts IN ('p', 's') AS tss FROM n6)
"""
GROUPED = TERMS_SQL.format(no="(p_partkey % 40) * 1000000000 + p_partkey", cui="p_partkey % 40")
INTERLEAVED = TERMS_SQL.format(no="p_partkey", cui="(p_partkey // 5) % 40")
RUNS_SQL = """
r0 AS (SELECT *, CASE WHEN cui IS DISTINCT FROM lag(cui) OVER (ORDER BY line_no) THEN line_no END AS st FROM norm),
runs AS (SELECT *, max(st) OVER (ORDER BY line_no) AS run_id FROM r0)
"""
FILTER_SQL = RUNS_SQL + """,
f1 AS (SELECT *, row_number() OVER (PARTITION BY run_id, line ORDER BY line_no DESC) AS dup FROM runs),
f2 AS (SELECT * FROM f1 WHERE tss OR dup = 1),
f3 AS (SELECT *, CASE WHEN tss THEN 'ntss' WHEN row_number() OVER (PARTITION BY run_id, nmstr, cui, sab, tss ORDER BY lui DESC, sui DESC, aui DESC, line DESC, line_no DESC) > 1 THEN 'nnorm' ELSE 'y' END AS status,
  pref AND dup = 1 AS el FROM f2),
f4 AS (SELECT *, CASE WHEN el THEN row_number() OVER (PARTITION BY run_id, nmstr, cui, sab, el ORDER BY lui DESC, sui DESC, aui DESC, line DESC, line_no DESC) END AS prn,
  bool_or(status = 'y') OVER (PARTITION BY run_id) AS alive FROM f3),
filtered AS (SELECT *, coalesce(prn = 1 AND status <> 'y' AND alive, false) AS restored FROM f4)
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(first, last): the first and last words of the names of the largest parts."""
    x = table(spark, sf_dir, "part").where("p_size >= 45").select(T.words(F.lower("p_name")).alias("w"))
    return x.select(F.col("w")[0].alias("first"), F.element_at("w", -1).alias("last")).distinct()


PAIRS_SQL = "pw AS (SELECT regexp_extract_all(lower(p_name), '[a-z0-9]+') AS w FROM part WHERE p_size >= 45), pairs AS (SELECT DISTINCT w[1] AS first, w[-1] AS last FROM pw)"


def english(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("lang = 'en'")


#: A short stop list, upper-cased as terms are.
STOP = ("AND", "FOR", "THE", "WITH", "FROM", "THIS", "THAT", "ARE", "WAS", "NOT")


def distinct_terms(tf: DataFrame) -> DataFrame:
    return tf.select("term").distinct()


def allow(terms: DataFrame) -> DataFrame:
    """Every term of three characters or more."""
    return terms.where("length(term) >= 3").select(F.col("term").alias("word"))


def stop(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP], "word string")


def vectors(terms: DataFrame) -> DataFrame:
    """(term, vec): integers from the length and first letter of every term, some below zero."""
    return terms.withColumn("vec", F.expr("transform(sequence(0, 128), p -> cast((length(term) * 7 + ascii(term) * 3 + p * 11) % 41 - 10 AS int))"))


PROFILE_SQL = r"""
tok AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '[!-/:-@\[-`{-~ \t\n\r\f]+'), lambda x: x <> '')) AS t FROM documents WHERE lang = 'en'),
tf AS (SELECT doc_id, replace(upper(t), 'ẞ', 'SS') AS term, count(*) AS tf FROM tok GROUP BY ALL),
keep AS (SELECT * FROM tf WHERE length(term) >= 3 AND term NOT IN ({stop})),
sums AS (SELECT doc_id, pos, (sum(tf * ((length(term) * 7 + ascii(term) * 3 + pos * 11) % 41 - 10)))::BIGINT AS s, sum(tf)::BIGINT AS n FROM keep, (SELECT unnest(range(129)) AS pos) GROUP BY doc_id, pos),
prof AS (SELECT d.doc_id, p.pos, CASE WHEN s.n IS NULL THEN 0 ELSE sign(s.s)::BIGINT * (abs(s.s) // s.n) END::BIGINT AS score
  FROM (SELECT DISTINCT doc_id FROM documents WHERE lang = 'en') d CROSS JOIN (SELECT unnest(range(129)) AS pos) p LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.pos = p.pos),
names AS (SELECT unnest(range(129)) AS pos, unnest({types}) AS semtype)
""".replace("{stop}", ", ".join(f"'{w}'" for w in STOP))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, key, property, value) from events; values are coarse, so that facts repeat."""
    return table(spark, sf_dir, "events").selectExpr("event_id AS seq", "user_id % 50 AS key", "event_type AS property", "cast(floor(value / 10) AS bigint) AS value")


FACTS_SQL = "facts AS (SELECT event_id AS seq, user_id % 50 AS key, event_type AS property, CAST(floor(value / 10) AS BIGINT) AS value FROM events)"


def utterances(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """Annotated utterances from conversations: sentences are phrases, words items, words of a length divisible by three candidates.

    ranges: plain turns are dealt out by so many ranges of doc_id first, which what is made of them keeps.
    """
    preps = ", ".join(f"'{p}'" for p in PREPOSITIONS)
    sem = ", ".join(f"'{s}'" for s in SEM5)
    ev = f"""named_struct('neg_value', cast(10 * length(s.w) - 1000 AS int), 'cui', concat('C', lpad(cast(ascii(s.w) * 100 + length(s.w) AS string), 7, '0')), 'meta_term', s.w,
      'preferred_name', substring(s.w, 1, 3), 'meta_words', array(s.w), 'sem_types', array(get(array({sem}), length(s.w) % 5)), 'match_map', array(named_struct('p1', s.i, 'p2', s.i, 'm1', 1, 'm2', 1, 'lex', 0)),
      'involves_head', 'no', 'is_overmatch', 'no', 'sources', array('SRC'), 'pos', array(named_struct('start', locate(s.w, lower(ptext)) - 1, 'length', length(s.w))), 'status', 0, 'negated', 0)"""
    item = f"""named_struct('category', CASE WHEN w IN ({preps}) THEN 'prep' WHEN length(w) <= 2 THEN 'det' WHEN length(w) >= 9 THEN 'not_in_lex' WHEN length(w) % 3 = 0 THEN 'noun' WHEN length(w) % 3 = 1 THEN 'verb' ELSE 'adj' END,
      'tag', cast(null AS string), 'inputmatch', array(w), 'lexmatch', array(CASE WHEN endswith(w, 's') THEN substring(w, 1, length(w) - 1) ELSE w END), 'tokens', array(w))"""
    cands = f"transform(array_sort(transform(filter(sequence(1, size(ws)), i -> length(get(ws, i - 1)) % 3 = 0), i -> struct(length(get(ws, i - 1)) AS n, i AS i, get(ws, i - 1) AS w))), s -> {ev})"
    maps = "filter(transform(array(0, 1), k -> transform(array(filter(cands, e -> length(e.meta_term) % 2 = k)), es -> named_struct('neg_score', array_min(transform(es, e -> e.neg_value)), 'evs', es))[0]), m -> size(m.evs) > 0)"
    x = table(spark, sf_dir, "conversations").where("text IS NOT NULL").selectExpr("conv_id AS doc_id", "turn AS utt_no", "concat(conv_id, '.', turn) AS label", "text")
    x = x.repartitionByRange(ranges, "doc_id") if ranges else x
    x = x.withColumn("ps", F.expr("filter(transform(split(text, '[.]'), s -> trim(s)), s -> s <> '')")).select("*", F.posexplode_outer("ps").alias("k", "ptext"))
    x = x.withColumn("ws", F.expr("regexp_extract_all(lower(coalesce(ptext, '')), '([a-z0-9]+)')"))
    x = x.withColumn("items", F.expr(f"transform(ws, w -> {item})")).withColumn("cands", F.expr(f"CASE WHEN size(ws) > 0 THEN {cands} ELSE cast(array() AS array<{A.EV}>) END"))
    x = x.withColumn("mappings", F.expr(maps))
    # A sentence's annotation is gathered per utterance: a turn's sentences only.
    g = x.groupBy("doc_id", "utt_no", "label", "text").agg(F.expr("array_sort(collect_list(CASE WHEN ptext IS NOT NULL THEN struct(k, struct(cast(k AS int) AS no, ptext AS text, items, named_struct('total', size(cands), 'excluded', 0, 'pruned', 0, 'remaining', size(cands)) AS counts, cands, mappings, named_struct('start', 0, 'length', length(ptext)) AS pos) AS p) END), (a, b) -> cast(a.k - b.k AS int))").alias("ps"))
    return g.select("doc_id", "utt_no", "label", "text", F.expr(f"cast(transform(ps, s -> s.p) AS array<{A.PHRASE}>)").alias("phrases"))


ANNOTATION_SQL = """
u0 AS (SELECT conv_id AS doc_id, turn AS utt_no, conv_id || '.' || turn AS label, text, list_filter(list_transform(string_split(text, '.'), lambda s: trim(s)), lambda s: s <> '') AS ps FROM conversations WHERE text IS NOT NULL),
ph AS (SELECT doc_id, utt_no, label, text AS utt, unnest(ps) AS text, generate_subscripts(ps, 1) - 1 AS no FROM u0),
pw AS (SELECT *, regexp_extract_all(lower(text), '[a-z0-9]+') AS ws FROM ph),
it0 AS (SELECT *, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM pw),
it AS (SELECT *, CASE WHEN w IN ({preps}) THEN 'prep' WHEN length(w) <= 2 THEN 'det' WHEN length(w) >= 9 THEN 'not_in_lex' WHEN length(w) % 3 = 0 THEN 'noun' WHEN length(w) % 3 = 1 THEN 'verb' ELSE 'adj' END AS category,
  CASE WHEN w LIKE '%s' THEN substr(w, 1, length(w) - 1) ELSE w END AS lex FROM it0),
ca AS (SELECT *, 10 * length(w) - 1000 AS neg, 'C' || lpad(CAST(ascii(w) * 100 + length(w) AS VARCHAR), 7, '0') AS cui, substr(w, 1, 3) AS pn, ({sem})[length(w) % 5 + 1] AS st,
  length(w) % 2 AS k, row_number() OVER (PARTITION BY doc_id, utt_no, no ORDER BY length(w), pos) AS cn FROM it WHERE length(w) % 3 = 0),
m0 AS (SELECT doc_id, utt_no, label, utt, no, text, k, min(neg) AS neg_score FROM ca GROUP BY doc_id, utt_no, label, utt, no, text, k),
mp AS (SELECT *, row_number() OVER (PARTITION BY doc_id, utt_no, no ORDER BY k) AS i, count(*) OVER (PARTITION BY doc_id, utt_no, no) AS n FROM m0),
pc AS (SELECT p.doc_id, p.utt_no, p.label, p.utt, p.no, p.text, p.ws, coalesce(c.n, 0) AS nc, coalesce(c.m, 0) AS nm FROM pw p
  LEFT JOIN (SELECT doc_id, utt_no, no, count(*) AS n, count(DISTINCT k) AS m FROM ca GROUP BY ALL) c ON p.doc_id = c.doc_id AND p.utt_no = c.utt_no AND p.no = c.no)
""".replace("{preps}", ", ".join(f"'{p}'" for p in PREPOSITIONS)).replace("{sem}", "[" + ", ".join(f"'{s}'" for s in SEM5) + "]")


def paired(u: DataFrame) -> DataFrame:
    """The annotated conversations with other candidates: neighbouring words, in their order or the other, so that match maps have two
    words or two spans; some phrases have no mapping, and some mappings are worse than the best candidate."""
    sem = ", ".join(f"'{s}'" for s in SEM5)
    w = lambda i: f"get(ws, {i})"
    fwd = f"length({w('i')}) % 2 = 0"
    ev = f"""named_struct('neg_value', cast(-(600 + 10 * length({w('i - 1')}) + length({w('i')})) AS int), 'cui', concat('P', lpad(cast(ascii({w('i - 1')}) * 100 + length({w('i')}) AS string), 7, '0')),
      'meta_term', if({fwd}, concat_ws(' ', {w('i - 1')}, {w('i')}), concat_ws(' ', {w('i')}, {w('i - 1')})), 'preferred_name', {w('i - 1')}, 'meta_words', if({fwd}, array({w('i - 1')}, {w('i')}), array({w('i')}, {w('i - 1')})),
      'sem_types', array(get(array({sem}), length({w('i - 1')}) % 5)), 'match_map', if({fwd}, array(named_struct('p1', i, 'p2', i + 1, 'm1', 1, 'm2', 2, 'lex', 0)), array(named_struct('p1', i, 'p2', i, 'm1', 2, 'm2', 2, 'lex', 0), named_struct('p1', i + 1, 'p2', i + 1, 'm1', 1, 'm2', 1, 'lex', 0))),
      'involves_head', 'no', 'is_overmatch', 'no', 'sources', array('SRC'), 'pos', array(named_struct('start', i - 1, 'length', 2)), 'status', 0, 'negated', 0)"""
    at = f"filter(sequence(1, size(ws) - 1), i -> length({w('i - 1')}) % 2 = 0)"
    pairs = f"if(size(ws) > 1, transform(array_sort(transform({at}, i -> struct({ev}.neg_value AS n, i AS i, {ev} AS e))), s -> struct(s.i AS i, s.e AS e)), cast(array() AS array<struct<i:int,e:{A.EV}>>))"
    mapping = f"if(size(odd) > 0 AND length(p.text) % 3 <> 0, array(named_struct('neg_score', array_max(transform(odd, e -> e.neg_value)), 'evs', odd)), cast(array() AS array<struct<neg_score:int,evs:array<{A.EV}>>>))"
    phrase = f"named_struct('no', p.no, 'text', p.text, 'items', p.items, 'counts', named_struct('total', size(c), 'excluded', 0, 'pruned', 0, 'remaining', size(c)), 'cands', transform(c, s -> s.e), 'mappings', {mapping}, 'pos', p.pos)"
    # Each utterance by itself: nothing is gathered again.
    named = lambda value, name, body: f"transform(array({value}), {name} -> {body})[0]"
    body = named("flatten(transform(p.items, i -> i.tokens))", "ws", named(pairs, "c", named("transform(filter(c, s -> s.i % 2 = 1), s -> s.e)", "odd", phrase)))
    return u.select("doc_id", "utt_no", "label", "text", F.expr(f"cast(transform(phrases, p -> {body}) AS array<{A.PHRASE}>)").alias("phrases"))


def paired_candidates(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """What paired() makes of the conversations, with no more of phrases than no, text and candidates' neg_value, meta_term and
    preferred_name: each turn by itself, and what else annotates it is not made."""
    w = lambda i: f"get(ws, {i})"
    # A list sorted by score, then place; terms are put together afterwards.
    at = f"filter(sequence(1, size(ws) - 1), i -> length({w('i - 1')}) % 2 = 0)"
    found = f"array_sort(transform({at}, i -> struct(-(600 + 10 * length({w('i - 1')}) + length({w('i')})) AS n, i AS i)))"
    term = f"if(length({w('s.i')}) % 2 = 0, concat({w('s.i - 1')}, ' ', {w('s.i')}), concat({w('s.i')}, ' ', {w('s.i - 1')}))"
    cands = f"if(size(ws) > 1, transform({found}, s -> struct(s.n AS neg_value, {term} AS meta_term, {w('s.i - 1')} AS preferred_name)), array())"
    phrase = f"transform(array(regexp_extract_all(lower(s), '([a-z0-9]+)')), ws -> struct(k AS no, s AS text, {cands} AS cands))[0]"
    ps = "filter(transform(split(text, '[.]'), s -> trim(s)), s -> s <> '')"
    x = table(spark, sf_dir, "conversations").where("text IS NOT NULL").selectExpr("conv_id AS doc_id", "turn AS utt_no", "concat(conv_id, '.', turn) AS label", "text")
    x = x.repartition(partitions) if partitions else x
    return x.withColumn("phrases", F.expr(f"transform({ps}, (s, k) -> {phrase})"))


PAIRED_SQL = """
q0 AS (SELECT a.doc_id, a.utt_no, a.label, a.utt, a.no, a.text, a.pos AS i, a.w AS w1, b.w AS w2, length(b.w) % 2 = 0 AS fwd, ({sem})[length(a.w) % 5 + 1] AS st FROM it0 a JOIN it0 b ON a.doc_id = b.doc_id AND a.utt_no = b.utt_no AND a.no = b.no AND b.pos = a.pos + 1 WHERE length(a.w) % 2 = 0),
q1 AS (SELECT *, CASE WHEN fwd THEN w1 || ' ' || w2 ELSE w2 || ' ' || w1 END AS term, -(600 + 10 * length(w1) + length(w2)) AS neg, 'P' || lpad(CAST(ascii(w1) * 100 + length(w2) AS VARCHAR), 7, '0') AS cui FROM q0),
qc AS (SELECT *, row_number() OVER (PARTITION BY doc_id, utt_no, no ORDER BY neg, i) AS cn FROM q1),
qm AS (SELECT doc_id, utt_no, no, max(neg) AS score, count(*) AS n, count(*) FILTER (NOT fwd) AS inv FROM qc WHERE i % 2 = 1 AND length(text) % 3 <> 0 GROUP BY ALL)
""".replace("{sem}", "[" + ", ".join(f"'{s}'" for s in SEM5) + "]")
