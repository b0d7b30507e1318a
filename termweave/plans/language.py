"""Queries of the tagger, the closure of variants and trees of codes; catalog.queries registers them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import annotations as A
from ..operators import tagger as TG
from ..operators import termfilter as TF
from ..operators import trees as TR
from ..operators import variants as VA
from . import views as V
from ..operators.steps import checkpoint_root, written
from ..sources import annotated as A2
from ..sources import term_source as TS
from .catalog import AN, LONGER, PREPS, SAID, _longer, query

# Tagging


def _names(spark, sf) -> DataFrame:
    """Names with prepositional phrases after them, and their words."""
    return _longer(spark, sf).withColumn("w", T.words(F.col("nmstr")))


def _annotated_names(names: DataFrame) -> DataFrame:
    """A category for each word of a name, by its place and length; the same word has several."""
    preps = ", ".join(f"'{p}'" for p in TF.PREPOSITIONS)
    return names.selectExpr("aui", f"""transform(w, (x, i) -> named_struct('category', CASE WHEN x IN ({preps}) THEN 'prep' WHEN i = 0 THEN if(sab = 'SAB0', 'adj', 'noun') WHEN i = size(w) - 1 THEN 'noun'
      WHEN length(x) % 3 = 0 THEN 'adj' WHEN length(x) % 3 = 1 THEN 'noun' ELSE 'verb' END, 'word', x)) AS items""")


def _tagged(spark, sf) -> DataFrame:
    names = _names(spark, sf)
    return TG.tag(names, TG.train(_annotated_names(names)), "w")


TAGS = f"""{LONGER},
names AS (SELECT * FROM cut),
items AS (SELECT aui, ix, w[ix] AS word, CASE WHEN list_contains({PREPS}, w[ix]) THEN 'prep' WHEN ix = 1 THEN CASE sab WHEN 'SAB0' THEN 'adj' ELSE 'noun' END WHEN ix = len(w) THEN 'noun'
  WHEN length(w[ix]) % 3 = 0 THEN 'adj' WHEN length(w[ix]) % 3 = 1 THEN 'noun' ELSE 'verb' END AS category FROM (SELECT *, unnest(range(1, len(w) + 1)) AS ix FROM names)),
em AS (SELECT word, category, count(*) AS n FROM items GROUP BY ALL),
nb AS (SELECT a, b, count(*) AS n FROM (SELECT coalesce(lag(category) OVER (PARTITION BY aui ORDER BY ix), '^') AS a, category AS b FROM items
  UNION ALL SELECT arg_max(category, ix), '^' FROM items GROUP BY aui) GROUP BY ALL),
cats AS (SELECT DISTINCT category AS c FROM items),
tot AS (SELECT a AS c, sum(n) AS t FROM nb GROUP BY a),
k AS (SELECT count(DISTINCT word) AS kinds, (SELECT count(*) FROM cats) AS nc FROM em),
st AS (SELECT x.a, y.b, round(-1000 * ln((coalesce(nb.n, 0) + 1) / (tot.t + nc + 1)))::BIGINT AS cost FROM (SELECT c AS a FROM tot) x CROSS JOIN (SELECT c AS b FROM cats UNION ALL SELECT '^') y
  LEFT JOIN nb ON nb.a = x.a AND nb.b = y.b JOIN tot ON tot.c = x.a CROSS JOIN k),
ec AS (SELECT w.word, cats.c, round(-1000 * ln((coalesce(em.n, 0) + 1) / (t + kinds + 1)))::BIGINT AS cost FROM (SELECT DISTINCT word FROM em) w CROSS JOIN cats LEFT JOIN em ON em.word = w.word AND em.category = cats.c JOIN tot ON tot.c = cats.c CROSS JOIN k),
sent AS (SELECT DISTINCT w FROM names WHERE len(w) > 0),
v AS (SELECT w, 1::BIGINT AS ix, c AS cat, st.cost + ec.cost AS cost, [c] AS path FROM sent JOIN ec ON ec.word = w[1] JOIN st ON st.a = '^' AND st.b = c
  UNION ALL SELECT v.w, v.ix + 1, ec.c, min(v.cost + st.cost + ec.cost), min_by(list_append(v.path, ec.c), (v.cost + st.cost, v.cat)) FROM v JOIN ec ON ec.word = v.w[v.ix + 1] JOIN st ON st.a = v.cat AND st.b = ec.c
  WHERE v.ix < len(v.w) GROUP BY v.w, v.ix, ec.c),
best AS (SELECT v.w, min_by(v.path, (v.cost + st.cost, v.cat)) AS tags FROM v JOIN st ON st.a = v.cat AND st.b = '^' WHERE v.ix = len(v.w) GROUP BY v.w)"""
CHUNKS = f"""tg AS (SELECT names.*, coalesce(tags, []) AS tags FROM names LEFT JOIN best ON names.w = best.w),
kd AS (SELECT *, list_transform(tags, lambda t: CASE WHEN t IN ('prep', 'conj', 'compl') THEN 'o' WHEN t IN ('verb', 'aux', 'modal') THEN 'v' WHEN t = 'det' THEN 'd' ELSE 'n' END) AS kinds FROM tg),
ch AS (SELECT *, list_filter(range(1, len(w) + 1), lambda i: i = 1 OR list_contains({list(TG.CUTS)}, kinds[i - 1] || kinds[i])) AS starts FROM kd),
tnorm AS (SELECT *, len(starts) = 1 OR len(starts) > 1 AND len(list_filter(range(2, len(starts) + 1), lambda j: tags[starts[j]] <> 'prep' OR coalesce(starts[j + 1], len(w) + 1) - starts[j] < 2 OR j > 2 AND w[starts[j]] <> 'of')) = 0 AS simple FROM ch)"""
WITH = f"WITH RECURSIVE {V.GROUPED}, "
TSTRICT = V.FILTER_SQL.replace("FROM norm", "FROM tnorm").replace("ELSE 'y' END AS status", "WHEN NOT simple THEN 'nsynt' ELSE 'y' END AS status")


@query(f"{WITH}{TAGS} SELECT aui, array_to_string(coalesce(tags, []), ' ') AS tags FROM names LEFT JOIN best ON names.w = best.w")
def f5_tags(spark, sf):
    return _tagged(spark, sf).select("aui", F.array_join("tags", " ").alias("tags"))


@query(f"{WITH}{TAGS}, {CHUNKS}, {TSTRICT} SELECT aui, status, CASE WHEN restored THEN 'y' ELSE status END AS final_status FROM filtered")
def f4_tagged_filter(spark, sf):
    x = _tagged(spark, sf).withColumn("simple", TG.is_simple_tagged(TG.tagged_chunks(F.col("w"), F.col("tags"))))
    return TF.filter_terms(x, F.col("simple")).select("aui", "status", "final_status")


@query(f"""{WITH}{TAGS}, {CHUNKS} SELECT aui, concat_ws('|', CASE WHEN len(w) = 0 THEN '1|1' ELSE len(starts) || '|' || len(w) END, cui, sab, code, nmstr,
  array_to_string(list_transform(range(1, len(starts) + 1), lambda j: '[' || array_to_string(list_transform(range(starts[j], coalesce(starts[j + 1], len(w) + 1)), lambda i: tags[i] || ':' || w[i]), ',') || ']'), '')) AS value FROM tnorm""")
def f6_tagged_syntax(spark, sf):
    x = _tagged(spark, sf).withColumn("ph", TG.tagged_chunks(F.col("w"), F.col("tags")))
    return TF.tagged_syntax_dump(x, "aui")


# Variants


def _chains(spark, sf) -> DataFrame:
    """Forms in chains of twelve with shortcuts, ways back to the start, and adjectives to and fro."""
    edge = lambda base, bcat, word, cat, kind, distance: f"named_struct('base', {base}, 'base_cat', '{bcat}', 'word', {word}, 'cat', '{cat}', 'kind', '{kind}', 'distance', cast({distance} AS int))"
    n, a = "concat('n', p_partkey)", "concat('a', p_partkey)"
    on = lambda when, plus: f"if({when}, concat('n', p_partkey + {plus}), NULL)"
    rows = [edge(n, "noun", on("p_partkey % 12 <> 11", 1), "noun", "i", "p_size % 4"), edge(n, "noun", on("p_partkey % 12 <= 8", 3), "noun", "s", 5), edge(n, "noun", on("p_partkey % 12 = 11", -11), "noun", "d", 2), edge(n, "noun", a, "adj", "d", 3), edge(a, "adj", n, "noun", "d", 3)]
    return V.table(spark, sf, "part").selectExpr(f"inline(array({', '.join(rows)}))")


@query("""WITH RECURSIVE e AS (SELECT 'n' || p_partkey AS base, 'noun' AS bcat, 'n' || (p_partkey + 1) AS w, 'noun' AS c, 'i' AS kind, (p_size % 4)::INT AS dist FROM part WHERE p_partkey % 12 <> 11
  UNION ALL SELECT 'n' || p_partkey, 'noun', 'n' || (p_partkey + 3), 'noun', 's', 5 FROM part WHERE p_partkey % 12 <= 8 UNION ALL SELECT 'n' || p_partkey, 'noun', 'n' || (p_partkey - 11), 'noun', 'd', 2 FROM part WHERE p_partkey % 12 = 11
  UNION ALL SELECT 'n' || p_partkey, 'noun', 'a' || p_partkey, 'adj', 'd', 3 FROM part UNION ALL SELECT 'a' || p_partkey, 'adj', 'n' || p_partkey, 'noun', 'd', 3 FROM part),
v AS (SELECT 'n' || p_partkey AS term, CASE WHEN p_size % 5 <> 0 THEN 'noun' END AS tcat, 'n' || p_partkey AS word, CASE WHEN p_size % 5 <> 0 THEN 'noun' END AS cat, {'l': 0, 'n': 0, 'k': []::VARCHAR[]} AS p FROM part
  UNION ALL SELECT term, tcat, w, c, min({'l': p.l + dist, 'n': p.n + 1, 'k': list_append(p.k, kind)}) FROM v JOIN e ON word = base AND (cat IS NULL OR cat = bcat) WHERE p.n < 16 GROUP BY term, tcat, w, c)
SELECT term, tcat AS term_cat, word, cat, min(p).l::INT AS var_level, array_to_string(min(p).k, '') AS history FROM v GROUP BY term, tcat, word, cat""")
def j9_variant_closure(spark, sf):
    p = V.table(spark, sf, "part")
    lexicon = p.where("p_size % 5 <> 0").selectExpr("concat('n', p_partkey) AS form", "'noun' AS cat")
    return VA.closure(VA.categories(p.selectExpr("concat('n', p_partkey) AS term"), lexicon), _chains(spark, sf))


# Trees of codes


def _codes(u: DataFrame) -> DataFrame:
    """(cui, code): codes of one to four segments, several to a concept."""
    return A.candidates(u).select("ev.cui", F.expr("concat('T', array_join(transform(sequence(1, 1 + length(ev.meta_term) % 4), i -> cast(ascii(substring(ev.meta_term, i, 1)) % (2 + i) AS string)), '.'))").alias("code")).distinct()


CODES = "codes AS (SELECT DISTINCT cui, 'T' || array_to_string(list_transform(range(1, 2 + length(w) % 4), lambda i: (ascii(substr(w, i, 1)) % (2 + i))::VARCHAR), '.') AS code FROM ca)"
#: The deepest of codes in a list l, and the longest common prefix of its segments.
DEEPEST = "list_sort(list_transform(l, lambda c: {'d': -len(string_split(c, '.')), 'c': c}))[1].c"
COMMON = """array_to_string(string_split(l[1], '.')[1:len(list_filter(range(1, len(string_split(l[1], '.')) + 1), lambda n: len(list_filter(l, lambda c: array_to_string(string_split(c, '.')[1:n], '.') <> array_to_string(string_split(l[1], '.')[1:n], '.'))) = 0))], '.')"""


@query(f"{AN}, {CODES}, g AS (SELECT label, no::INT AS no, mp.i::INT AS i, list(DISTINCT code ORDER BY code) AS l FROM ca JOIN mp USING (doc_id, utt_no, no, k, label) JOIN codes USING (cui) GROUP BY ALL) "
       f"SELECT label, no, i, array_to_string(l, ' ') AS codes, {DEEPEST} AS deepest, len(string_split({DEEPEST}, '.'))::INT AS specificity, {COMMON} AS common FROM g")  # fmt: skip
def a17_mapping_specificity(spark, sf):
    u = V.utterances(spark, sf)
    maps = A.mapped(u).select("label", "no", "i", F.explode("evs.cui").alias("cui"))
    return TR.specificity(maps, _codes(u), ("label", "no", "i")).select("label", "no", "i", F.array_join("codes", " ").alias("codes"), "deepest", "specificity", "common")


@query(f"{AN}, {CODES}, d AS (SELECT doc_id, utt_no, no, max(len(string_split(code, '.'))) AS m FROM ca JOIN codes USING (cui) GROUP BY ALL) "
       "SELECT ph.label, ph.no::INT AS no, concat_ws('|', ph.label, ph.text, coalesce(-mp.neg_score, 0), coalesce(d.m, 0), len(list_filter(string_split(ph.text, ' '), lambda w: w <> '')), length(ph.text)) AS value "
       "FROM ph LEFT JOIN d USING (doc_id, utt_no, no) LEFT JOIN mp ON mp.doc_id = ph.doc_id AND mp.utt_no = ph.utt_no AND mp.no = ph.no AND mp.i = 1")  # fmt: skip
def r20_phrase_specificity(spark, sf):
    u = V.utterances(spark, sf)
    return TR.phrase_specificity(u, _codes(u)).select("label", "no", "value")


@query(f"{AN}, {CODES}, c AS (SELECT DISTINCT code FROM codes), p AS (SELECT code, array_to_string(string_split(code, '.')[1:n], '.') AS up, n FROM (SELECT code, unnest(range(1, len(string_split(code, '.')))) AS n FROM c)), "
       "b AS (SELECT p.code, arg_max(up, n) AS nearest FROM p JOIN c ON c.code = p.up GROUP BY p.code) SELECT cui, codes.code, nearest FROM codes LEFT JOIN b USING (code)")  # fmt: skip
def a17_nearest_code(spark, sf):
    codes = _codes(V.utterances(spark, sf))
    return TR.nearest_node(codes, "code", codes.select(F.col("code").alias("node")))


# Files of terms as a data source


def _stored(spark, sf) -> str:
    """The annotated conversations written as files of terms, a document in one of them."""
    TS.register(spark)
    folder = f"{checkpoint_root(spark)}/terms-{uuid.uuid4().hex}"
    TS.documents(A2.term_lines(V.utterances(spark, sf).where(F.size("phrases") > 0))).write.format("annotated_terms").mode("overwrite").save(folder)
    return folder


@query(SAID + ", p AS (SELECT doc_id, utt_no, no, string_agg(cui || ':' || w || '@' || (position(w IN lower(text)) - 1) || '/' || length(w), ' ' ORDER BY cn) AS cs FROM ca GROUP BY ALL) "
       "SELECT said.label, said.text, ph.no::INT AS no, ph.text AS phrase, coalesce(cs, '') AS cands FROM said JOIN ph USING (doc_id, utt_no) LEFT JOIN p USING (doc_id, utt_no, no)")  # fmt: skip
def s14_stored_phrases(spark, sf):
    u = spark.read.format("annotated_terms").load(_stored(spark, sf))
    cand = lambda e: F.concat(e["cui"], F.lit(":"), e["meta_term"], F.lit("@"), F.array_join(F.transform(e["pos"], lambda s: F.concat_ws("/", s["start"], s["length"])), ","))
    x = u.select("label", "text", F.explode("phrases").alias("p"))
    # Written before it is returned: the files are not read again.
    return written(x.select("label", "text", "p.no", F.col("p.text").alias("phrase"), F.array_join(F.transform("p.cands", cand), " ").alias("cands")))


@query(SAID + "SELECT label, utt_no = min(utt_no) OVER (PARTITION BY doc_id) AS starts, CASE WHEN utt_no = min(utt_no) OVER (PARTITION BY doc_id) THEN '[termweave,[]]' END AS args FROM said")
def s12_stored_headers(spark, sf):
    u = spark.read.format("annotated_terms").schema(f"label string, starts boolean, header {A2.HEADER}").load(_stored(spark, sf))
    return written(u.select("label", "starts", "header.args"))
