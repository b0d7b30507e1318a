"""What keeps queries within their memory and disk when tables grow, seen on small ones."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from termweave import tools
from termweave.functions import text as T
from termweave.operators import terminput as TI
from termweave.operators import variants as VA
from termweave.plans import views as V
from termweave.sources import annotated as AN


def _plans(spark, run):
    """The plans of all executions that run() causes."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return [x.physicalPlanDescription() for x in map(store.executionsList().apply, range(before, store.executionsCount()))]


def test_closure_broadcasts_no_edges(spark):
    """Nothing of the closure is sent through the driver, however small Spark takes the edges to be."""
    e = spark.range(40).selectExpr("concat('w', id) AS base", "'noun' AS base_cat", "concat('w', id + 1) AS word", "'noun' AS cat", "'i' AS kind", "1 AS distance").where("id % 4 <> 3")
    terms = spark.range(40).selectExpr("concat('w', id) AS term", "'noun' AS cat")
    rows = []
    plans = _plans(spark, lambda: rows.append(VA.closure(terms, e).count()))
    assert rows == [100] and len(plans) > 4
    assert not [p for p in plans if "BroadcastExchange" in p]


@pytest.mark.parametrize("with_sy_id", [False, True])
def test_filter_for_input_moves_rows_not_lists(spark, with_sy_id):
    """A term that very many concepts share is not a list of them beside each of its candidates; results as by the rule."""
    cand = "struct<neg_value:int,meta_term:string,preferred_name:string>"
    u = spark.createDataFrame([(1, 1, "c1.a", "big heart", [(0, "big heart", [(-900, "heart", "h"), (-800, "lung", "l")])])], f"doc_id long, utt_no long, label string, text string, phrases array<struct<no:int,text:string,cands:array<{cand}>>>")
    names = spark.range(50).selectExpr("concat('c', id) AS cui", "'heart' AS name").union(spark.sql("SELECT 'c7', 'Big Heart'"))
    got = TI.filtered_for_input(u, names, with_sy_id)
    assert [r.value for r in got.collect()] == ["\n\n" + ("c1|a|" if with_sy_id else "") + "big heart\n   800 lung (l)"]
    assert "collect_set" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_print_parses_once_before_it_sorts(spark, tmp_path):
    """No plan both parses and sorts by ranges, as the ranges' sample would parse every block a second time."""
    (tmp_path / "in").write_text("args('t',[]).\naas([]).\nneg_list([]).\nutterance('1.1',\"a\",0/1,[]).\nphrase('a',[noun([inputmatch(['a'])])],0/1,[]).\ncandidates(0,0,0,0,[]).\nmappings([]).\n'EOU'.\n")
    plans = _plans(spark, lambda: tools.print_annotated(spark, str(tmp_path / "in"), str(tmp_path / "out"), report="phrase_dump"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", ""]
    assert not [p for p in plans if "rangepartitioning" in p and "parse(" in p]


def test_normal_form_is_the_norm_of_normalize(spark):
    odd = ["", " ", "a", " a", "a ", "a b", "a-b", "a - b", "a\n", "b, a", "b , a", ",a", "dogs' x", "dog's", "a'", "x NOS", "[X]Foo, NOS", "ab\ncd", "\u00e9t\u00e9", "e1 e2", None, "a " * 5000 + "a", ", ".join(["ab cd"] * 3000)]
    x = spark.createDataFrame([(s,) for s in odd], "s string")
    assert [r[0] for r in x.select(T.normal_form(F.col("s"))).collect()] == [r[0] for r in x.select(T.normalize(F.col("s"))["norm"]).collect()]


def test_paired_candidates_are_those_of_paired(spark):
    cand = lambda e: F.struct(e["neg_value"].alias("neg_value"), e["meta_term"].alias("meta_term"), e["preferred_name"].alias("preferred_name"))
    slim = lambda p: F.struct(p["no"].alias("no"), p["text"].alias("text"), F.transform(p["cands"], cand).alias("cands"))
    rows = [(1, 1, "Big hearts in. a"), (1, 2, ""), (1, 3, "..\n."), (2, 1, "\u00c9t\u00e9 is in it. is is is is"), (2, 2, None)]
    with tempfile.TemporaryDirectory() as d:
        spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{d}/conversations.parquet")
        a = V.paired(V.utterances(spark, d)).select("doc_id", "utt_no", "label", "text", F.transform("phrases", slim).alias("phrases")).orderBy("label").collect()
        assert V.paired_candidates(spark, d).orderBy("label").collect() == a and len(a) == 4


def test_filter_for_input_makes_candidates_once(spark):
    """What meets the concepts of a text twice is read from files, not cut from phrases again."""
    cand = "struct<neg_value:int,meta_term:string,preferred_name:string>"
    u = spark.createDataFrame([(1, 1, "c1.a", "big heart", [(0, "big heart", [(-900, "heart", "h")])])], f"doc_id long, utt_no long, label string, text string, phrases array<struct<no:int,text:string,cands:array<{cand}>>>")
    x = TI.filtered_for_input(u, spark.sql("SELECT 'c7' AS cui, 'Lung' AS name"), True)
    assert "Generate" not in x._jdf.queryExecution().optimizedPlan().toString() and [r.value for r in x.collect()] == ["\n\nc1|a|big heart\n   900 heart (h)"]


PHRASES = """phrase('l''eau\nx',[noun([lexmatch(['a']),inputmatch(['a''s']),tokens(['a'])]),not_in_lex([inputmatch(['\u00e9']),tokens([])])],0/5,[]).
candidates(1,0,0,1,[ev(-970,'C1','','p',['a','b'],[],[[[1,1],[1,2],0],[[2,2],[3,3],0]],no,yes,['S'],[0/2,3/4],0,1)]).
mappings([map(-970,[ev(-970,'C1','m','p',['a'],['x'],[],no,no,['S'],[],0,0)]),map(-1,[])]).
phrase('',[],0/0,[]).
candidates(0,0,0,0,[]).
mappings([])."""
SAID = "utterance('1.1',\"a \"\"q\"\"\nx\",0/3,[]).\n"


@pytest.mark.parametrize("change", [("", ""), ("-970", "-9.5"), ("0/5", "0 / 5"), ("no,yes", "'no',yes"), ("'x'", "x"), ("[0/2", "[00/2"), ("'C1'", "'C\\\\1'"), ("'p'", "'p(0/1)],['"), ("mappings([]).", "mappings([]).\n'EOU'.")])
def test_plain_phrases_are_those_of_the_parser(change):
    """What is read by replacements is what the parser reads, or is refused and left to it."""
    text = PHRASES.replace(*change)
    want, plain = AN.parse_block(SAID + text)["phrases"], AN.plain_phrases(text)
    try:
        assert plain is None or json.loads(plain) == want
    except json.JSONDecodeError:
        plain = None
    assert (plain is not None) == (change in (("", ""), ("'p'", "'p(0/1)],['")))


def test_blocks_beside_plain_ones_are_read_as_before(spark, tmp_path):
    odd = [PHRASES, PHRASES.replace("0/5", "0 / 5"), PHRASES.replace("[0/2", "[00/2"), PHRASES.replace("'x'", "x")]
    (tmp_path / "in").write_text("args('t',[]).\naas([]).\nneg_list([]).\n" + "".join(f"{SAID}{p}\n'EOU'.\n" for p in odd))
    rows = AN.read_annotated(spark, str(tmp_path / "in")).orderBy("utt_no").collect()
    assert [(r.doc_no, r.utt_no, r.text) for r in rows] == [(1, k, 'a "q"\nx') for k in (1, 2, 3, 4)]
    assert [r.asDict(True)["phrases"] for r in rows] == [AN.parse_block(SAID + p)["phrases"] for p in odd]


def test_report_lines_come_from_files_without_a_sort_of_rows(spark, tmp_path):
    """Only lines are sorted: no plan keeps whole utterances in memory or sorts them."""
    (tmp_path / "in").write_text(f"args('t',[]).\naas([]).\nneg_list([]).\n{SAID}{PHRASES}\n'EOU'.\n")
    plans = _plans(spark, lambda: tools.print_annotated(spark, str(tmp_path / "in"), str(tmp_path / "out"), report="candidate_text_dump"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["p||[a]|1.1", ""]
    assert not [p for p in plans if "InMemoryTableScan" in p]
