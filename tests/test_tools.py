"""Whole files of the tools, in order, and the reader of annotation terms."""

import json

import pytest
from pyspark.sql import functions as F

from termweave import tools
from termweave.operators import annotations as A
from termweave.sources.annotated import TermError, Terms, parse_block, parse_blocks, read_annotated, term_lines

TERMS = [
    "C0000001|ENG|P|L1|PF|S1|Y|A1||||SRC1|PT|1|Cancer, Lung|0|N||",
    "C0000001|ENG|S|L1|VO|S2|N|A2||||SRC1|SY|1|lung-cancer|0|N||",
    "C0000001|ENG|p|L2|PF|S3|N|A3||||SRC2|PT|2|Lung's Cancer|0|N||",
    "C0000002|ENG|s|L3|PF|S4|N|A4||||SRC1|PT|3|ABDOMEN|0|N||",
    "C0000002|ENG|S|L4|PF|S5|N|A5||||SRC1|PT|3|pain of chest in man|0|N||",
]
EV = "ev(-1000,'C1','Lung Cancer','Malignant tumour, it''s',[lung,cancer],[neop,dsyn],[[[1,2],[1,2],0]],yes,no,['SRC1','SRC2'],[0/11],0"
ANNOTATED = f"""args('tool -q',[infile-x]).
aas([]).
neg_list([]).
utterance('7001.ti.1',"lung cancer (a\\b) ""q"" in man",0/20,[]).
phrase('lung cancer',[mod([lexmatch([lung]),inputmatch(['Lung']),tag(noun),tokens([lung])]),head([inputmatch([cancer]),tokens([cancer])])],0/11,[]).
candidates(2,0,0,2,[{EV}),{EV},1)]).
mappings([map(-1000,[{EV})]),map(-900,[{EV})]),map(-800,[{EV})])]).
phrase('in man.',[prep([lexmatch([in]),inputmatch([in]),tokens([in])]),not_in_lex([inputmatch([man]),tokens([man])])],12/6,[]).
candidates(0,0,0,0,[]).
mappings([]).
'EOU'.
utterance('7001.ab.1',"more",21/4,[]).
phrase(more,[head([inputmatch([more]),tokens([more])])],21/4,[]).
candidates(0,0,0,0,[]).
mappings([]).
'EOU'.
args('tool -q',[]).
aas([]).
neg_list([]).
utterance('7002.ti.1',"last",0/4,[]).
phrase(last,[head([inputmatch([last]),tokens([last])])],0/4,[]).
candidates(0,0,0,0,[]).
mappings([]).
'EOU'.
'EOT'.
"""


def text(path):
    return [line for p in sorted(path.glob("part-*")) for line in p.read_text().splitlines()]


def test_filter_file(spark, tmp_path):
    (tmp_path / "in").write_text("\n".join(TERMS) + "\n")
    tools.filter_terms(spark, str(tmp_path / "in"), str(tmp_path / "out"), end_of_processing=True)
    assert text(tmp_path / "out") == EXPECTED


EXPECTED = [
    "y|" + TERMS[0],
    "y|" + TERMS[1],
    "y|" + TERMS[2].replace("|p|", "|P|"),
    "ntss|" + TERMS[3] + "|[case]|abdomen",
    "y|" + TERMS[4],
    "icn|1|[uninv,case]",
    "ibn|1|uninv",
    "ibn|1|case",
    "it|0|p",
    "it|1|s",
    "is|2|pref",
    "is|0|synt",
    "<<< EOT >>>",
]


def test_syntax_and_strict(spark, tmp_path):
    (tmp_path / "in").write_text("\n".join(TERMS) + "\n")
    tools.main(["filter", str(tmp_path / "in"), str(tmp_path / "syntax"), "--dump_syntax_only", "--one_file"])
    assert len(list((tmp_path / "syntax").glob("part-*"))) == 1
    assert text(tmp_path / "syntax")[-1] == '3|5|C0000002|SRC1|3|pain of chest in man|[["pain"],["of","chest"],["in","man"]]'
    tools.filter_terms(spark, str(tmp_path / "in"), str(tmp_path / "strict"), strict_filtering=True)
    got = text(tmp_path / "strict")
    assert f"nsynt|{TERMS[4]}|[]|pain of chest in man" in got and got[-1] == "is|1|synt"


def test_glean(spark, tmp_path):
    (tmp_path / "in").write_text("\n".join(TERMS[:4]) + "\n")
    (tmp_path / "pairs").write_text("lung|cancer\n")
    out = [str(tmp_path / n) for n in ("words", "strings", "concepts")]
    tools.glean_terms(spark, str(tmp_path / "in"), str(tmp_path / "pairs"), *out)
    assert text(tmp_path / "words") == ["1|1|abdomen|S4|C......."]
    assert text(tmp_path / "strings") == ["S1|lung cancer|Cancer, Lung", "S2|lung cancer|lung-cancer", "S3|lung cancer|Lung's Cancer", "S4|abdomen|ABDOMEN"]
    assert text(tmp_path / "concepts") == ["C.......|X", "C0000001|Cancer, Lung", "C0000002|ABDOMEN"]


def test_variants_and_lexicon(spark, tmp_path):
    (tmp_path / "terms").write_text("dog\n\ncat\n")
    (tmp_path / "lex").write_text("dog|noun\ndog|verb\n")
    (tmp_path / "edges").write_text("dog|noun|dogs|noun|i|1\ncat|noun|cats|noun|i|1\n")
    tools.variants(spark, str(tmp_path / "terms"), str(tmp_path / "lex"), str(tmp_path / "edges"), end_of_processing=True)
    assert text(tmp_path / "terms.out") == ["dog|noun|dog|noun|0||dog|[]", "dog|verb|dog|verb|0||dog|[]", "dog|noun|dogs|noun|1|i|dogs|[]", "cat|none|cat|none|0||cat|[]", "cat|none|cats|noun|1|i|cats|[]", "<<< EOT >>>"]
    (tmp_path / "rec").write_text("{base=b\nentry=E2\n\tcat=noun\n}\n{base=a\nentry=E1\n}\n")
    tools.lexicon(spark, str(tmp_path / "rec"), end_of_processing=True)
    assert text(tmp_path / "rec.out") == ['E2|{"base":"b","fields":{"base":["b"],"entry":["E2"],"cat":["noun"]}}', 'E1|{"base":"a","fields":{"base":["a"],"entry":["E1"]}}', "<<< EOT >>>"]


@pytest.fixture
def annotated(tmp_path):
    (tmp_path / "terms").write_text(ANNOTATED)
    return str(tmp_path / "terms")


def test_read_annotated(spark, annotated, tmp_path):
    u = read_annotated(spark, annotated).orderBy("doc_no", "utt_no").collect()
    assert [(r.doc_no, r.utt_no, r.doc_id, r.label, r.starts) for r in u] == [(1, 1, "7001", "7001.ti.1", True), (1, 2, "7001", "7001.ab.1", False), (2, 1, "7002", "7002.ti.1", True)]
    assert u[0].text == 'lung cancer (a\\b) "q" in man' and u[0].header.args == "[tool -q,[infile-x]]" and u[1].header is None
    p, q = u[0].phrases
    assert [e.negated for e in p.cands] == [0, 1] and p.cands[0].preferred_name == "Malignant tumour, it's" and p.cands[0].sources == ["SRC1", "SRC2"]
    assert [m.neg_score for m in p.mappings] == [-1000, -900, -800] and tuple(p["items"][0]) == ("mod", "noun", ["Lung"], ["lung"], ["lung"]) and (q.pos.start, q.pos.length) == (12, 6)
    # Written as terms and read again it is the same.
    frame = read_annotated(spark, annotated).withColumn("doc_id", F.col("doc_no"))
    lines = [r.value for r in term_lines(frame).orderBy("doc_id", "utt_no").collect()]
    (tmp_path / "again").write_text("\n".join(lines) + "\n")
    again = read_annotated(spark, str(tmp_path / "again")).orderBy("doc_no", "utt_no").collect()
    assert [(r.label, r.text, r.phrases) for r in again] == [(r.label, r.text, r.phrases) for r in u]


@pytest.mark.parametrize(
    ("block", "error"),
    [
        ("aas([]).", "expected utterance/4"),
        ("args(a,b).\naas([]).\nutterance(a,\"b\",0/1,[]).", "expected neg_list/1"),
        ("utterance('a.1',\"b\",0/1,[]).\nphrase(x,[],0/1,[]).\nmappings([]).", "expected candidates/5"),
        ("utterance('a.1',\"b\",0/1,[]).\nphrase(x,[],0/1,[]).\ncandidates(0,0,0,0,[]).", "expected mappings/1, found the end of input"),
        ("utterance('a.1',\"b\",0/1,[]).", "has no phrases"),
        ("utterance('a.1',\"b\",0/1,[", "input ends within a term"),
        ("utterance('a.1',\"b\",0/1,[]]).", "expected , or \\)"),
        ("utterance('a.1',\"b\",0/1,[])", "input ends within a term"),
        ("utterance('a.1,\"b", "not a term"),
        ("utterance('a.1',\"b\",0/1,[]).\nphrase(x,[],0/1,[]).\ncandidates(1,0,0,1,[ev(1)]).\nmappings([]).", "expected ev/12"),
    ],
)
def test_malformed_terms(block, error):
    with pytest.raises(TermError, match=error):
        parse_block(block)


def test_malformed_file_says_where(spark, tmp_path):
    (tmp_path / "bad").write_text(ANNOTATED.replace("candidates(0,0,0,0,[]).\n", "", 1))
    with pytest.raises(Exception, match="block .*expected candidates/5"):
        read_annotated(spark, str(tmp_path / "bad")).collect()


def test_terms():
    t = Terms("a('it''s',\"x\"\"y\",[1,-2.5|b],c/d:e,[]). 'A b'. ")
    assert t.next() == ("a", ["it's", 'x"y', [1, -2.5, "b"], (":", [("/", ["c", "d"]), "e"]), []])
    assert t.next() == "A b" and t.next() is None


def report(spark, annotated, tmp_path, **how):
    tools.print_annotated(spark, annotated, str(tmp_path / "report"), **how)
    return text(tmp_path / "report")


def test_reports(spark, annotated, tmp_path):
    get = lambda **how: [line for line in report(spark, annotated, tmp_path, **how) if line]
    whole = lambda **how: report(spark, annotated, tmp_path, **how)
    # An empty line follows each utterance.
    assert whole(report="phrase_dump") == ["lung cancer", "in man.", "", "more", "", "last", ""]
    assert whole(report="candidate_count_dump") == ["2", "0", "", "0", "", "0", ""] and whole(report="mapping_count_dump") == ["3", "0", "", "0", "", "0", ""]
    assert whole(report="not_in_lex_dump") == ["man|man|lung cancer (a\\b) \"q\" in man|7001.ti.1|", "", "", ""]
    assert whole(candidates=False, mappings=False, syntax=True)[:6] == ['Processing 7001.ti.1: lung cancer (a\\b) "q" in man', "", 'Phrase: "lung cancer"', "", "msu", "[mod([lexmatch(['lung']),inputmatch(['Lung']),tag(noun),tokens(['lung'])]),head([inputmatch(['cancer']),tokens(['cancer'])])]"]
    assert whole(candidates=False, mappings=False, simple_syntax=False) == ['Processing 7001.ti.1: lung cancer (a\\b) "q" in man', "", "Processing 7001.ab.1: more", "", "Processing 7002.ti.1: last", ""]
    said = 'lung cancer (a\\b) "q" in man'
    assert get(report="documents") == ["PMID 1: 7001", "PMID 2: 7002"]
    assert get(report="label_text_field_dump") == [f"7001.ti.1|{said}", "7001.ab.1|more", "7002.ti.1|last"]
    concept = "Lung Cancer|Malignant tumour, it's|[neop,dsyn]|[0/11]"
    assert get(report="mapping_summary_dump") == [f"7001.ti.1|UTTERANCE|{said}", "7001.ti.1|PHRASE|lung cancer", f"7001.ti.1|1|3|1000|C1|{concept}", f"7001.ti.1|2|3|900|C1|{concept}", f"7001.ti.1|3|3|800|C1|{concept}", "7001.ti.1|PHRASE|in man.", "7001.ab.1|UTTERANCE|more", "7001.ab.1|PHRASE|more", "7002.ti.1|UTTERANCE|last", "7002.ti.1|PHRASE|last"]
    assert get(report="not_in_lex_dump") == [f"man|man|{said}|7001.ti.1|"]
    assert get(report="inputmatch_lexmatch_dump") == []
    assert get(report="candidate_text_dump") == ["Malignant tumour, it's|Lung Cancer|[lung,cancer]|7001.ti.1"] * 2
    assert get(report="prepositional_phrase_dump") == ["2|[in]|[lung cancer,in man.]"]
    assert get(report="syntactic_pattern_dump", with_text=True) == ["mod|head:lung cancer", "prep|not_in_lex:in man.", "head:more", "head:last"]
    line = "  1000 C1:Lung Cancer (Malignant tumour, it's) [neop,dsyn]"
    (tmp_path / "stop").write_text("more\n")
    assert get(show_cuis=True, semantic_types=True, truncate_output=True, stop_phrase_file=str(tmp_path / "stop")) == [
        f"Processing 7001.ti.1: {said}", 'Phrase: "lung cancer"', "Meta Candidates (Total=2; Excluded=0; Pruned=0; Remaining=2):", line, line, "Meta Mapping (1000):", line, "Meta Mapping (900):", line, "     [1 mappings were not printed]",
        'Phrase: "in man."', "Meta Mapping: <none>", "Processing 7001.ab.1: more", "Processing 7002.ti.1: last", 'Phrase: "last"', "Meta Mapping: <none>",
    ]
    assert get(show_preferred_names_only=True, candidates=False, non_null_only=True)[2:4] == ["Meta Mapping (1000):", "  1000 Malignant tumour, it's"]
    assert whole(report="organize_semantic_types", first_mappings_only=True)[:6] == ["", "<unknown> (neop):", "  Lung Cancer (Malignant tumour, it's)", "", "<unknown> (dsyn):", "  Lung Cancer (Malignant tumour, it's)"]
    xml = get(format="xml")
    assert xml[:2] == A.XML_HEADER.split("\n") and xml[-1] == A.XML_FOOTER and len(xml) == 6 and xml[2].startswith("<utterance><label>7001.ti.1</label>")
    assert len(get(format="json")) == 2
    with pytest.raises(ValueError, match="no report"):
        get(report="other")


SAMPLE = {
    **{r: {} for r in tools.REPORTS}, "default": {}, "unique_mapping_text_dump": {}, "prepositional_phrase_dump": {}, "organize_semantic_types": {}, "non_monotonic_mapping_dump": {},
    "phrase_specificity_dump": {"code_file": "codes"}, "filter_for_meta": {"concept_file": "names"}, "filter_for_meta_with_sy_id": {"concept_file": "names"},
}


@pytest.mark.parametrize("name", sorted(SAMPLE))
def test_reports_over_two_files(spark, annotated, tmp_path, name):
    (tmp_path / "codes").write_text("C1|C04.588\nC1|C04.588.33\n")
    (tmp_path / "names").write_text("C9|Lung cancers\nC1|a name | with a bar\n")
    how = {"report": name, **{k: str(tmp_path / v) for k, v in SAMPLE[name].items()}}
    one = report(spark, annotated, tmp_path, **how)
    (tmp_path / "more").mkdir()
    for f in ("a", "b"):
        (tmp_path / "more" / f).write_text(ANNOTATED)
    assert one and report(spark, str(tmp_path / "more"), tmp_path, **how) == one * 2
    assert report(spark, f"{annotated},{annotated}", tmp_path, **how) == one


def test_documents_of_several_files(spark, annotated, tmp_path):
    headless = "utterance('9.ti.1',\"x\",0/1,[]).\nphrase(x,[head([tokens([x])])],0/1,[]).\ncandidates(0,0,0,0,[]).\nmappings([]).\n'EOU'.\n"
    (tmp_path / "in").mkdir()
    for f, t in (("a", ANNOTATED), ("b", headless + ANNOTATED), ("c", "args(x,[]).\naas([]).\nneg_list([]).\n'EOT'.\n"), ("d", ANNOTATED)):
        (tmp_path / "in" / f).write_text(t)
    folder = str(tmp_path / "in")
    assert report(spark, folder, tmp_path, report="documents") == ["PMID 1: 7001", "PMID 2: 7002", "PMID 3: 9", "PMID 4: 7001", "PMID 5: 7002", "PMID 7: 7001", "PMID 8: 7002"]
    values = report(spark, folder, tmp_path, format="json")
    assert [json.loads(v)["doc_id"] for v in values] == [1, 2, 3, 4, 5, 7, 8] and [len(json.loads(v)["utterances"]) for v in values] == [2, 1, 1, 2, 1, 2, 1]
    xml = report(spark, folder, tmp_path, format="xml")
    assert sum(x.startswith("<utterance>") for x in xml) == 10
    union = report(spark, folder, tmp_path, report="organize_semantic_types", whole_input_union=True)
    assert union.count("  Lung Cancer (Malignant tumour, it's)") == 3 * 6 + 10 * 2  # each utterance's own, and two types in every union
    own = report(spark, folder, tmp_path, report="organize_semantic_types")
    assert own.count("  Lung Cancer (Malignant tumour, it's)") == 3 * 6 + 6 * 2


def test_pieces_of_a_long_file(spark, tmp_path):
    with_many = ANNOTATED.replace("'EOT'.\n", "") * 40
    (tmp_path / "long").write_text(with_many)
    want = [(r.doc_no, r.utt_no, r.label) for r in read_annotated(spark, str(tmp_path / "long")).orderBy("doc_no", "utt_no").collect()]
    assert want == [x for d in range(40) for x in ((2 * d + 1, 1, "7001.ti.1"), (2 * d + 1, 2, "7001.ab.1"), (2 * d + 2, 1, "7002.ti.1"))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        frame = read_annotated(spark, str(tmp_path / "long"))
        assert frame.rdd.getNumPartitions() > 8
        assert [(r.doc_no, r.utt_no, r.label) for r in frame.orderBy("doc_no", "utt_no").collect()] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    blocks = spark.createDataFrame([(p, i, b) for p in ("x", "y") for i, b in enumerate(with_many.split("\n'EOU'.\n")[:-1])], "path string, seq long, value string")
    for n in (1, 7):
        got = parse_blocks(blocks, n)
        assert sorted((r.doc_no, r.utt_no, r.label) for r in got.where("path = 'y'").collect()) == want
        assert [r.doc_ord for r in got.select("doc_ord").distinct().orderBy("doc_ord").collect()] == list(range(1, 161))
        assert parse_blocks(blocks, n)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_types_and_index(spark, tmp_path):
    vec = lambda n: " ".join(str(n if i == 3 else -n if i == 5 else 0) for i in range(129))
    (tmp_path / "vectors").write_text(f"PAIN {vec(9)}\nCHEST {vec(20000)}\nPAIN {vec(50000)}\n")
    tools.index_vectors(spark, str(tmp_path / "vectors"), str(tmp_path / "index"))
    assert tools.get_vector(spark, str(tmp_path / "index"), "PAIN")[3] == 50000 and tools.get_vector(spark, str(tmp_path / "index"), "X") is None
    (tmp_path / "allow").write_text("PAIN CHEST THE\n")
    (tmp_path / "no").write_text("THE\n")
    (tmp_path / "cfg").write_text(f"DISAMB_SERVER_STI_INDEXPATH={tmp_path}/index\nDISAMB_SERVER_STI_RESTRICTWORDSFILE={tmp_path}/allow\nDISAMB_SERVER_STI_STOPWORDSFILE={tmp_path}/no\n")
    (tmp_path / "doc").write_text("The pain,\npain chest.\n")
    tools.top_types(spark, str(tmp_path / "doc"), str(tmp_path / "top"), str(tmp_path / "cfg"), n=2)
    assert text(tmp_path / "top") == ["aggp|4.0000", "vtbt|0.0000"]


def test_arguments():
    how = tools.parser().parse_args(["print", "in", "--threshold", "900", "--null_only", "--no-mappings"])
    assert (how.infile, how.outfile, how.threshold, how.null_only, how.mappings) == ("in", None, 900, True, False)
