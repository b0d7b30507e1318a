import pytest
from pyspark.sql import functions as F

from termweave.functions import text as T
from termweave.operators import facts as FA
from termweave.operators import termfilter as TF
from termweave.operators.runs import with_runs
from termweave.sources import readers as R

LINES = [
    "C0000001|ENG|P|L1|PF|S1|Y|A1||||SRC1|PT|1|Cancer, Lung|0|N||",
    "C0000001|ENG|S|L1|VO|S2|N|A2||||SRC1|SY|1|lung-cancer|0|N||",
    "C0000001|ENG|p|L2|PF|S3|N|A3||||SRC2|PT|2|Lung's Cancer|0|N||",
    "C0000001|ENG|S|L1|VO|S2|N|A2||||SRC1|SY|1|lung-cancer|0|N||",
    "",
    "C0000002|ENG|s|L3|PF|S4|N|A4||||SRC1|PT|3|ABDOMEN|0|N||",
    "C0000001|ENG|S|L9|VO|S9|N|A9||||SRC1|SY|1|lung cancer|0|N||",
]


def lines(spark, tmp_path, text):
    (tmp_path / "in.txt").write_text(text)
    return R.numbered_lines(spark, str(tmp_path / "in.txt"))


def test_filter(spark, tmp_path):
    terms = R.parse_terms(lines(spark, tmp_path, "\n".join(LINES)))
    out = TF.filter_terms(TF.prepare(terms))
    got = sorted(r.value for r in TF.tagged_lines(out).collect())
    assert len(got) == 5  # one of two equal lines is gone
    assert "y|" + LINES[0] in got  # restored: the duplicate with the greater string id survived
    assert "y|" + LINES[2].replace("|p|", "|P|") in got
    assert [g for g in got if g.startswith("ntss|")] == [f"ntss|{LINES[5]}|[case]|abdomen"]
    assert "y|" + LINES[6] in got  # the concept comes back later as a new run
    assert TF.status_counts(out).first().asDict() == {"p": 0, "s": 1, "pref": 2, "synt": 0}


def test_wrong_field_count(spark, tmp_path):
    terms = lines(spark, tmp_path, "a|b|c\n")
    assert R.parse_terms(terms, strict=False).count() == 0
    with pytest.raises(Exception, match="not 18 fields"):
        R.parse_terms(terms).collect()


def test_runs_over_blocks(spark):
    keys = "aabbbbaacccca"
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n long, k string")
    want = [0, 0, 2, 2, 2, 2, 6, 6, 8, 8, 8, 8, 12]
    for block in (1, 2, 3, 100):
        assert [r.run_id for r in with_runs(df, "k", "n", block).orderBy("n").collect()] == want
    assert with_runs(df.limit(0), "k", "n").count() == 0


def test_facts(spark):
    f = spark.createDataFrame([(1, "k", "p", 1), (2, "k", "p", 1), (3, "k", "q", 2), (4, None, "p", 1)], "seq int, key string, property string, value int")
    assert sorted(r.seq for r in FA.erase_first(f, f.where("seq in (2, 4)")).collect()) == [2, 3]
    assert sorted(r.seq for r in FA.erase_all(f, f.where("seq = 1")).collect()) == [3, 4]


def test_lexicon(spark, tmp_path):
    (tmp_path / "lex").write_text("{base=curly\nentry=E7000001\n\tcat=adj\n\tvariants=inv\n\tnote=a {brace} within} a field\n}\n{base=x\nentry=E7000002\n}\n")
    got = {r.eui: r for r in R.parse_lexicon(R.read_lexicon(spark, str(tmp_path / "lex"))).collect()}
    assert got["E7000001"].base == "curly"
    assert got["E7000001"].fields["note"] == ["a {brace} within} a field"]
    assert set(got) == {"E7000001", "E7000002"}
    (tmp_path / "bad").write_text("{base=nothing\n}\n")
    with pytest.raises(Exception, match="no lexical record: nothing"):
        R.parse_lexicon(R.read_lexicon(spark, str(tmp_path / "bad"))).collect()


def test_vectors(spark, tmp_path):
    x = lines(spark, tmp_path, "B 1 2\nAB 3 -4\n\nB 5 6\n")
    v = R.load_vectors(x)
    assert {r.term: r.vec for r in v.collect()} == {"B": [5, 6], "AB": [3, -4]}
    R.write_vectors(v, str(tmp_path / "index"))
    assert R.read_vectors(spark, str(tmp_path / "index"), "AB").first().vec == [3, -4]
    assert {r.term_len: (r.terms, r.lines) for r in R.index_statistics(x).collect()} == {1: (1, 2), 2: (1, 1)}


def test_readers(spark, tmp_path):
    (tmp_path / "p").write_text("  one\ntwo\n\nthree\n\nunended")
    assert [r.text for r in R.read_paragraphs(spark, str(tmp_path / "p")).collect()] == ["one two", "three"]
    (tmp_path / "w").write_text("alpha 12 beta // gamma\n\"quoted\" delta\n")
    assert {r.word for r in R.word_set(spark.read.text(str(tmp_path / "w"))).collect()} == {"alpha", "beta", "delta"}
    (tmp_path / "pairs").write_text("human|protein\n2|acid\n")
    assert R.read_pairs(spark, str(tmp_path / "pairs")).count() == 2
    (tmp_path / "bad").write_text("human|protein|x\n")
    with pytest.raises(Exception, match="not a pair"):
        R.read_pairs(spark, str(tmp_path / "bad")).collect()
    (tmp_path / "stop").write_text("a phrase\nanother\na phrase\n")
    assert {r.phrase for r in R.read_stop_phrases(spark, str(tmp_path / "stop")).collect()} == {"a phrase", "another"}
    (tmp_path / "list").write_text("one\n\ntwo words\n")
    assert [r.term for r in R.read_term_list(spark, str(tmp_path / "list")).orderBy("line_no").collect()] == ["one", "two words"]
    (tmp_path / "doc").write_text("first line\nsecond\n\nlast\n")
    assert R.read_document(spark, str(tmp_path / "doc")).first().text == "first line second  last "
    (tmp_path / "cfg").write_text("# comment\nDISAMB_SERVER_STI_INDEXPATH = /x/y\nother: z\n")
    keys = R.read_configuration(spark, str(tmp_path / "cfg"))
    assert keys["DISAMB_SERVER_STI_INDEXPATH"] == "/x/y" and keys["DISAMB_SERVER_STI_STOPWORDSFILE"] == "stopwords.txt" and keys["other"] == "z"


def test_no_extra_blank_is_left(spark):
    terms = ["a  b", "x 's y", "boss' - dogs' x", "[X]  a", "a -  - b, NOS"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "s string").select(T.normalize(F.col("s"))["norm"]).collect()]
    assert got[0] == "a b" and not any("  " in g for g in got)


def test_imports(spark):
    text = ":- use_module(area(one(x)),[\n    a/1,  % first\n    b_c/2\n    ]).\n:- use_module(lib(two), [a/1, d/0]).\n:- use_module(library(lists),[e/1]).\nf/3,\n:- use_module(lib(two),[]).\n"
    df = spark.createDataFrame([("p", i, v) for i, v in enumerate(text.split("\n"))], "path string, line_no int, value string")
    assert sorted(map(tuple, R.import_list(df).collect())) == [("a", 1, "lib(two)"), ("d", 0, "lib(two)")]


def test_chunks(spark):
    df = spark.createDataFrame([(["pain"],), (["pain", "in", "chest"],), (["pain", "in", "chest", "of", "man"],), (["pain", "in", "chest", "in", "man"],), ([],)], "w array<string>")
    assert [r.s for r in df.select(TF.is_simple(TF.chunks(F.col("w"))).alias("s")).collect()] == [True, True, True, False, False]
