"""Functions in SQL, saved tables, counters of one pass, streams."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from termweave import sqlfunctions, tools
from termweave.functions import text as T
from termweave.operators import annotations as A
from termweave.operators import saved
from termweave.operators import termfilter as TF
from termweave.operators.runs import with_runs
from termweave.plans import views as V
from termweave.sources import readers as R
from termweave.streaming import running

SF = "/root/testdata/sf0.001"
STRINGS = ["Cancer, Lung", "lung-cancer, NOS", "[X] [EDTA]\tBoss's dogs' x", "a, b of c", "ABDOMEN", "", None, "x NOS", "É, f", "C1|ENG|p|L1|", "|p||p|", "a - b-c", "  white \t space\n", "of", "{a} [b]"]


def test_sql_functions_equal_the_columns(spark):
    sqlfunctions.register(spark)
    sqlfunctions.register(spark)
    spark.createDataFrame([(s,) for s in STRINGS], "s string").createOrReplaceTempView("strings")
    c = F.col("s")
    pairs = {
        "tw_parse_record": T.parse_record(c), "tw_strip_nos": T.strip_nos(c), "tw_uninvert": T.uninvert(c), "tw_strip_left_parentheticals": T.strip_left_parentheticals(c), "tw_strip_hyphens": T.strip_hyphens(c), "tw_strip_possessives": T.strip_possessives(c),
        "tw_normal": T.normalize(c)["norm"], "tw_normal_types": T.normalize(c)["types"], "tw_words": T.words(c), "tw_delimited_terms": T.delimited_terms(c), "tw_clean": T.clean(c), "tw_is_lowercase": T.is_lowercase(c), "tw_ascii_upper": T.ascii_upper(c), "tw_restore_status": T.restore_status(c),
    }
    for name, column in pairs.items():
        got = spark.sql(f"SELECT s, {name}(s) AS a FROM strings")
        want = spark.table("strings").select("s", column.alias("b"))
        assert {r.s: r.a for r in got.collect()} == {r.s: r.b for r in want.collect()}, name
    assert "tw_" not in spark.sql("SELECT tw_normal(s) AS a FROM strings")._jdf.queryExecution().executedPlan().toString()  # inlined
    row = spark.sql("SELECT tw_print_cui('P', 'PF', 'C1') a, tw_print_cui('S', 'PF', 'C1') b, tw_is_preposition('Of') c, tw_specific_types(array('qlco', 'dsyn')) d, tw_code_depth('C04.588') e, tw_code_depth(NULL) f").first()
    assert tuple(row) == ("C.......", "C1", True, ["dsyn"], 2, 0)


def test_table_functions(spark):
    sqlfunctions.register(spark)
    u = V.utterances(spark, SF)
    flat = A.flat_sequence(u)
    flat.createOrReplaceTempView("flat")
    got = spark.sql("SELECT * FROM tw_utterances(TABLE(SELECT doc_id, utt_no, seq, kind, value FROM flat) PARTITION BY (doc_id, utt_no) ORDER BY seq)")
    x = got.select("doc_id", "utt_no", "label", "text", F.from_json("phrases", f"array<{A.PHRASE}>").alias("phrases"))
    assert sorted(map(str, x.collect())) == sorted(map(str, A.from_sequence(flat).collect()))
    bad = flat.where("NOT (kind = 'candidates' AND seq = 2)")
    bad.createOrReplaceTempView("bad")
    with pytest.raises(Exception, match="expected candidates, found mappings"):
        spark.sql("SELECT * FROM tw_utterances(TABLE(SELECT doc_id, utt_no, seq, kind, value FROM bad) PARTITION BY (doc_id, utt_no) ORDER BY seq)").collect()


def test_saved_tables(spark, tmp_path):
    built = []

    def build(lines):
        built.append(1)
        return R.parse_pairs(lines).distinct()

    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    folder, names = str(tmp_path / "pairs"), lambda: sorted(p.name for p in (tmp_path / "pairs").iterdir())
    rows = lambda df: sorted(map(tuple, df.collect()))
    first = saved.reuse(lines("a|b", "c|d", "a|b"), folder, build)
    assert rows(first) == [("a", "b"), ("c", "d")] and len(built) == 1
    (version,) = names()
    again = saved.reuse(lines("c|d", "a|b", "a|b").repartition(3), folder, build)
    assert rows(again) == rows(first) and len(built) == 1 and names() == [version]
    other = saved.reuse(lines("a|b", "c|d"), folder, build)  # a repeated row less
    assert len(built) == 2 and rows(other) == rows(first) and len(names()) == 2
    saved.reuse(lines("a|b", "c|d"), folder, build, "another parameter")
    assert len(built) == 3 and len(names()) == 3
    (tmp_path / "pairs" / version / "_SUCCESS").unlink()  # a version that is not whole is not read
    with pytest.raises(RuntimeError):
        saved.reuse(lines("a|b", "c|d", "a|b"), folder, build)
    assert len(saved.forget(spark, folder)) == 3 and names() == []
    with pytest.raises(Exception, match="not a pair"):
        saved.reuse(lines("a|b|c"), folder, build)
    assert all(n.startswith("_building") for n in names())
    saved.forget(spark, folder)
    assert names() == [] and saved.forget(spark, str(tmp_path / "none")) == []
    assert rows(saved.reuse(lines(), folder, build)) == []


def test_two_writers_at_once(spark, tmp_path):
    source, folder, together, out = spark.range(100), str(tmp_path / "t"), threading.Barrier(2), []

    def build(df):
        together.wait(60)
        return df

    def run():
        out.append(sorted(r.id for r in saved.reuse(source, folder, build).collect()))

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert out == [list(range(100))] * 2 and len(list((tmp_path / "t").iterdir())) == 1


def test_counters_of_one_pass(spark, tmp_path, capsys):
    terms = V.terms(spark, SF)
    terms.orderBy("line_no").select("line").coalesce(1).write.text(str(tmp_path / "terms"))
    tools.filter_terms(spark, str(tmp_path / "terms"), str(tmp_path / "out"), end_of_processing=True)
    lines = [line for p in sorted((tmp_path / "out").glob("part-*")) for line in p.read_text().splitlines()]
    want = TF.filter_terms(TF.prepare(R.read_terms(spark, str(tmp_path / "terms"))))
    counters = [r.value for r in TF.counter_lines(want).orderBy("ord").collect()]
    kept = [r.value for r in TF.ordered_tagged_lines(want).orderBy("ord").collect()]
    assert lines == [*kept, *counters, tools.END_MARK]
    assert f"{len(kept)} terms" in capsys.readouterr().out
    tools.filter_terms(spark, str(tmp_path / "terms"), str(tmp_path / "one"), one_file=True, strict_filtering=True)
    (one,) = (tmp_path / "one").glob("part-*")
    strict = TF.filter_terms(TF.prepare(R.read_terms(spark, str(tmp_path / "terms"))), TF.is_simple(TF.chunks(T.words(F.col("nmstr")))))
    assert one.read_text().splitlines() == [r.value for x in (TF.ordered_tagged_lines(strict), TF.counter_lines(strict)) for r in x.orderBy("ord").collect()]


def batches(spark, tmp_path, rows, schema, parts, run):
    """Files that come one after the other; the stream is stopped after each and begun anew."""
    folder = tmp_path / "in"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        run(spark.readStream.schema(schema).parquet(str(folder)))
        time.sleep(0.01)


def test_runs_on_a_stream(spark, tmp_path):
    keys = "aabbbbaacccca" * 3
    rows = [("s", i, k) for i, k in enumerate(keys)] + [("t", i, None if k == "b" else k) for i, k in enumerate(keys)]
    schema, out = "source string, line_no long, cui string", str(tmp_path / "out")
    parts = [[r for r in rows if lo <= r[1] < hi] for lo, hi in ((0, 3), (3, 5), (5, 20), (20, 39))]
    batches(spark, tmp_path, rows, schema, parts, lambda s: running.to_folder(running.runs(s), out, str(tmp_path / "ck")))
    got = sorted((r.source, r.line_no, r.run_id) for r in spark.read.parquet(out).collect())
    frame = spark.createDataFrame(rows, schema)
    want = sorted((w, r.line_no, r.run_id) for w in "st" for r in with_runs(frame.where(F.col("source") == w), "cui", "line_no").collect())
    assert got == want
    late = spark.createDataFrame([("s", 1, "a")], schema)
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="1 comes after 38"):
        running.to_folder(running.runs(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), out, str(tmp_path / "ck"))


def test_running_union_on_a_stream(spark, tmp_path):
    u = V.utterances(spark, SF)
    items = A.semtype_rows(u).groupBy("doc_id", "utt_no").agg(F.collect_set(F.concat_ws("|", "semtype", "term", "concept")).alias("items"))
    rows = [tuple(r) for r in u.select("doc_id", "utt_no").distinct().join(items, ["doc_id", "utt_no"], "left").collect()]
    turns = sorted({r[1] for r in rows})
    schema, out = "doc_id long, utt_no long, items array<string>", str(tmp_path / "out")
    parts = [[r for r in rows if r[1] in group] for group in (turns[:1], turns[1:3], turns[3:])]
    batches(spark, tmp_path, rows, schema, [p for p in parts if p], lambda s: running.to_folder(running.running_union(s), out, str(tmp_path / "ck")))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, A.running_union(u).collect()))
