"""The data source of annotated files: ranges of bytes, headers only, writing and reading again, jobs that fail."""

import io

import pytest
from pyspark.sql import functions as F
from test_tools import ANNOTATED

from termweave.sources import term_source as TS
from termweave.sources.annotated import HEADER, read_annotated, term_lines


def test_every_block_belongs_to_one_range():
    data = ("first\n'EOU'.\n" + "second é\nline\n'EOU'.\n" + "x\n'EOU'.\nlast, unended\n").encode()
    want = list(TS.blocks(io.BytesIO(data), 0, len(data)))
    assert [t for _, t in want] == ["first", "second é\nline", "x", "last, unended\n"]
    for size in range(1, len(data) + 2):
        got = [b for i in range(0, len(data), size) for b in TS.blocks(io.BytesIO(data), i, min(len(data), i + size))]
        assert got == want, size


def test_round_trip(spark, tmp_path):
    TS.register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(3):
        (folder / f"f{k}").write_text(ANNOTATED.replace("'EOT'.\n", "").replace("700", f"{k}00") * 5)
    (folder / "_hidden").write_text("not terms")
    whole = read_annotated(spark, str(folder)).select("label", "text", "phrases", "starts")
    key = lambda df: sorted(str(r) for r in df.collect())
    for size in (1 << 20, 997):
        u = spark.read.format("annotated_terms").option("splitBytes", size).load(str(folder))
        assert u.rdd.getNumPartitions() >= (3 if size > 9999 else 15)
        assert key(u.select("label", "text", "phrases", "starts")) == key(whole)
        assert [r.label for r in u.orderBy("path", "place").collect()][:3] == ["0001.ti.1", "0001.ab.1", "0002.ti.1"]
    heads = spark.read.format("annotated_terms").schema(f"label string, header {HEADER}").load(str(folder))
    assert heads.columns == ["label", "header"] and heads.where("header IS NOT NULL").count() == 30 and heads.count() == 45
    numbered = read_annotated(spark, str(folder)).withColumn("doc_id", F.col("doc_ord"))
    out = str(tmp_path / "out")
    for _ in range(2):
        TS.documents(term_lines(numbered), 4).write.format("annotated_terms").mode("overwrite").save(out)
        assert len(TS.files(out)) > 1 and (tmp_path / "out" / "_SUCCESS").exists()
        again = spark.read.format("annotated_terms").load(out)
        assert key(again.select("label", "text", "phrases", "starts")) == key(whole)
        assert [r.label for r in read_annotated(spark, out).orderBy("doc_ord", "utt_no").collect()] == [r.label for r in numbered.orderBy("doc_ord", "utt_no").collect()]
    assert not list((tmp_path / "out").glob("_job*"))
    TS.documents(term_lines(numbered), 4).write.format("annotated_terms").mode("append").save(out)
    assert spark.read.format("annotated_terms").load(out).count() == 90


def test_failed_jobs_leave_nothing(spark, tmp_path):
    TS.register(spark)
    out = str(tmp_path / "out")
    good = spark.createDataFrame([("a(b).",)], "value string")
    good.write.format("annotated_terms").mode("overwrite").save(out)
    before = TS.files(out)
    bad = spark.range(100, numPartitions=4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.lit("x.")).cast("string").alias("value"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("annotated_terms").mode("overwrite").save(out)
    assert TS.files(out) == before  # and readers see no more than those
    assert [r.value for r in spark.read.text(out).collect()] == ["a(b)."]
    with pytest.raises(Exception, match="column value"):
        spark.range(1).write.format("annotated_terms").mode("append").save(out)
    (tmp_path / "empty").mkdir()
    assert spark.read.format("annotated_terms").load(str(tmp_path / "empty")).count() == 0
    (tmp_path / "bad").write_text(ANNOTATED.replace("candidates(0,0,0,0,[]).\n", "", 1))
    with pytest.raises(Exception, match="at byte 0: expected candidates/5"):
        spark.read.format("annotated_terms").load(str(tmp_path / "bad")).collect()
