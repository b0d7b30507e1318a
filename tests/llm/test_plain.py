"""Operators and stages against plain versions: fingerprints, token files with their indexes, packing, and the pipeline's stages."""

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pytest
import xxhash
from test_mixing import plain
from test_near_copies import brute

import corpus_pipeline
from termweave.llm import packing, pu_quality, simhash, token_orc, toxicity
from termweave.llm.tokens import tokenizer_path


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ")
    w = [x for x in w if x]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    texts = ["one", "ONE two", "a b c", "a b c a b c a b c", "É é x\x0by z\x1fq", "", None, " \t", "w " * 3000 + "end", "ΑΒ ab AB"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, `fp` string")
    assert {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(docs).collect()} == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_token_files_are_the_librarys(spark, tmp_path):
    lib = library()
    texts = ["It's 12,5 — naïve <|endoftext|> x", None, "", "日本語 and ASCII", "word " * 5000, "  two\n\nlines\t", "a" * 3000]
    rows = [*((i, t, 1) for i, t in enumerate(texts)), (None, "no id", 1), (2, "again", 1)]
    path = str(tmp_path / "t")
    token_orc.write_tokens(spark.createDataFrame(rows, "doc_id long, text string, `part` int"), path)
    ids = lambda t: [*lib.encode(t or "", add_special_tokens=False).ids, 1]
    got = token_orc.digest(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t, _ in rows)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


def rows_read(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_indexes_and_bloom_filters_skip_rows(spark, tmp_path):
    path, n = str(tmp_path / "t"), 40_000
    token_orc.write_tokens(spark.range(n).selectExpr("2 * id AS doc_id", "cast(id AS string) AS text"), path)
    assert token_orc.read_tokens(spark, path).count() == n
    assert token_orc.read_tokens(spark, path, 5000, 5000).count() == 1
    assert rows_read(token_orc.read_tokens(spark, path, 5000, 5100)) <= 4 * 2000  # row indexes
    # Odd ids lie within every range of ids and are in none: only Bloom filters tell.
    assert sum(rows_read(token_orc.read_tokens(spark, path, i, i)) > 0 for i in range(10_001, 10_041, 2)) <= 3


def best_fit_decreasing(lengths, cap):
    gaps = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        gap = gaps.pop(at) if at < len(gaps) else cap
        insort(gaps, gap - n)
    return len(gaps)


def test_packing_against_a_plain_packer_and_the_lower_bound():
    rng = np.random.default_rng(6)
    for k in range(12):
        lengths = np.clip((rng.lognormal(5 + k % 4, 1.2, 3000)).astype(int), 1, 4096)
        bins = set()
        for n, a, b, s, _, each in packing.plan(Counter(lengths.tolist())):
            bins |= {s + i // each for i in range(b - a)}
        least = max(-(-int(lengths.sum()) // 4096), int((lengths > 2048).sum()))
        assert least <= len(bins) <= 1.01 * best_fit_decreasing(lengths.tolist(), 4096) + 1


WORDS = [f"term{i}" for i in range(400)]


def made():
    """Documents of three sources: clean ones, near copies of them, toxic ones, junk; with nulls, empty texts, repeated rows and ids."""
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(160):
        kind = "toxic" if i % 8 == 3 else "junk" if i % 8 == 5 else "copy" if i % 8 == 6 else "clean"
        w = rng.choice(WORDS, 60).tolist()
        if kind == "copy":
            w = next(r[1] for r in rows if r[0] == i - 6).replace(".", "").split()
            w[7] = "changed"
        if kind == "toxic":
            w[10:40:5] = ["vilest", "odious", "vilest", "wretch", "wretch", "odious"]
        text = " ".join(w) + "." if kind != "junk" else "$$ 11 !! " * 30
        rows.append((i, text, "en", ["a", "b", None][i % 3], "x", 1))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    rows += [rows[0], (8, "other text " + rows[8][1], "en", "a", "x", 1), (None, rows[1][1], "en", "a", "x", 1), (900, None, "en", "a", "x", 1), (901, "", "en", "b", "x", 1)]
    return rows, labels


SCHEMA = "doc_id long, text string, lang string, source string, `key` string, `src` int"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows, labels = made()
    sf = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def count(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_against_plain_versions(spark, table):
    docs, labels = spark.read.parquet(f"{table}/documents.parquet"), spark.read.parquet(f"{table}/labels.parquet")
    rows, _ = made()
    toxic = {r.doc_id for r in toxicity.score(docs, labels).where("predicted = 1").collect()}
    assert toxic == {i for i in range(160) if i % 8 == 3}
    clean = corpus_pipeline.drop_toxic(spark, docs, table)
    assert clean.columns == docs.columns and count(clean) == Counter(r for r in rows if r[0] not in toxic)
    good = corpus_pipeline.drop_low_quality(spark, clean, table)
    bad = {(r.doc_id) for r in pu_quality.score(clean, labels).where("predicted = 0").collect()}
    assert {i for i in range(160) if i % 8 == 5} <= bad and not bad & {i for i in range(160) if i % 8 in (0, 1, 2, 4, 7)}
    assert count(good) == Counter(r for r in rows if r[0] not in toxic and r[0] not in bad)
    once = corpus_pipeline.drop_near_copies(spark, good, table)
    left = [r for r in dict.fromkeys(good.toPandas().astype(object).where(lambda d: d.notna(), None).itertuples(index=False, name=None))]
    named = sorted((r for r in left if r[0] is not None), key=lambda r: r[0])
    label = brute([r[1] or "" for r in named])
    assert {r.doc_id for r in once.collect() if r.doc_id is not None} == {named[k][0] for k in set(label)}
    assert once.where("doc_id is null").count() == good.where("doc_id is null").count() and once.columns == docs.columns
    known = once.where("doc_id is not null and text is not null").dropDuplicates(["doc_id"])
    mixed = corpus_pipeline.mix_sources(spark, known, table)
    want = plain([(r.doc_id, r.text, r.source) for r in known.collect()])
    got = Counter(r.doc_id for r in mixed.collect())
    assert {r.doc_id: got[r.doc_id] * len(r.text.split()) for r in known.collect()} == want and mixed.columns == docs.columns
    placed = corpus_pipeline.pack_sequences(spark, mixed, table)
    packed = packing.pack(mixed, with_ids=True).collect()
    assert Counter(tuple(r) for r in placed.select("doc_id", "length", "ids_crc32").collect()) == Counter((r.doc_id, r["length"], r.ids_crc32) for r in packed)
    lib = library()
    ids = {r.doc_id: [*lib.encode(r.text, add_special_tokens=False).ids, 1] for r in known.collect()}
    assert Counter(r.doc_id for r in packed) == got and all(r.ids == ids[r.doc_id] and r["length"] == len(r.ids) for r in packed)


def test_run_and_empty_tables(spark, table, tmp_path):
    out = corpus_pipeline.run(spark, table)
    assert out.count() and "sequence_id" in out.columns
    docs, labels = spark.read.parquet(f"{table}/documents.parquet"), spark.read.parquet(f"{table}/labels.parquet")
    for k, (d, lab) in enumerate(((docs.limit(0), labels), (docs, labels.limit(0)))):
        d.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        lab.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert got.columns == out.columns and got.count() == 0 if k == 0 else got.count() >= 0
