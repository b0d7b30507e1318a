import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import connect, rows

import corpus_pipeline
from termweave.llm import ann, embed_dedup, licenses, mixing, packing, pu_quality, queries, simhash, token_orc, toxicity, url_rules
from termweave.llm.components import connected_components
from termweave.llm.tokens import encoder, tokenizer_path

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))
#: Nulls, empty and long texts, repeated rows, and columns whose names clash with those of results.
DOCS = [(1, "a b c d e", "s1"), (1, "a b c d e", "s1"), (2, None, "s1"), (3, "", None), (None, "x y z", "s2"), (4, LONG, "s2"), (5, LONG + " end", "s2"), (6, "A  B\tc d\ne", "s3"), (7, "don't <|endoftext|> Σ é ½", "s3")]
SCHEMA = "doc_id long, text string, source string, fp string, size string, component_id string, sequence_id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, "x", "x", "x", "x") for d in DOCS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, None, None), (6, None, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    got = queries.queries()[name](spark, SF).toPandas()
    want = connect(SF).sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_mixing(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(DOCS)
    assert all(r.taken <= 3 * r["size"] and r["size"] == len((DOCS[[d[0] for d in DOCS].index(r.doc_id)][1] or "").split()) for r in got)
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns
    many = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 5}") for i in range(3000)], "doc_id long, text string, source string")
    out = mixing.mix(many).toPandas()
    for _, g in out.groupby(out.doc_id % 5):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 4
    assert sorted(map(tuple, mixing.mix(many).collect())) == sorted(map(tuple, mixing.mix(many).collect()))
    assert mixing.mixed_documents(many).count() == int((out.taken / out["size"]).sum())


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (99, 98), (50, 50), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((98, 99, 100), 98)}


def test_simhash(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(DOCS)
    assert by[2].fingerprint == by[3].fingerprint == "0" * 16 and by[3].component_id == 2
    assert by[6].fingerprint == by[1].fingerprint and by[6].component_id == 1
    assert by[None].component_id is None
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d in {r.component_id for r in got})


@pytest.mark.parametrize("shard, small", [(60, 2_048), (1_000_000, 30), (1_000_000, 2_048), (100_000, 1)])
def test_simhash_pairs(spark, monkeypatch, shard, small):
    """Many shards whose probes are dealt into parts, shards that are small, one shard; equal to all pairs."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard)
    monkeypatch.setattr(simhash, "SMALL_SHARD", small)
    rng = np.random.default_rng(3)
    fps = set(rng.integers(0, 1 << 63, 300).tolist())
    for f in list(fps)[:150]:
        for b in rng.integers(0, 63, (2, 2)):
            fps.add(f ^ (1 << int(b[0])) ^ (1 << int(b[1])))
    fps = sorted(fps)
    links = simhash.link_fingerprints(spark.createDataFrame(list(enumerate(fps)), "node long, fp long"))
    got = {r.node: r.component for r in connected_components(links).collect()}
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 2
    label = np.arange(len(x))
    for _ in range(50):
        label = np.array([label[n].min() for n in near])
    assert [got.get(i, i) for i in range(len(x))] == label.tolist()


def test_each_probe_meets_each_member_of_its_shard_once():
    rng = np.random.default_rng(4)
    leaf, home = rng.integers(0, 3, 500), rng.random(500) < 0.4
    parts = np.array([1, 4, 7])
    row, cell, probe = simhash._deal(leaf, home, rng.integers(0, 1 << 63, 500).astype(np.uint64), parts)
    first = np.cumsum(parts) - parts
    assert sorted(row[probe]) == list(range(500)) and set(cell[leaf[row] == 2]) == set(range(5, 12))
    for k in range(3):
        for c in range(first[k], first[k] + parts[k]):
            assert set(row[(cell == c) & home[row]]) == set(np.nonzero(home & (leaf == k))[0])
    assert not (~home[row] & ~probe).any() and len(set(zip(row, cell))) == len(row)


def ids_of(text):
    return encoder(tokenizer_path())(text) + np.array([1], "<u4").tobytes()


def test_encoder_is_the_library():
    from tokenizers import Tokenizer

    t, encode = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    for s in ["don't stop's", "a<|endoftext|>b", "Σας ΌΣΟΣ İ", "½ ² ª µm ÀÉ ß", "日本 テ", "a\x00b", "É, é. x.", "a.. b,. ×,", "12,5 a1.", "é    x", ". ,"]:
        assert encode(s) == np.array(t.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), s


def test_token_files(spark, docs, none, tmp_path):
    path = str(tmp_path / "t")
    token_orc.write_tokens(docs, path)
    got = token_orc.digest(spark, path).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(ids_of(t)) // 4, zlib.crc32(ids_of(t))) for d, t, _ in DOCS)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 1, 1, 2, 3, 4, 5, 6, 7]
    assert token_orc.read_tokens(spark, path, 4, 4).count() == 1
    token_orc.write_tokens(none, str(tmp_path / "e"))
    assert token_orc.digest(spark, str(tmp_path / "e")).count() == 0


def check_packed(got, texts):
    assert sum(r["length"] for r in got) == sum(len(ids_of(t)) // 4 for t in texts)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096 and sum(3 * n > 4096 for _, n in b) <= 2


def test_packing(docs, none):
    got = packing.pack(docs).collect()
    check_packed(got, [d[1] for d in DOCS])
    for r in got:
        part = ids_of(next(t for d, t, _ in DOCS if d == r.doc_id))[4 * r.start : 4 * (r.start + r["length"])]
        assert zlib.crc32(part) == r.ids_crc32
    assert packing.pack(none).count() == 0


def test_plan_is_a_packing():
    rng = np.random.default_rng(1)
    for _ in range(200):
        cap = int(rng.choice([7, 12, 30, 4096]))
        counts = {int(n): int(rng.choice([1, 2, 3, 17])) for n in rng.integers(1, cap + 1, int(rng.integers(1, 40)))}
        seen, bins = {n: set() for n in counts}, {}
        for n, a, b, s, o, e in packing.plan(counts, cap):
            for k in range(a, b):
                assert k not in seen[n]
                seen[n].add(k)
                bins.setdefault(s + (k - a) // e, []).append((o + (k - a) % e * n, n))
        assert {n: len(s) for n, s in seen.items()} == counts
        for b in bins.values():
            ends = 0
            for o, n in sorted(b):
                assert o == ends
                ends += n
            assert ends <= cap and sum(3 * n > cap for _, n in b) <= 2


def test_classifiers_on_odd_rows(docs, none, labels):
    for module, keep in ((pu_quality, pu_quality.keep_good), (toxicity, toxicity.keep_clean)):
        assert module.score(docs, labels).count() == len(DOCS)
        assert module.score(none, labels).count() == 0
        assert module.score(docs, labels.limit(0)).count() == len(DOCS)
        assert keep(docs, labels).columns == docs.columns


def test_classifiers_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    for name, label, least in (("op2_quality", "quality", 0.97), ("op5_toxicity", "toxic", 0.95)):
        got = queries.queries()[name](spark, sf).where("held_out").toPandas().set_index("doc_id")
        y = truth[label].reindex(got.index).dropna()
        assert (got.predicted.reindex(y.index) == y).mean() > least


def vectors(n=400, copies=40, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16))
    x[n - copies :] = x[0] + 0.1 * rng.standard_normal((copies, 16))
    x[n - 3] = x[n - 2]
    return x.astype(np.float32).astype(float)


def frame(spark, x, extra=()):
    return spark.createDataFrame([(i, v.tolist(), 1.0) for i, v in enumerate(x)] + list(extra), "vec_id long, embedding array<float>, v double")


ODD = [(9000, None, 1.0), (9001, [0.0] * 16, 1.0), (9002, [float("nan")] + [1.0] * 15, 1.0), (9003, [None] + [1.0] * 15, 1.0), (9004, [1.0, 2.0], 1.0), (9005, [float("inf")] + [1.0] * 15, 1.0), (9050, [0.0] * 16, 1.0)]


def test_vector_links(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 100)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 30)
    monkeypatch.setattr(embed_dedup, "GUEST_ROWS", 40)
    x = vectors()
    got = {r.vec_id: r for r in embed_dedup.near_duplicate_vectors(frame(spark, x, ODD)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, True)
    label = np.arange(len(x))
    for _ in range(20):
        label = np.array([label[n].min() for n in near])
    assert [got[i].n_links for i in range(len(x))] == (near.sum(1) - 1).tolist()
    assert [got[i].component_id for i in range(len(x))] == label.tolist()
    assert all(got[o[0]].n_links == 0 and got[o[0]].kept for o in ODD)
    assert embed_dedup.near_duplicate_vectors(frame(spark, x).limit(0)).count() == 0


def test_vector_links_across_cell_borders(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 8)
    x = np.random.default_rng(5).normal(size=(400, 3))
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicate_vectors(frame(spark, x)).collect()}
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert [got[i] for i in range(len(x))] == ((u @ u.T >= 0.95).sum(1) - 1).tolist()


def test_nearest(spark):
    x = vectors()
    got = ann.nearest(frame(spark, x, ODD)).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, len(x), 50):
        s = u @ u[q]
        s[q] = -9
        mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [k for k, _ in mine] == [1, 2, 3, 4, 5]
        hits += len({v for _, v in mine} & set(np.argsort(-s, kind="stable")[:5].tolist()))
    assert hits >= 0.9 * 5 * len(range(0, len(x), 50))
    assert ann.nearest(frame(spark, x).limit(0)).count() == 0
    assert {(r.query_id, r.vec_id) for r in ann.nearest(frame(spark, x[:2])).collect()} == {(0, 1)}


def test_urls(spark):
    urls = [None, "", "no scheme/x", "http://ORG", "http://a.ORG/x", "https://example.org/es/1?x#y", "http://www.example.org/en/12", "http://example.org/en/2", "http://x.com/fr/", "http://com/de/", "http://notcom/de/", "http://xcom/fr/a", "ftp://com?/fr/", "http://a.com/fr", "http://example.org/es/1?x#y"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rules_frame(spark)).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1].split("?")[0].split("#")[0] if u and "://" in u else ""
        host, path = rest.split("/", 1)[0].lower(), rest[len(rest.split("/", 1)[0]) :]
        fits = [(r, v) for v, r in url_rules.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, "allow")
        assert got[i] == (host, path, rule, verdict), u
    assert url_rules.judge(pages.limit(0), url_rules.rules_frame(spark)).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, url_rules.rules_frame(spark).limit(0)).collect()} == {"allow"}
    many = spark.createDataFrame([("block", f"h{i}.net/p{j}/") for i in range(20) for j in range(3)] + [("allow", "net/"), ("block", "h1.net/p1/q/")], "verdict string, rule string")
    asked = spark.createDataFrame([(i, f"http://w.h{i % 23}.net/p{i % 4}/q/r") for i in range(200)], "page_id long, url string")
    rules = {r.rule: r.verdict for r in many.collect()}
    for r in url_rules.judge(asked, many).collect():
        fits = [k for k in rules if ("." + r.host).endswith("." + k.split("/")[0]) and r.path.startswith(k[k.index("/") :])]
        assert r.rule == (max(fits, key=len) if fits else None)


def test_licenses(spark, docs, none):
    t = licenses.templates_frame(spark)
    long_text = " ".join(f"clause{i}" for i in range(60))
    t = t.unionByName(spark.createDataFrame([("long", long_text)], t.schema))
    edited = long_text.replace("clause30", "changed")
    texts = ["All rights reserved.", "x (ALL RIGHTS: reserved) y", "all rights", f"intro {long_text} end", f"a b {edited} c", " ".join(long_text.split()[:30]), "this work is licensed under the gnu general public license version 3", None, "", LONG + " released under the MIT license", "changed work is licensed under the GNU general public license, version 3."]
    got = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), t).collect()}
    assert got == {(0, "all-rights-reserved"), (1, "all-rights-reserved"), (3, "long"), (4, "long"), (6, "gpl-3.0"), (9, "mit"), (10, "gpl-3.0")}
    assert licenses.scan(none, t).count() == 0 and licenses.scan(docs, t.limit(0)).count() == 0


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(corpus_pipeline.STAGES) == 5 and got
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
