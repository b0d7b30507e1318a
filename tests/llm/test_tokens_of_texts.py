"""Token counts and alignments against the libraries on whole texts, and against plain Python."""

import hashlib
import itertools
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from termweave.llm import alignment, byte_pairs, packing, queries, token_counts, token_orc
from termweave.llm.tokens import encoder, is_lower_words, tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  ", "  a", "   a", "a  b", "a   b", "a \n b", "a\n b", "a\n  b", "\n", "\n\n", "\n\nDe", "x\n\n\ny z", "\t\tx\t y", "a\r\nb", "a\r \nb", "a; \r\n}", "a\xa0 b", "a \xa0b",
    "don't I'll we've 'tis 'S", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "<s> </s> <unk>", "a▁b", "▁", "x\x00y", "½ ² ³ x²", "à la carte Straße", "日本語 テキスト。", "مرحبا بالعالم", "naïve 🙂🙃 👩‍👩‍👧", "é é", "1234567890 12 3", "a_b __init__ _",
    "\x1cx \x1d y", "  z ", "​zero﻿", "Ⅷ ৴ ൰", "w" * 3000, " ".join(["word"] * 3000), "*" * 500 + " " * 70 + "end", "<0x0A> <0x41>", "\x85 next", "𐍈𝔘 ꧁", "(x);\n\t}\r\n", ".,;:!?\n...", "tion.\nDe***",
]
DOCS = [*enumerate(ODD), (1000, ODD[25]), (None, ODD[38]), (1, None)]
SCHEMA = "doc_id long, text string, n_tokens string, links string, block string, pairs string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in DOCS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    return DOCS + [(10_000 + r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


def test_counts(spark, docs, texts):
    whole = Tokenizer.from_file(tokenizer_path(token_counts.TOKENIZER))
    want = Counter((i, len((t or "").encode()), n := len(whole.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in DOCS)
    got = token_counts.count_tokens(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == want
    count = token_counts.counter(tokenizer_path(token_counts.TOKENIZER), byte_pairs.whole_tokens(tokenizer_path(token_counts.TOKENIZER)))
    assert all(count(t or "") == len(whole.encode(t or "", add_special_tokens=False).ids) for _, t in texts)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_other_files(docs, name):
    path = tokenizer_path(name)
    if name.endswith(".json"):
        whole = Tokenizer.from_file(path)
        plain = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    else:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = lambda t: len(model.encode(t))
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, path, limit=3).collect())
    assert got == Counter((i, plain(t or "")) for i, t in DOCS)


def test_proved_strings():
    path = tokenizer_path(token_counts.TOKENIZER)
    whole, proved = Tokenizer.from_file(path), byte_pairs.whole_tokens(path)
    assert 40_000 < len(proved) <= whole.get_vocab_size() and " the" in proved
    assert all(len(whole.encode(s, add_special_tokens=False).ids) == 1 for s in proved)


def test_tables_of_counts_stay_small():
    path = tokenizer_path(token_counts.TOKENIZER)
    whole, proved = byte_pairs.load(path), byte_pairs.whole_tokens(path)[:100]
    of = token_counts.PieceCounts(whole, proved, most=50)
    words = [f" w{i}x" for i in range(400)]
    assert [of[w] for w in words + words] == [len(whole.encode(w, add_special_tokens=False).ids) for w in words + words]
    assert len(of) <= 151


def test_classes_are_the_library_s():
    pre = byte_pairs.load(tokenizer_path(token_counts.TOKENIZER)).pre_tokenizer
    for c in itertools.chain(range(0xD800), range(0xE000, 0x11000)):
        ch = chr(c)
        if not byte_pairs.ODD.search(ch) and (c < 0x3000 or c % 7 == 0):
            s = f"a{ch}a 1{ch}1 .{ch}. {ch}{ch} x{ch}"
            assert [m.span() for m in byte_pairs.PRETOKEN.finditer(s)] == [o for _, o in pre.pre_tokenize_str(s)], hex(c)


def plain_alignment(rows):
    """What align gives, from the libraries on whole texts and all overlaps."""
    a_tok = Tokenizer.from_file(tokenizer_path(alignment.A_FILE))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(alignment.B_FILE))
    of = {c: i for i, c in enumerate(byte_pairs.NAMES)}
    a_raw = lambda i: bytes(of[c] for c in a_tok.id_to_token(i))
    b_raw = lambda i: bytes.fromhex(b_tok.id_to_piece(i)[3:5]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
    per, counts = [], Counter()
    for i, t in rows:
        a, b = (a_tok.encode(" " + t, add_special_tokens=False).ids, b_tok.encode(t)) if t else ([], [])
        ra, rb = [a_raw(x) for x in a], [b_raw(x) for x in b]
        if not t or b"".join(ra) != (" " + t).encode() or b"".join(rb) != (" " + t).encode():
            per.append((i, None))
            continue
        ea, eb = list(itertools.accumulate(map(len, ra))), list(itertools.accumulate(map(len, rb)))
        shared = sorted(set(ea) & set(eb))
        links, groups, k, low = [], [], 0, 0
        for x, (s, e) in enumerate(zip([0, *ea], ea)):
            while eb[k] <= s:
                k += 1
            y = k
            while y < len(eb) and (eb[y - 1] if y else 0) < e:
                links.append((a[x], b[y]))
                y += 1
        for cut in shared:
            groups.append(f"{','.join(str(v) for v, e in zip(a, ea) if low < e <= cut)}|{','.join(str(v) for v, e in zip(b, eb) if low < e <= cut)}" if len(a) < 4000 else "")
            low = cut
        counts.update(links)
        per.append((i, (len(a), len(b), len(shared), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if len(a) < 4000 else None)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, x in per:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_g, links, sha = x
            out.append((i, n_a, n_b, n_g, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), sha))
    return out


def compare(got, want):
    known = {w[:7]: w[7] for w in want if w[7] is None}
    got = [(*g[:7], known.get(tuple(g[:7]), g[7])) for g in map(tuple, got)]
    assert Counter(got) == Counter(want)


@pytest.mark.parametrize("pairs", [alignment.LOOKUP_PAIRS, 0])
def test_alignment(spark, docs, monkeypatch, pairs):
    monkeypatch.setattr(alignment, "LOOKUP_PAIRS", pairs)
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 60)
    monkeypatch.setattr(alignment, "PART_BYTES", 400)
    want = plain_alignment(DOCS)
    assert sum(w[4] > 0 for w in want) > 40
    compare(alignment.align(docs).collect(), want)
    assert alignment.align(docs.limit(0)).count() == 0


@pytest.mark.parametrize("pairs", [alignment.LOOKUP_PAIRS, 0])
def test_query_over_documents(spark, monkeypatch, pairs):
    monkeypatch.setattr(alignment, "LOOKUP_PAIRS", pairs)
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 2000)
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    compare(queries.op13_alignment(spark, SF).collect(), plain_alignment(rows))


def test_links_as_rows(docs):
    got = {r.doc_id: r.links_ for r in alignment.token_links(docs).collect()}
    want = {i: (n, s) for i, _, _, _, n, _, _, s in plain_alignment(DOCS)}
    assert all(len(links) == want[i][0] for i, links in got.items())
    for links in got.values():
        assert all(y.a - x.a + y.b - x.b in (1, 2) for x, y in itertools.pairwise(links))


def test_bitsets():
    rng = np.random.default_rng(1)
    for size in (1, 63, 64, 65, 1000):
        at = np.unique(rng.integers(0, size, size // 3 + 1))
        words = alignment.bitset(at, size)
        assert alignment.select(words).tolist() == at.tolist()
        assert alignment.rank(words, np.arange(size + 1)).tolist() == np.searchsorted(at, np.arange(size + 1)).tolist()


def test_cells_are_cut_where_both_cut():
    known = alignment.Cells(tokenizer_path(alignment.A_FILE), tokenizer_path(alignment.B_FILE))
    assert known.separable
    for t in filter(None, ODD):
        cells = known.cut(t)
        assert "".join(cells) == " " + t
        if "▁" not in t:
            assert [i for c in known.b_ids(cells) for i in c] == known.b.encode(t)
        assert [i for c in cells for i in known.a_ids(c)] == known.whole.encode(" " + t, add_special_tokens=False).ids
    assert re.fullmatch(r"( \w+)+", "".join(known.cut("a b c")))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_any_file(texts, name):
    path = tokenizer_path(name)
    whole, ids = Tokenizer.from_file(path), encoder(path)
    assert is_lower_words(path) == (name == "word_bpe_49k.json")
    for _, t in texts:
        assert np.frombuffer(ids(t), "<u4").tolist() == whole.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_and_pieces_of_any_tokenizer(spark, docs, tmp_path, name):
    path = tokenizer_path(name)
    whole = Tokenizer.from_file(path)
    token_orc.write_tokens(docs, str(tmp_path / "ids"), path)
    got = Counter((r.doc_id, tuple(r.ids)) for r in token_orc.read_tokens(spark, str(tmp_path / "ids")).collect())
    assert got == Counter((i, (*whole.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in DOCS)
    pieces = packing.pack(docs, tokenizer=path).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id: r[1] for r in pieces} == {i: sum(len(k) * n for (j, k), n in got.items() if j == i) for i in {i for i, _ in DOCS}}
