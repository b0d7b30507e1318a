"""License scans against plain versions: short texts, windows out of step, full texts with edits."""

import re

import numpy as np

from termweave.llm import licenses


def scanned(spark, texts, templates):
    return {r.doc_id for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates).collect()}


def test_texts_shorter_than_a_window(spark):
    texts = ["work is licensed under the GNU General Public License, version 3", "This work is licensed under the GNU General Public License, version", "under the GNU General Public License, version 3"]
    assert scanned(spark, texts, licenses.templates_frame(spark)) == {0, 1}


def test_misaligned_windows_of_a_long_template(spark):
    rng = np.random.default_rng(17)
    texts, names = [], []
    for k in range(150):
        words = [f"t{k}w{i}" for i in range(68)]  # 64 shingles: windows step by 8
        names.append((f"t{k}", " ".join(words)))
        at = int(rng.integers(5, 55))
        words[at : at + 8] = [f"new{k}x{i}" for i in range(8)]  # 52 of 64 shingles stay
        texts.append(" ".join([f"before{k}x{i}" for i in range(4)] + words + [f"after{k}x{i}" for i in range(40)]))
    schema = "license string, template string"
    assert scanned(spark, texts[100:150], spark.createDataFrame(names[100:150], schema)) == set(range(50))  # four signatures miss one of these


def test_anchors_leave_out_no_passage():
    for _, text in licenses.TEMPLATES:
        words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
        k = min(len(words), licenses.SHINGLE)
        own = licenses.anchors(words, k, 0.8)
        cut = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        assert sum(not set(own) & set(s) for s in cut) < 0.8 * len(cut)


def best_containment(words, template, k):
    """The greatest share of the template's shingles in any passage as long as it and half of that."""
    cut = lambda w: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    want, mine = set(cut(template)), cut(words)
    n = int(1.5 * len(cut(template)))
    return max((len(want & set(mine[i : i + n])) / len(want) for i in range(max(1, len(mine) - n + 1))), default=0)


def test_full_texts_with_edits_against_brute_force(spark):
    rng = np.random.default_rng(23)
    words = {n: re.sub(r"[^a-z0-9]+", " ", t.lower()).split() for n, t in licenses.TEMPLATES if len(t) > 200}
    texts, want = [], set()
    for name, w in words.items():
        for share in [0.0, 0.01, 0.02, 0.03, 0.04, 0.06] * 5:
            v = list(w)
            for at in rng.choice(len(v), int(share * len(v)), replace=False):
                v[at] = f"edit{rng.integers(99)}"
            v = [f"x{i}" for i in rng.integers(0, 500, 60)] + v[: int(len(v) * rng.choice([0.9, 1.0]))] + [f"y{i}" for i in rng.integers(0, 500, 90)]
            if best_containment(v, w, 5) >= 0.8:
                want.add((len(texts), name))
            texts.append(" ".join(v))
    texts.append(" ".join(f"z{i}" for i in range(30_000)) + " " + " ".join(words["isc-text"]).upper())
    want.add((len(texts) - 1, "isc-text"))
    rows = [*((i, t, "x") for i, t in enumerate(texts)), (None, texts[0], "x"), (None, None, "x"), (0, texts[0], "x")]
    got = {(r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, `license` string"), licenses.templates_frame(spark)).collect()}
    assert {g for g in got if g[0] is None} == {(None, next(n for d, n in want if d == 0))}
    got = {g for g in got if g[0] is not None}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 60


def test_as_many_licenses_as_there_are(spark):
    many = [(f"t{i}", " ".join(f"lic{i}w{j}" for j in range(40 + i % 30))) for i in range(300)]
    docs = spark.createDataFrame([(i, f"a b c {t} d e f") for i, (_, t) in enumerate(many)], "doc_id long, text string")
    got = licenses.scan(docs, spark.createDataFrame(many, "license string, template string")).collect()
    assert sorted((r.doc_id, r.license, r.containment) for r in got) == sorted((i, n, 1.0) for i, (n, _) in enumerate(many))


def test_long_texts_of_repeated_lines(spark):
    full = dict(licenses.TEMPLATES)["isc-text"]
    line = "All rights reserved."
    texts = [f"{line} " * 20_000, f"{line}\n" * 3_000 + full + f" {line}" * 3_000, (full + "\n") * 60, "z " * 50_000 + line, "rights all reserved " * 5_000]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), licenses.templates_frame(spark)).collect()
    by = {(r.doc_id, r.license): (r.containment, r.first_word) for r in got}
    short = next(n for n, t in licenses.TEMPLATES if licenses.re.sub(r"[^a-z]+", " ", t.lower()).strip() == "all rights reserved")
    assert by[0, short] == (1.0, 0) and by[1, short] == (1.0, 0) and by[3, short] == (1.0, 50_000) and (4, short) not in by
    assert by[1, "isc-text"][0] == 1.0 and by[2, "isc-text"] == (1.0, 0) and (0, "isc-text") not in by
