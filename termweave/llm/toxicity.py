"""Toxicity categories by a chain of linear classifiers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, held_out, slices, worker_cache

#: Labelled texts that the fit reads at most, of each label; features that a model keeps; folds of the out-of-fold predictions.
MOST_LABELLED, MOST_FEATURES, FOLDS = 3000, 1500, 4
#: In the order of the chain: toxic texts with a word that marks toxic texts, with three such words or more, and toxic by label.
#: `labels` has one toxicity label: the first two split it by the words seen in training, and add no label of their own.
CATEGORIES = ("overt", "severe", "toxic")
THRESHOLD = 0.5
#: Words that a worker remembers at most.
MOST_WORDS = 100_000
WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[str, ...]:
    """A word and its openings, so that other endings of a known stem count too."""
    return (word, *(f"{word[:n]}-" for n in (4, 5, 6, 7) if len(word) > n))


def _logistic(x, y, rounds: int = 150, rate: float = 0.05, decay: float = 1e-4):
    """Weights and bias by Adam over all rows; the rarer label weighs up to four times as much."""
    import numpy as np

    w, b = np.zeros(x.shape[1], np.float32), 0.0
    rare = min(4.0, max(1.0, (len(y) - y.sum()) / max(1.0, y.sum())))
    weight = np.where(y > 0, rare, 1.0).astype(np.float32)
    weight /= weight.sum()
    m = v = mb = vb = 0.0
    for t in range(1, rounds + 1):
        g = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y)
        gw, gb = x.T @ g + decay * w, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b = b - rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w.astype(np.float32), float(b)


def _sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def targets(y, marked) -> list:
    """What each category's model learns, from the label and how many marking words a text has."""
    return [y & (marked > 0), y & (marked > 2), y]


def fit_chain(x, y, fold, columns: list, marks: list):
    """([(weights, bias)], held): a model for each category over the features columns[-1], then the probabilities of the categories before it.

    x: texts by features; columns[k] and marks[k] are the features and marking words chosen without the texts of fold k, the last of
    each those chosen from all.  held holds each text's out-of-fold probabilities, so that later models see earlier categories as
    uncertain as they will be on new texts: a text's own label and words have no part in the features, marks or model that give its
    probability.  From the second category on that model also learns from other texts' probabilities of earlier categories, and
    those come from models that were trained on this text among others; folds are not nested.
    """
    import numpy as np

    held, chain = np.zeros((len(x), len(CATEGORIES)), np.float32), []
    of = [targets(y, x[:, m].sum(1)) for m in marks]
    for j in range(len(CATEGORIES)):
        for k in range(len(columns) - 1):
            out, z = fold == k, np.c_[x[:, columns[k]], held[:, :j]]
            w, b = _logistic(z[~out], of[k][j][~out].astype(np.float32))
            held[out, j] = _sigmoid(z[out] @ w + b)
        chain.append(_logistic(np.c_[x[:, columns[-1]], held[:, :j]], of[-1][j].astype(np.float32)))
    return chain, held


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_LABELLED):
    """(names of features, chain) or None where a label is missing.

    Reads at most `most` labelled texts of each label, in an order by hash of the id, never those whose crc32 of the id as text
    leaves 2 modulo 4; of rows that share an id the one whose text has the least hash.  Features are the words, and openings of
    words, that differ most between labels; words that mark toxic texts are those of them in 3 or more toxic texts and in no
    other.  Both are chosen once from all these texts, and once without each fold, for the out-of-fold probabilities.
    """
    import numpy as np

    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(~held_out() & F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).where(F.col("doc_id").isNotNull())
    known = durable(known.join(slim.select("doc_id").distinct(), "doc_id", "left_semi"))
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit("tox")), "doc_id").limit(most) for y in (0, 1)]
    chosen = some[0].unionByName(some[1]).select(F.col("doc_id").alias("chosen_id"), "y")  # at most twice `most` rows

    def measure(batches):
        import pyarrow as pa

        for b in slices(batches):
            found = [sorted({f for w in set(WORDS.findall((t.as_py() or "").lower())) for f in word_features(w)}) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), b.column("fold"), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "y", "fold", "feats"])

    got = slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).groupBy("doc_id", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    got = durable(got.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")).mapInArrow(measure, "doc_id long, y int, fold int, feats array<string>"))
    every = {r.doc_id: (r.y, r.fold) for r in got.select("doc_id", "y", "fold").collect()}
    if len({y for y, _ in every.values()}) < 2:
        return None
    # Counts of features meet on the executors, by fold; the driver gets the best of them and each text's.
    feats = got.select("doc_id", "y", "fold", F.explode("feats").alias("f"))
    n = lambda y, k: float(sum(1 for v, fold in every.values() if v == y and fold != k))
    sums = [F.sum(F.when((F.col("fold") != k) & (F.col("y") == y), 1.0).otherwise(0.0)).alias(f"c{y}_{k}") for k in range(FOLDS + 1) for y in (0, 1)]
    counts = durable(feats.groupBy("f").agg(*sums).where(F.col(f"c1_{FOLDS}") + F.col(f"c0_{FOLDS}") >= 3))
    columns, marks, at = [], [], {}
    for k in range(FOLDS + 1):
        c1, c0 = F.col(f"c1_{k}"), F.col(f"c0_{k}")
        lift = F.abs(F.log((c1 + 0.5) / (n(1, k) + 1)) - F.log((c0 + 0.5) / (n(0, k) + 1))) * F.sqrt(c1 + c0)
        best = counts.where(c1 + c0 >= 3).orderBy(lift.desc(), "f").limit(MOST_FEATURES).select("f", c1.alias("c1"), c0.alias("c0")).collect()
        columns.append([at.setdefault(r.f, len(at)) for r in best])
        marks.append([at[r.f] for r in best if r.c0 == 0 and r.c1 >= 3 and not r.f.endswith("-")])
    names = docs.sparkSession.createDataFrame(list(at.items()) or [("", -1)], "name string, i int")  # at most MOST_FEATURES a fold and once more
    hits = feats.join(F.broadcast(names), F.col("f") == F.col("name")).groupBy("doc_id").agg(F.collect_list("i").alias("at")).collect()
    ids = sorted(every)
    row = {d: i for i, d in enumerate(ids)}
    x = np.zeros((len(ids), len(at)), np.float32)
    for r in hits:
        x[row[r.doc_id], r["at"]] = 1
    y, fold = np.array([every[d][0] for d in ids], bool), np.array([every[d][1] for d in ids])
    chain, _ = fit_chain(x, y, fold, columns, marks)
    back = {i: f for f, i in at.items()}
    return [back[i] for i in columns[-1]], [(w.tolist(), b) for w, b in chain]


class _Known(dict):
    """Words to the numbers of their features, as far as seen; bounded by starting again."""

    def __init__(self, names):
        super().__init__()
        self.at = {f: i for i, f in enumerate(names)}

    def __missing__(self, word):
        if len(self) >= MOST_WORDS:
            self.clear()
        hit = self[word] = tuple(self.at[f] for f in word_features(word) if f in self.at)
        return hit


def _probabilities(model, texts):
    """One row a text, one column a category: a batch's features as one sparse matrix, multiplied once a category."""
    import numpy as np

    if model is None:
        return np.zeros((len(texts), len(CATEGORIES)))
    names, chain = model
    cache, key = worker_cache("toxicity"), hash(tuple(names))
    if key not in cache:
        cache.clear()
        cache[key] = _Known(names)
    known = cache[key]
    found = [set().union(*map(known.__getitem__, set(WORDS.findall((t or "").lower())))) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    flat = np.fromiter((i for f in found for i in f), np.int64, len(row))
    p = np.zeros((len(texts), len(CATEGORIES)))
    for j, (w, b) in enumerate(chain):
        w = np.asarray(w)
        p[:, j] = _sigmoid(b + np.bincount(row, w[flat], len(texts)) + p[:, :j] @ w[len(names) :])
    return p


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fit) -> DataFrame:
    """(doc_id, held_out, overt, severe, toxic, predicted) for each row of docs: probabilities in the order of the chain, and 1 if toxic.

    Whole texts of any length are read.  Null and empty texts have no words and get the models' biases.  Without labels of both
    kinds all probabilities are 0.  Repeated rows score alike, a null id is scored too; an empty table gives none.  overt and severe
    split the one toxicity label by the words seen and add no label.  Other columns are not read, whatever their names.
    """
    model = train(docs, labels, id_col, text_col, **fit)

    def judge(batches):
        import pyarrow as pa

        for b in slices(batches):
            p = _probabilities(model, [t.as_py() for t in b.column(2)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c) for c in p.T]], names=["doc_id", "held_out", *CATEGORIES])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInArrow(judge, "doc_id long, held_out boolean, " + ", ".join(f"{c} double" for c in CATEGORIES)).withColumn("predicted", (F.col(CATEGORIES[-1]) >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fit) -> DataFrame:
    """The rows of docs that are not toxic, with all their columns, whatever their names; nothing is shuffled.  Nulls, empty texts and repeats as in score."""
    model = train(docs, labels, id_col, text_col, **fit)
    at = docs.columns.index(text_col)

    def keep(batches):
        import pyarrow as pa

        for b in slices(batches):
            yield b.filter(pa.array(_probabilities(model, [t.as_py() for t in b.column(at)])[:, -1] < threshold))

    return docs.mapInArrow(keep, docs.schema)
