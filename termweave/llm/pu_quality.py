"""Text quality from positives and unlabelled texts, by minimising the non-negative unbiased risk."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices

#: Texts that the fit reads at most: trusted positives, and texts of any kind.
MOST_POSITIVE, MOST_UNLABELLED = 4000, 8000
THRESHOLD = 0.7
SIGNS = string.punctuation


def features(text: str | None) -> list[float]:
    """Shares of a whole text: letters, capitals, digits, each sign, repeated words, word pairs and lines, and lengths of words."""
    import math

    import numpy as np

    if not text or text.isspace():
        return [0.0] * (10 + len(SIGNS))
    raw = text.encode("utf-8", "surrogatepass")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, total = raw.split(), len(raw)
    m = max(1, len(words))
    upper, letters = int(n[65:91].sum()), int(n[65:91].sum() + n[97:123].sum() + n[128:].sum())
    lines = raw.split(b"\n")
    again = sum(map(bytes.__eq__, words, words[1:]))
    root = math.sqrt(min(m, 400) / m)  # distinct words grow slower than words
    x = [letters / total - 0.8, upper / max(1, letters), n[48:58].sum() / total, 1 - min(1.0, len(set(words)) / m / root), again / m, 1 - len(set(lines)) / len(lines), total / m - 6]
    x += [1 - min(1.0, len(set(zip(words, words[1:], strict=False))) / m / root), float(m < 8), math.log1p(m) - 5]
    return x + [math.log1p(200 * int(n[ord(c)]) / total) for c in SIGNS]


def _matrix(rows):
    import numpy as np

    return np.array([features(t) for t in rows], np.float64).reshape(-1, 10 + len(SIGNS))


def nnpu_risk(w, p, u, prior: float):
    """(gradient for a step, positive part, negative part) of the non-negative risk with logistic loss, at weights w.

    The risk is prior * loss of positives as positive, plus the loss of unlabelled as negative less prior * that of positives;
    where that second part is negative, the step only takes it back up.
    """
    import numpy as np

    sp, su = 1 / (1 + np.exp(-p @ w)), 1 / (1 + np.exp(-u @ w))
    positive = prior * np.logaddexp(0, -p @ w).mean()
    negative = np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
    as_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
    return -as_negative if negative < 0 else prior * (p.T @ (sp - 1)) / len(p) + as_negative, positive, negative


def _against(w, p, u, _):
    """As nnpu_risk, for telling positives from unlabelled texts, both weighing a half."""
    import numpy as np

    sp, su = 1 / (1 + np.exp(-p @ w)), 1 / (1 + np.exp(-u @ w))
    return 0.5 * (p.T @ (sp - 1)) / len(p) + 0.5 * u.T @ su / len(u), 0.0, 0.0


def fit_nnpu(positive, unlabelled, prior: float, rounds: int = 600, rate: float = 0.05, decay: float = 1e-3, risk=nnpu_risk):
    """Weights (shift, scale, w, b) of a linear model that minimises the risk, by Adam."""
    import numpy as np

    both = np.concatenate([positive, unlabelled])
    shift, scale = both.mean(0), both.std(0) + 1e-3
    p, u = np.clip((positive - shift) / scale, -8, 8), np.clip((unlabelled - shift) / scale, -8, 8)
    p, u = np.c_[p, np.ones(len(p))], np.c_[u, np.ones(len(u))]
    w, m, v = np.zeros(p.shape[1]), 0.0, 0.0
    keep = np.r_[np.full(len(shift), decay), 0.0]
    for t in range(1, rounds + 1):
        g, _, negative = risk(w, p, u, prior)
        g = g if negative < 0 else g + keep * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return shift, scale, w[:-1], w[-1]


def class_prior(positive, unlabelled) -> float:
    """The share of positives among unlabelled texts, from positives and unlabelled texts alone.

    Half of each fits a model of positives against unlabelled; on the other half, the share of unlabelled over that of positives
    above a score bounds the prior from above, and is taken at the score where it is least with a margin for both samples' sizes.
    """
    import numpy as np

    positive, unlabelled = (x[np.random.default_rng(3).permutation(len(x))] for x in (positive, unlabelled))
    shift, scale, w, b = fit_nnpu(positive[::2], unlabelled[::2], 0.5, risk=_against)
    s = lambda x: np.sort(np.clip((x - shift) / scale, -8, 8) @ w + b)
    p, u = s(positive[1::2] if len(positive) > 1 else positive), s(unlabelled[1::2] if len(unlabelled) > 1 else unlabelled)
    at = np.unique(p)
    above = lambda x: 1 - np.searchsorted(x, at) / len(x)
    qp, qu = above(p), above(u)
    margin = np.sqrt(np.log(40) / 2 / len(p)) + np.sqrt(np.log(40) / 2 / len(u))
    best = int(np.argmin((qu + 1.01 * margin) / qp))
    return float(min(0.99, max(0.01, qu[best] / qp[best])))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED):
    """A model as plain arrays, or None where no positive text is known.

    Learns from trusted positives and from texts taken as unlabelled, whatever their labels: labels that are not positive are not
    read.  Both samples are bounded, in an order by hash of the id; of rows that share an id the text with the least hash counts.
    """
    import numpy as np

    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("y")).where(~held_out() & F.col("doc_id").isNotNull() & F.col("y").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).where(F.col("doc_id").isNotNull())
    order = F.xxhash64("doc_id", F.lit("pu"))
    ids = slim.select("doc_id").where(~held_out())
    some = ids.join(known.where("y = 1").select("doc_id"), "doc_id", "left_semi").distinct().orderBy(order, "doc_id").limit(most_positive).select("doc_id", F.lit(1).alias("kind"))
    rest = ids.distinct().orderBy(order, "doc_id").limit(most_unlabelled).select("doc_id", F.lit(0).alias("kind"))
    # At most most_positive + most_unlabelled rows.
    chosen = some.unionByName(rest).groupBy(F.col("doc_id").alias("chosen_id")).agg(F.max("kind").alias("positive"), F.min("kind").alias("only"))

    def measure(batches):
        import pyarrow as pa

        for b in slices(batches):
            x = _matrix(t.as_py() for t in b.column("t"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("positive"), b.column("only"), b.column("h"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "positive", "only", "h", "x"])

    read = slim.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("doc_id", "positive", "only", F.xxhash64("t").alias("h"), "t").mapInArrow(measure, "doc_id long, positive int, only int, h long, x array<double>")
    got = read.groupBy("doc_id", "positive", "only").agg(F.min_by("x", "h").alias("x")).orderBy("doc_id").collect()
    positive = np.array([r.x for r in got if r.positive])
    unlabelled = np.array([r.x for r in got if not r.only])
    if not len(positive) or not len(unlabelled):
        return None
    prior = class_prior(positive, unlabelled)
    return (*fit_nnpu(positive, unlabelled, prior), prior)


def _scores(model, texts):
    import numpy as np

    x = _matrix(texts)
    if model is None:
        return np.full(len(x), 0.5)
    shift, scale, w, b, _ = model
    return 1 / (1 + np.exp(-np.clip((x - shift) / scale, -8, 8) @ w - b))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fit) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs; the text alone is read for a score.

    Labels are learnt only where crc32 of the id as text does not leave 2 modulo 4, and only positive ones.  Null and empty texts
    share one score; whole texts of any length are read.  Without any positive label all scores are 0.5.  Repeated rows score
    alike, a null id is scored too; an empty table gives none.  Other columns are not read, whatever their names.
    """
    model = train(docs, labels, id_col, text_col, **fit)

    def judge(batches):
        import pyarrow as pa

        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_scores(model, (t.as_py() for t in b.column(2))))], names=["doc_id", "held_out", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInArrow(judge, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fit) -> DataFrame:
    """The rows of docs whose score reaches the threshold, with all their columns, whatever their names; nothing is shuffled.  Nulls, empty texts and repeats as in score."""
    model = train(docs, labels, id_col, text_col, **fit)
    at = docs.columns.index(text_col)

    def keep(batches):
        import pyarrow as pa

        for b in slices(batches):
            yield b.filter(pa.array(_scores(model, (t.as_py() for t in b.column(at))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
