"""License texts in documents: MinHash bands over overlapping windows, then exact shingle containment; built-in functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The license lines and full license texts that the query looks for, by name.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
        so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
        BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
        AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "bsd-2-clause-text",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
        following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE
        COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
        LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
        ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
        OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "isc-text",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
        that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
        OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
        THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    (
        "public-domain-text",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate
        any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large
        and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
        all present and future rights to this software under copyright law.""",
    ),
)
#: Words to a shingle (a shorter template is one shingle), and the share of a template's shingles that a passage must hold.
SHINGLE, CONTAINMENT = 5, 0.8
#: Hashes from which windows step by more than one and have more signatures.
WIDE = 16
#: Bits of the set that signatures are tested against before they are joined; its size does not grow with the templates.
SET_BITS = 1 << 16


def _words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _hashes(words: Column, k: int) -> Column:
    """A hash for each run of k words."""
    one = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), one)).otherwise(F.array().cast("array<bigint>"))


def _shingles(words: Column, k: int) -> Column:
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(k))))).otherwise(F.array().cast("array<string>"))


def _bands(h: Column, at: Column, w: Column) -> Column:
    """Signatures of the window of w hashes from at on: the least and the greatest under each of two hash functions, of three from WIDE on.

    Windows whose sets have Jaccard similarity J agree in one or more with probability about 1 - (1 - J)^4, from WIDE on
    1 - (1 - J)^6, and 1 for equal sets.  For a window and a template that share 0.8 of their shingles J is 2/3, and 0.988 agree.
    From WIDE on windows step by an eighth of their width, so the nearest may be off by a sixteenth: then they share 0.7375,
    J is 0.58, and 0.994 agree.
    """
    part = F.slice(h, at, w)
    ends = lambda x: [F.array_min(x), F.array_max(x)]
    again = lambda seed: F.transform(part, lambda x: F.xxhash64(x, F.lit(seed)))
    few = [*ends(part), *ends(again(1))]
    return F.when(w >= WIDE, F.array(*few, *ends(again(2)))).otherwise(F.array(*few))


def templates_frame(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    return spark.createDataFrame([(n, t) for n, t in templates if re.search(r"\w", t)], "license string, template string")


def _windows(h: Column, w: Column, step: Column) -> Column:
    """Positions, from 1, of windows of w over the array h, the last one at its end; a shorter array is one window."""
    n = F.size(h) - w + 1
    return F.when(n >= 1, F.array_distinct(F.concat(F.sequence(F.lit(1), n, step), F.array(n)))).when(F.size(h) > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))


def anchors(words: list[str], k: int, containment: float) -> list[str]:
    """Words of a template, long ones first, whose shingles are more than a passage may lack.

    A passage without any of them lacks all shingles that hold one, and so cannot reach the containment: texts without an anchor
    need no signatures.
    """
    shingles = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    total, out, held = len(set(shingles)), [], set()
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        if len(held) > (1 - containment) * total + 1e-9:
            break
        out.append(w)
        held |= {s for s in shingles if w in s}
    return out


def _bit_set(signatures) -> Column:
    """SET_BITS bits as one literal of longs, in which a signature's bit is set."""
    bits = [0] * (SET_BITS // 64)
    for s in signatures:
        at = s % SET_BITS
        bits[at // 64] |= 1 << (at % 64)
    return F.lit([b - (1 << 64) if b >> 63 else b for b in bits]).cast("array<bigint>")


def _agreeing(hashes: Column, k: int, width: int, wanted: Column, back: int, ahead: int) -> Column:
    """array<struct<k, width, pos, bands, first, words>>: windows of the width that may have a wanted signature, by the bit set.

    They are signed within the document's row, with its hashes bound to a name so that they are not made anew for each window.  Only
    those that may agree with a template leave the row, each with the words from `back` before it to `ahead` after its start, numbered
    from first: a few times a template's length, so what leaves a row grows as its text does, however many windows agree.
    """
    w = F.lit(width)
    sign = lambda h: F.transform(_windows(h, w, F.lit(max(1, width // 8))), lambda p: F.struct(p.alias("pos"), _bands(h, p, w).alias("bands")))
    at = lambda s: F.pmod(s, F.lit(SET_BITS))
    has = lambda s: F.getbit(F.get(wanted, F.floor(at(s) / 64).cast("int")), (at(s) % 64).cast("int")) == 1
    first = lambda s: F.greatest(s["pos"] - back, F.lit(0))
    cut = lambda s: F.struct(F.lit(k).alias("k"), F.lit(width).alias("width"), s["pos"].alias("pos"), s["bands"].alias("bands"), first(s).alias("first"), F.slice("w", first(s) + 1, s["pos"] - first(s) + ahead).alias("words"))
    return F.transform(F.array(hashes), lambda h: F.transform(F.filter(sign(h), lambda s: F.exists(s["bands"], has)), cut))[0]


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", containment: float = CONTAINMENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, license, containment, first_word): a row for each document and license that some passage of it holds.

    templates: (license, template); their number is that of known licenses, so a few rows of each reach the driver and come back as
    a broadcast table of signatures.  Letters and digits count, case and signs do not.  containment is the share of the template's
    distinct shingles in the best passage, first_word where the first passage with enough of them begins, from 0.  Whole texts of
    any length are scanned.  Null and empty texts hold nothing; rows that share an id, null ids too, are reported as one; templates
    that are alike are reported each; no templates or no documents give no rows.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    t = templates.where(F.col("template").isNotNull()).select("license", _words(F.col("template")).alias("w")).where(F.size("w") > 0)
    t = t.withColumn("k", F.least(F.size("w"), F.lit(shingle)))
    texts = t.select("w", "k").collect()  # the templates
    sized = sorted({r.k for r in texts})
    if not sized:
        return docs.select(F.col(id_col).cast("long").alias("doc_id")).limit(0).select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word"))
    chunks = None
    for k in sized:
        own = t.where(F.col("k") == k).withColumn("h", _hashes(F.col("w"), k)).withColumn("n", F.size("h"))
        # Windows as long as the largest power of two that fits; a longer template has several.
        own = own.withColumn("width", F.pow(F.lit(2), F.floor(F.log2("n"))).cast("int"))
        own = own.withColumn("at", F.explode(F.expr("array_distinct(concat(sequence(1, n - width + 1, width), array(n - width + 1)))")))
        own = own.withColumn("bands", _bands(F.col("h"), F.col("at"), F.col("width")))
        own = own.select("license", "k", "width", "at", "bands", "n", _shingles(F.col("w"), k).alias("set"))
        chunks = own if chunks is None else chunks.unionByName(own)
    known = chunks.collect()  # a few rows a template
    rare = sorted({a for r in texts for a in anchors(r.w, r.k, containment)})

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), _words(F.col(text_col).cast("string")).alias("w"))
    d = d.where(F.arrays_overlap("w", F.lit(rare)))
    bands = spark.createDataFrame([(r.license, r.k, r.width, r["at"], b, s, r.n, r.set) for r in known for b, s in enumerate(r.bands)], "license string, k int, width int, at int, band int, sig bigint, n int, set array<string>")
    # All classes of windows come from one pass over the texts, their hashes made once.
    classes = sorted({(r.k, r.width) for r in known})
    agreeing = []
    for k, width in classes:
        own = [r for r in known if (r.k, r.width) == (k, width)]
        back, ahead = max(r["at"] + r.n // 4 for r in own), max(r.n + k - 1 + 2 * (r.n // 4) for r in own)
        agreeing.append(_agreeing(F.col(f"h{k}"), k, width, _bit_set({x for r in own for x in r.bands}), back, ahead))
    x = d.select("doc_id", "w", *[_hashes(F.col("w"), k).alias(f"h{k}") for k in sized]).select("doc_id", F.explode(F.concat(*agreeing)).alias("s"))
    x = x.select("doc_id", F.col("s.words").alias("w"), F.col("s.first").alias("first"), F.col("s.k").alias("wk"), F.col("s.width").alias("wwidth"), F.col("s.pos").alias("pos"), F.posexplode("s.bands").alias("wband", "wsig"))
    # Bounded by the templates: at most six rows a chunk.
    x = x.join(F.broadcast(bands), (F.col("wk") == F.col("k")) & (F.col("wwidth") == F.col("width")) & (F.col("wband") == F.col("band")) & (F.col("wsig") == F.col("sig")))
    start = F.col("pos") - F.col("at")
    slack = F.floor(F.col("n") / 4).cast("int")
    passage = F.slice("w", F.greatest(start - slack, F.lit(0)) - F.col("first") + 1, F.col("n") + F.col("k") - 1 + 2 * slack)
    held = F.when(F.col("k") == sized[0], _shingles_of(passage, sized[0]))
    for k in sized[1:]:
        held = held.when(F.col("k") == k, _shingles_of(passage, k))
    share = F.size(F.array_intersect("set", held)) / F.size(F.array_distinct("set"))
    hits = x.select("doc_id", "license", share.alias("containment"), F.greatest(start, F.lit(0)).alias("first_word"))
    return hits.where(F.col("containment") >= containment).groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min("first_word").cast("int").alias("first_word"))


def _shingles_of(passage: Column, k: int) -> Column:
    """As _shingles, with the passage cut once."""
    return F.transform(F.array(passage), lambda p: _shingles(p, k))[0]
