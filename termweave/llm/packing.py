"""Best-fit packing of documents into sequences, planned on the counts of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, slices
from .tokens import END_ID, encoder, tokenizer_path

#: Tokens in a sequence; pieces of one length that are numbered in one task.
CAPACITY, NUMBERED_ROWS = 4096, 50_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece int, start long, length long, ids_crc32 long), with_ids also ids array<int>: each document's ids and the end id,
    cut only if longer than the capacity; a null or empty text is the end id alone."""
    tokenizer = tokenizer or tokenizer_path()

    def cut(batches):
        import zlib
        from array import array

        import numpy as np
        import pyarrow as pa

        ids_of, end = encoder(tokenizer), array("I", [end_id]).tobytes()
        for b in slices(batches):
            docs, parts, at = [], [], []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = ids_of(t.as_py()) + end
                cuts = range(0, len(raw), 4 * capacity)
                docs += [doc] * len(cuts)
                at += [i // 4 for i in cuts]
                parts += [raw[i : i + 4 * capacity] for i in cuts]
            length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            start = np.array(at, np.int64)
            out = [pa.array(docs, pa.int64()), pa.array((start // capacity).astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))), pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4"))))
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first, last, sequence, offset, each).

    Pieces of one length are numbered from 0; those from first up to last go to sequences from `sequence` on, `each` of them side
    by side in one, from offset on.  Large pieces, above a third of the capacity, meet at most one other large piece: from the
    longest down, the longest that still fits.  Smaller ones, from the longest down, go to the smallest gap that holds them, or
    to new sequences.  Bins alike are handled at once, so work and plan depend on the number of lengths, at most the capacity,
    and not on the number of pieces.
    """
    left = {n: c for n, c in sorted(counts.items()) if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    used: dict[int, int] = defaultdict(int)
    groups: list[list] = []  # [bins, gap, [(length, each, first number)]]
    by_gap: dict[int, list[int]] = defaultdict(list)
    gaps: list[int] = []

    def add(bins: int, gap: int, held: list) -> None:
        groups.append([bins, gap, held])
        if gap:
            if not by_gap[gap]:
                insort(gaps, gap)
            by_gap[gap].append(len(groups) - 1)

    def take(length: int, n: int) -> int:
        first = used[length]
        used[length] += n
        left[length] -= n
        return first

    large = [n for n in left if 3 * n > capacity]
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        at = bisect_left(large, capacity - n + 1) - 1
        while at >= 0 and not left[large[at]]:
            large.pop(at)
            at -= 1
        if at < 0 or large[at] == n and left[n] == 1:
            at = at - 1 if at >= 0 else at
            while at >= 0 and not left[large[at]]:
                large.pop(at)
                at -= 1
        if at < 0:
            m = left[n]
            add(m, capacity - n, [(n, 1, take(n, m))])
        elif large[at] == n:
            m = left[n] // 2
            add(m, capacity - 2 * n, [(n, 2, take(n, 2 * m))])
        else:
            o = large[at]
            m = min(left[n], left[o])
            add(m, capacity - n - o, [(n, 1, take(n, m)), (o, 1, take(o, m))])

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            at = bisect_left(gaps, n)
            if at < len(gaps):
                gap = gaps[at]
                g = by_gap[gap].pop()
                if not by_gap[gap]:
                    gaps.pop(at)
                bins, _, held = groups[g]
                groups[g] = None
            else:
                gap, held, bins = capacity, [], -(-left[n] // (capacity // n))
            fits = gap // n
            full = min(bins, left[n] // fits)
            if full:
                add(full, gap - fits * n, [*held, (n, fits, take(n, fits * full))])
            rest = bins - full
            if rest and left[n] and left[n] < fits:
                k = left[n]
                add(1, gap - k * n, [*([(a, e, f + e * full) for a, e, f in held]), (n, k, take(n, k))])
                rest, full = rest - 1, full + 1
            if rest:
                add(rest, gap, [(a, e, f + e * full) for a, e, f in held])
    out, sequence = [], 0
    for g in groups:
        if g is not None:
            offset = 0
            for length, each, first in g[2]:
                out.append((length, first, first + each * g[0], sequence, offset, each))
                offset += length * each
            sequence += g[0]
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, **how) -> DataFrame:
    """The pieces of docs, each with sequence_id long and offset long.

    Texts are encoded once, and the pieces kept in the checkpoint folder.  Only the counts of lengths, at most as many as the
    capacity, reach the driver, and the plan that comes back is bounded by them too.  Repeated rows are packed each, ids that are
    null too; which of equally long pieces goes where follows a hash, so ties change no length.  A text longer than a sequence is cut,
    whole; a null or empty one is its end id.  An empty table gives none.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    parts = durable(pieces(docs, capacity, **how))
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = [(n, a, b, s, o, e) for n, a, b, s, o, e in plan(counts, capacity)]
    where = spark.createDataFrame(slots, "plen long, first long, last long, seq long, off long, each long")
    # Numbers within a length, also where one length has most of the rows: within salted groups, plus what the groups before hold.
    salts = max(1, -(-sum(counts.values()) // NUMBERED_ROWS))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select(F.col("length").alias("blen"), F.col("salt").alias("bsalt"), (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    numbered = salted.withColumn("within", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    numbered = numbered.join(before, (F.col("length") == F.col("blen")) & (F.col("salt") == F.col("bsalt"))).withColumn("number", F.col("before") + F.col("within"))
    # Each length's slots as one sorted array; a piece finds its own by counting those that end before it.
    lists = where.groupBy("plen").agg(F.array_sort(F.collect_list(F.struct("first", "last", "seq", "off", "each"))).alias("slots"))
    placed = numbered.join(F.broadcast(lists), F.col("length") == F.col("plen")).withColumn("slot", F.filter("slots", lambda s: (s["first"] <= F.col("number")) & (F.col("number") < s["last"]))[0])
    nth = F.col("number") - F.col("slot.first")
    keep = [c for c in parts.columns]
    return placed.select(*keep, (F.col("slot.seq") + F.floor(nth / F.col("slot.each"))).cast("long").alias("sequence_id"), (F.col("slot.off") + nth % F.col("slot.each") * F.col("length")).cast("long").alias("offset"))
