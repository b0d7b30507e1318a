"""SimHash fingerprints, and exact pairs within a Hamming distance through vantage-point trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fresh, slices
from .components import connected_components, star_edges

#: Fingerprints from which the shards' tree is grown, at least and for each shard.
TREE_SAMPLE, SHARD_SAMPLE = 20_000, 64
#: Distinct fingerprints that live in a shard, and that a task looks up there, on average and at most: sixteen bytes each.
SHARD_ROWS = 1_000_000
#: Fewer fingerprints than so many shards hold are dealt into shards of so many, that tasks have something to share.
SHARDS, SMALL_SHARD = 32, 2_048
#: Rows of sixteen bytes that a join broadcasts at most.
BROADCAST_ROWS = 1_000_000


def shingle_hashes(text: str | None, words: int, seed: int = 42):
    """XXH64 (unsigned, UTF-8) of each run of so many words of a text, A-Z lower-cased, in order; fewer words are one run, none give none."""
    import numpy as np
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone change case, ASCII space alone splits
    if not parts:
        return np.empty(0, "<u8")
    flat, h = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends + 1)).tolist()
    return np.array([h(flat[s:e], seed) for s, e in zip(starts, ends[min(words, len(parts)) - 1 :].tolist())], "<u8")


def fingerprint_of(hashes) -> int:
    """A bit is 1 if more than half of the hashes have it; no hashes give zero."""
    import numpy as np

    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp long): the 64-bit SimHash of each whole text, as a signed long.

    Shingles are runs of so many words with A-Z lower-cased, repeats counted; a text with fewer words is one shingle, an empty
    or null one gets 0.  A bit is 1 if more than half of the shingles' XXH64 have it.
    """

    def score(batches):
        import numpy as np
        import pyarrow as pa

        for b in slices(batches):
            fp = np.array([fingerprint_of(shingle_hashes(t.as_py(), words, seed)) for t in b.column(1)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(score, "doc_id long, fp long")


def grow_tree(sample, leaves: int, radius: int):
    """A vantage-point tree over sampled fingerprints (uint64) as nested tuples (vantage, boundary, inner, outer); leaves are numbers."""
    import numpy as np

    count = [0]

    def grow(points, parts):
        if parts <= 1 or len(points) < 4:
            count[0] += 1
            return count[0] - 1
        # Of a few candidates, the vantage point whose distances spread most leaves least around its boundary.
        best = None
        for v in points[:: max(1, len(points) // 8)][:8]:
            d = np.bitwise_count(points ^ v)
            mid = int(np.median(d))
            near = int((np.abs(d.astype(int) - mid) <= radius).sum())
            if best is None or near < best[0]:
                best = (near, v, mid, d)
        _, v, mid, d = best
        inner, outer = points[d <= mid], points[d > mid]
        if not len(inner) or not len(outer):
            count[0] += 1
            return count[0] - 1
        left = max(1, round(parts * len(inner) / len(points)))
        return (int(v), mid, grow(inner, left), grow(outer, max(1, parts - left)))

    return grow(sample, leaves)


def _route(tree, fps, radius: int):
    """(index, leaf, home): where each fingerprint lives, and every leaf whose region its ball of the radius meets."""
    import numpy as np

    todo, out = [(tree, np.arange(len(fps)), np.ones(len(fps), bool))], []
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, tuple):
            out.append((at, np.full(len(at), node, np.int32), home))
            continue
        v, mid, inner, outer = node
        d = np.bitwise_count(fps[at] ^ np.uint64(v)).astype(np.int64)
        # Triangle bounds: something within the radius can lie across the boundary only if the distance to it is small.
        todo.append((inner, at[d <= mid + radius], (home & (d <= mid))[d <= mid + radius]))
        todo.append((outer, at[d > mid - radius], (home & (d > mid))[d > mid - radius]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, int),) * 3


def _deal(leaf, home, fps, parts):
    """(row, cell, probe): the cells that routed fingerprints go to.

    A shard's probes are dealt into parts by a hash, each with a copy of the shard's members: a cell is a part of a shard.  Members
    are rows at home; a row is a probe in one cell only.
    """
    import numpy as np

    own = ((fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts[leaf]
    times = np.where(home, parts[leaf], 1)
    row = np.repeat(np.arange(len(leaf)), times)
    part = np.where(home[row], np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times), own[row])
    first = np.cumsum(parts) - parts
    return row, (first[leaf][row] + part).astype(np.int32), part == own[row]


def _pairs_within(members, probes, radius: int, leaf: int = 256):
    """Yields (member index, probe index) arrays of pairs within the radius, by a vantage-point tree over the members."""
    import numpy as np

    todo = [(np.arange(len(members)), np.arange(len(probes)))]
    while todo:
        m, p = todo.pop()
        if not len(m) or not len(p):
            continue
        if len(m) > leaf:
            best = None
            for v in members[m[:: max(1, len(m) // 5)][:5]]:
                d = np.bitwise_count(members[m] ^ v)
                mid = int(np.median(d))
                near = int((np.abs(d.astype(int) - mid) <= radius).sum())
                if best is None or near < best[0]:
                    best = (near, v, mid, d)
            _, v, mid, d = best
            if (d <= mid).any() and (d > mid).any():
                e = np.bitwise_count(probes[p] ^ v).astype(np.int64)
                todo += [(m[d <= mid], p[e <= mid + radius]), (m[d > mid], p[e > mid - radius])]
                continue
        for i in range(0, len(p), 4096):
            block = p[i : i + 4096]
            a, b = np.nonzero(np.bitwise_count(members[m][:, None] ^ probes[block][None, :]) <= radius)
            yield m[a], block[b]


def link_fingerprints(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a long, b long) between nodes whose fingerprints differ in at most radius bits; prints: (node long, fp long), one row for each distinct fp.

    The edges are a spanning forest of each cell's links, so their number stays below the number of replicas; components over
    them are those over all links.  Distinct fingerprints within a radius of one are bounded in number, so copies cannot make a
    group large.  Every fingerprint goes to the shard where it lives, and to those that its ball of the radius meets.  Shards
    are as large as a task holds, since replicas grow with their number; what is looked up in a shard is dealt over tasks.
    """
    import numpy as np

    spark = prints.sparkSession
    n = prints.count()
    shards = max(1, -(-n // SHARD_ROWS), min(SHARDS, -(-n // SMALL_SHARD)))
    sample = [r.fp for r in prints.orderBy(F.xxhash64("fp")).limit(max(TREE_SAMPLE, SHARD_SAMPLE * shards)).select("fp").collect()]
    sample = np.array(sample, "<i8").view("<u8")
    tree = grow_tree(sample, shards, radius)
    # Rows that each shard gets, from those that it gets of the sample.
    rows = np.bincount(_route(tree, sample, radius)[1].astype(np.int64), minlength=1) * (n / max(1, len(sample)))
    parts = np.maximum(1, np.ceil(rows / SHARD_ROWS)).astype(np.int64)
    held = spark.sparkContext.broadcast((tree, parts))

    def route(batches):
        import pyarrow as pa

        tree, parts = held.value
        for b in batches:
            fps = b.column(1).to_numpy(zero_copy_only=False).view("<u8")
            at, leaf, home = _route(tree, fps, radius)
            row, cell, probe = _deal(leaf, home, fps[at], parts)
            take = pa.array(at[row])
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(home[row], pa.bool_()), pa.array(probe, pa.bool_()), b.column(0).take(take), b.column(1).take(take)], names=["cell", "home", "probe", "node", "fp"])

    def search(t):
        import pyarrow as pa

        home, probe = (np.nonzero(t.column(c).to_numpy(zero_copy_only=False).astype(bool))[0] for c in ("home", "probe"))
        fps = t.column("fp").to_numpy().view("<u8")
        nodes = t.column("node").to_numpy()
        label, found = np.arange(len(fps)), []
        for m, p in _pairs_within(fps[home], fps[probe], radius):
            a, b = home[m], probe[p]
            found.append((a[a != b], b[a != b]))
            if sum(len(a) for a, _ in found) > len(fps):  # joined in batches: each costs a pass over the labels
                star_edges(*map(np.concatenate, zip(*found, strict=True)), label)
                found = []
        if found:
            star_edges(*map(np.concatenate, zip(*found, strict=True)), label)
        more = np.nonzero(label != np.arange(len(fps)))[0]
        return pa.table({"a": pa.array(nodes[more], pa.int64()), "b": pa.array(nodes[label[more]], pa.int64())})

    cells = int(parts.sum())
    dealt = prints.select("node", "fp").mapInArrow(route, "cell int, home boolean, probe boolean, node long, fp long")
    # So many partitions: adaptive execution would put cells, of few bytes but much work, into few tasks.
    return dealt.repartition(max(cells, min(2 * cells, 128)), "cell").groupBy("cell").applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id long, fingerprint string of 16 hex digits, component_id long) for each row of docs.

    Documents link if their fingerprints differ in at most radius bits; component_id is the smallest doc_id that links reach.
    Repeated rows give repeated rows.  A null doc_id keeps its fingerprint and gets a null component_id unless others share its
    fingerprint; it joins nothing.  An empty table gives none.  Other columns, whatever their names, are not read.
    Components that need more than 40 rounds raise an error.
    """
    prints = durable(fingerprints(docs, id_col, text_col, words))
    classes = durable(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")))
    parts = connected_components(durable(link_fingerprints(classes, radius)))
    named = classes.join(parts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(F.col("fp").alias("f"), F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, F.col("fp") == F.col("f"), "left").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of docs without near duplicates: of each component the row with the smallest id (of those the text with the least hash), once.

    Rows are told apart by id and text, so of rows that share an id each text counts by itself; rows with a null id stay; an
    empty table gives none.  Columns of any names are kept.
    """
    id_, key = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))
    numbered = docs.select(id_.alias("doc_id"), key.alias("text_key"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    prints = durable(numbered.select("doc_id", "text_key", "text").mapInArrow(_with_key(words), "doc_id long, text_key long, fp long"))
    # Nodes are fingerprints: a component has a name, and its first row is found among all its fingerprints.
    classes = durable(prints.groupBy("fp").agg(F.min(F.struct("doc_id", "text_key")).alias("rep")).withColumn("node", F.col("fp")))
    parts = connected_components(durable(link_fingerprints(classes, radius)))
    named = classes.join(parts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("fp", "rep", F.coalesce("component", "node").alias("c"))
    firsts = named.groupBy(F.col("c").alias("fc")).agg(F.min("rep").alias("first"))
    named = named.join(firsts, F.col("c") == F.col("fc")).select(F.col("fp").alias("f"), "first")
    return keep_firsts(docs, prints.join(named, F.col("fp") == F.col("f")).select("doc_id", "text_key", "first"), id_col, text_col)


def _with_key(words: int):
    def score(batches):
        import numpy as np
        import pyarrow as pa

        for b in slices(batches):
            fp = np.array([fingerprint_of(shingle_hashes(t.as_py(), words)) for t in b.column(2)], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "text_key", "fp"])

    return score


def keep_firsts(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs without the rows that are not the first of their group, and with repeated rows once.

    rows: (doc_id, text_key, first struct<doc_id, text_key>) for each row of docs with an id.  What goes is joined to docs, not what
    stays: while that is short it is broadcast and no text is shuffled, else both sides are dealt by id and text.
    """
    once = durable(rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.first("first").alias("first")).withColumn("stays", F.struct("doc_id", "text_key") == F.col("first")).where("n > 1 or not stays"))
    gone, again, key = fresh(docs, "gone_id", "again_id", "text_key")
    k1, k2 = fresh(docs, "gone_key", "again_key")
    slim = lambda which, i, k: once.where(which).select(F.col("doc_id").alias(i), F.col("text_key").alias(k))
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col).cast("string")))
    id_ = F.col(id_col).cast("long")
    small = once.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else lambda df: df
    left = keyed.join(hint(slim("not stays", gone, k1)), (id_ == F.col(gone)) & (F.col(key) == F.col(k1)), "left_anti")
    twice = hint(slim("stays", again, k2))
    same = (id_ == F.col(again)) & (F.col(key) == F.col(k2))
    return left.join(twice, same, "left_anti").unionByName(left.join(twice, same, "left_semi").dropDuplicates([id_col, key])).drop(key)
