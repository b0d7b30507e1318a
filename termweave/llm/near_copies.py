"""Near copies by the Jaccard similarity of five-word shingles: SimHash trees and MinHash bands propose groups, exact similarities decide.

SimHash fingerprints (simhash.py) of texts that share 0.8 of their five-word shingles differ in about 10 of 64 bits, and trees cannot
prune at such a radius: they are asked for those within their radius, and bands of least hashes for the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, slices, worker_cache
from .components import connected_components
from .simhash import BROADCAST_ROWS, fingerprint_of, keep_firsts, link_fingerprints, shingle_hashes

#: Words to a shingle, and the similarity from which texts are near copies.
WORDS, SIMILARITY = 5, 0.8
#: Texts of similarity J share a band with probability 1 - (1 - J^ROWS)^BANDS: all but 6e-5 of pairs at 0.8, all but 3e-7 at 0.85.
BANDS, ROWS = 32, 6
#: Bits in which fingerprints that the trees propose differ at most.
RADIUS = 2
#: Texts and bytes that a task compares at most, about, and texts of a large group that all its others are compared with first.
BLOCK_ROWS, BLOCK_BYTES, PIVOTS = 2_000, 32 << 20, 16


def shingle_set(text: str | None, words: int = WORDS):
    """The distinct hashes of a text's shingles, sorted."""
    import numpy as np

    return np.unique(shingle_hashes(text, words))


def _band_keys(shingles, multiply, add):
    """A key for each band: a hash of the band's number and of its ROWS least values; no shingles give no keys."""
    import numpy as np
    import xxhash

    if not len(shingles):
        return []
    least = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(least, (multiply[:, None] * shingles[i : i + 1024] + add[:, None]).min(1), out=least)
    return [xxhash.xxh64_intdigest(r.tobytes(), b) for b, r in enumerate(least.reshape(BANDS, ROWS))]


def similar_forest(sets, similarity: float = SIMILARITY):
    """Edges (i, j) of a spanning forest of the links between sets whose Jaccard similarity is at least so much.

    Breadth first: each set is compared, through lists of the sets that hold a shingle, with those that no link has reached yet,
    so a group whose sets link costs little more than its size.
    """
    import numpy as np

    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    number = np.unique(flat, return_inverse=True)[1]
    owner, begin = np.repeat(np.arange(len(sets)), size), np.concatenate(([0], np.cumsum(size)))
    new = np.ones(len(sets), bool)
    listed = edges_at = holders = None
    edges = []
    for root in range(len(sets)):
        if not new[root]:
            continue
        new[root], todo = False, [root]
        while todo and new.any():
            if listed is None or 2 * new.sum() < listed:
                live = np.nonzero(new[owner])[0]
                live = live[np.argsort(number[live], kind="stable")]
                listed, holders = int(new.sum()), owner[live]
                edges_at = np.searchsorted(number[live], np.arange(int(number.max(initial=-1)) + 2))
            u = todo.pop()
            mine = number[begin[u] : begin[u + 1]]
            lists = [holders[edges_at[k] : edges_at[k + 1]] for k in mine]
            if not lists:
                continue
            shared = np.bincount(np.concatenate(lists), minlength=len(sets))
            # In whole numbers of a millionth, so that a similarity of just 0.8 counts.
            close = np.nonzero(new & (shared > 0) & (1_000_000 * shared >= round(1_000_000 * similarity) * (size + size[u] - shared)))[0]
            new[close] = False
            todo += close.tolist()
            edges += [(u, v) for v in close.tolist()]
    return edges


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, h1, h2, fp, keys, bytes) for docs (doc_id, text_key, text): h1 and h2 are a hash of 128 bits of the shingles' set, fp the SimHash, keys those of its bands."""

    def sign(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        worker_cache("near copies")  # frees what operators before remembered

        rng = np.random.default_rng(11)
        multiply, add = (rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
        for b in slices(batches):
            h1, h2, fp, keys = [], [], [], []
            for t in b.column(2):
                h = shingle_hashes(t.as_py(), WORDS)
                own = np.unique(h)
                whole = xxhash.xxh3_128_intdigest(own.tobytes(), 5)
                h1.append(whole >> 64)
                h2.append(whole & 0xFFFFFFFFFFFFFFFF)
                fp.append(fingerprint_of(h))
                keys.append(np.array(_band_keys(own, multiply, add), np.uint64).view(np.int64))
            size = pa.array([len(t.as_py() or "") for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(np.array(c, np.uint64).view(np.int64)) for c in (h1, h2, fp)], pa.array(keys, pa.list_(pa.int64())), size], names=["doc_id", "text_key", "h1", "h2", "fp", "keys", "bytes"])

    return docs.mapInArrow(sign, "doc_id long, text_key long, h1 long, h2 long, fp long, keys array<long>, bytes long")


def _verify(t):
    import pyarrow as pa

    at = {c: i for i, c in enumerate(t.column("cls").to_pylist())}
    cls, text = list(at), t.column("text")
    edges = similar_forest([shingle_set(text[i].as_py()) for i in at.values()])
    return pa.table({"a": pa.array([cls[i] for i, _ in edges], pa.int64()), "b": pa.array([cls[j] for _, j in edges], pa.int64())})


def _links(held: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges (a, b) enough for the components of the exact links within groups.

    held: (component, cls, degree, text); sizes: (component, blocks).  A group of one block is compared in one task.  A larger one is
    dealt into blocks, and each is compared within itself and with the group's pivots, the texts that share most band keys; of
    what then hangs together, the largest part needs no more comparisons within itself, and all other texts are compared with
    every block.  So no task holds more than two blocks and the pivots, no link between parts is lost, and a large group of
    copies of one text costs a few passes over it; only texts of a group that mostly do not link cost the square of their number.
    """
    h = lambda k: F.pmod(F.xxhash64("cls", F.lit(k)), F.col("blocks"))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    large = durable(sizes.where("blocks > 1"))
    compare = lambda x: durable(x.select("component", "block", "cls", "text").groupBy("component", "block").applyInArrow(lambda t: _verify(t.select(["cls", "text"])), "a long, b long"))
    own = held.join(sizes.withColumnRenamed("component", "sc"), F.col("component") == F.col("sc")).withColumn("block", h(3))
    if large.isEmpty():
        return compare(own)
    big = held.join(large.withColumnRenamed("component", "bc"), F.col("component") == F.col("bc"))
    pivots = big.join(_pivots(big), F.col("cls") == F.col("pivot"), "left_semi").withColumn("block", every("blocks"))
    first = compare(own.select("component", "block", "cls", "text").unionByName(pivots.select("component", "block", "cls", "text")))
    parts = connected_components(first).withColumnRenamed("component", "found")
    part = durable(big.select(F.col("component").alias("g"), "cls").join(parts, F.col("cls") == F.col("node"), "left").select("g", "cls", F.coalesce("found", "cls").alias("part")))
    most = part.groupBy("g", "part").agg(F.count("*").alias("n")).groupBy(F.col("g").alias("mg")).agg(F.max(F.struct("n", "part")).alias("most"))
    rest = durable(part.join(most, F.col("g") == F.col("mg")).where("part <> most.part").select("g", F.col("cls").alias("rest")))
    few = durable(rest.groupBy(F.col("g").alias("rg")).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("r_blocks")))
    if few.isEmpty():
        return first
    asked = big.join(few, F.col("component") == F.col("rg"))
    them = asked.join(rest, F.col("cls") == F.col("rest"), "left_semi").withColumn("r", F.pmod(F.xxhash64("cls", F.lit(4)), F.col("r_blocks"))).withColumn("b", every("blocks"))
    all_ = asked.withColumn("b", h(3)).withColumn("r", every("r_blocks"))
    second = them.select("component", "b", "r", "cls", "text").unionByName(all_.select("component", "b", "r", "cls", "text"))
    return first.unionByName(compare(second.withColumn("block", F.struct("b", "r"))))


def _pivots(big: DataFrame) -> DataFrame:
    """(pivot): PIVOTS texts of each large group, of each of as many parts the one with the greatest degree; nothing is sorted for it."""
    best = big.groupBy("component", F.pmod(F.xxhash64("cls", F.lit(9)), F.lit(PIVOTS)).alias("slot")).agg(F.max(F.struct("degree", "cls")).alias("top"))
    return best.select(F.col("top.cls").alias("pivot"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without near copies: of each group the row with the smallest id, once; rows with a null id stay.

    Texts whose five-word shingles, as sets, have a Jaccard similarity of at least 0.8 are linked, and groups are what links
    reach.  Texts whose fingerprints the SimHash trees find near, and texts that share a band's key, are brought together, each
    once, and linked only by exact similarity.  Texts without words (null, empty) form one group; whole texts of any length count.
    Rows are told apart by id and text: of rows that share an id each text counts.  Columns of any names are kept; an empty table
    gives none.
    """
    id_, key = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))
    texts = docs.select(id_.alias("doc_id"), key.alias("text_key"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    rows = durable(_signed(texts))
    # Texts of one set of shingles are a class; its number holds as long as the written table does.
    classes = durable(rows.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("keys").alias("keys"), F.min("fp").alias("fp"), F.max("bytes").alias("bytes")).withColumn("cls", F.monotonically_increasing_id()))
    # Fingerprints, each by its least class: equal ones are proposed, and those that the trees find within the radius.
    prints = durable(classes.groupBy("fp").agg(F.min("cls").alias("node")))
    near = link_fingerprints(prints, RADIUS).unionByName(classes.select("cls", "fp").join(prints.withColumnRenamed("fp", "f"), F.col("fp") == F.col("f")).where("cls <> node").select(F.col("cls").alias("a"), F.col("node").alias("b")))
    bands = classes.select("cls", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("cls").alias("least"), F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("k"), "least", "n")
    met = durable(bands.join(shared, F.col("key") == F.col("k")).select("cls", "least", "n"))
    groups = connected_components(near.unionByName(met.where("cls <> least").select(F.col("cls").alias("a"), F.col("least").alias("b")).distinct()))
    degrees = met.groupBy(F.col("cls").alias("mcls")).agg(F.sum("n").alias("degree"))
    maybe = groups.join(classes.select("cls", "rep", "bytes"), F.col("node") == F.col("cls")).join(degrees, F.col("cls") == F.col("mcls"), "left").select("component", "cls", F.coalesce("degree", F.lit(0)).alias("degree"), "bytes", F.col("rep.doc_id").alias("d"), F.col("rep.text_key").alias("k"))
    maybe = durable(maybe)
    sizes = maybe.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("bytes") / BLOCK_BYTES)).alias("blocks")).select("component", F.greatest("blocks", F.lit(1)).cast("long").alias("blocks"))
    # Texts of groups alone are moved; while those are few, the list of them is broadcast and all other texts stay where they are.
    maybe = F.broadcast(maybe) if maybe.count() <= BROADCAST_ROWS else maybe
    held = texts.join(maybe, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("k"))).dropDuplicates(["doc_id", "text_key"]).select("component", "cls", "degree", "text")
    parts = connected_components(_links(durable(held), durable(sizes)))
    named = classes.select("h1", "h2", "cls", "rep").join(parts, F.col("cls") == F.col("node"), "left").select("h1", "h2", "rep", F.coalesce("component", "cls").alias("c"))
    firsts = named.groupBy(F.col("c").alias("fc")).agg(F.min("rep").alias("first"))
    named = named.join(firsts, F.col("c") == F.col("fc")).select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), "first")
    return keep_firsts(docs, rows.select("doc_id", "text_key", "h1", "h2").join(named, (F.col("h1") == F.col("n1")) & (F.col("h2") == F.col("n2"))).select("doc_id", "text_key", "first"), id_col, text_col)
