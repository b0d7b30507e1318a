"""Near-duplicate embeddings: cells by spherical k-means, cosines within cells in blocks, one representative per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .components import connected_components, star_edges
from .vectors import matrix, unit, usable

#: Vectors that k-means is fitted on, vectors to a cell on average, cells at most, a cell's own vectors to a block, and its guests to a block.
FIT_SAMPLE, CELL_ROWS, MOST_CELLS, BLOCK_ROWS, GUEST_ROWS = 20_000, 4_096, 2_048, 8_192, 16_384
#: Bytes of a block's vectors in double precision at most, for long vectors.
BLOCK_BYTES = 64 << 20
#: Cosines that a task holds at once, and directions that are compared first.
MOST_COSINES, NARROW = 2_000_000, 16
#: By more than this no two ways to take a cosine of unit vectors differ.
ROUNDING = 1e-12


def spherical_kmeans(x, k: int, rounds: int = 8):
    """k unit centres of unit vectors x, by cosine; starts from spread-out rows, an empty cell keeps its centre."""
    import numpy as np

    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return centres


def narrow_frame(dim: int, k: int = NARROW):
    """k orthonormal directions: distances along them never exceed those of whole vectors."""
    import numpy as np

    return np.linalg.qr(np.random.default_rng(5).standard_normal((dim, min(k, dim))))[0]


def linked(x, left, right, threshold: float, frame, tile: int | None = None):
    """Yields (a, b): index arrays of pairs of rows of left and right (numbers of rows of the unit vectors x) whose cosine is at least the threshold.

    Pairs that are too far apart along a few directions are dropped first, exactly; of what remains, cosines in double precision
    are taken pair by pair, or by one product where much remains.  Products within rounding errors of the threshold are taken
    again pair by pair, so that which way a pair went does not matter.
    """
    import numpy as np

    y = (x @ frame).astype(np.float32)
    square = (y * y).sum(1)
    apart = np.float32(2 - 2 * threshold + 1e-4)
    step = max(1, (tile or MOST_COSINES) // max(1, len(right)))
    for i in range(0, len(left), step):
        part = left[i : i + step]
        near = square[part][:, None] + square[right][None] - 2 * (y[part] @ y[right].T) <= apart
        if np.count_nonzero(near) > near.size // 16:
            c = x[part] @ x[right].T
            a, b = np.nonzero(c >= threshold - ROUNDING)
            close = np.nonzero(c[a, b] < threshold + ROUNDING)[0]
            keep = np.ones(len(a), bool)
            a, b = part[a], right[b]
            keep[close] = np.einsum("ij,ij->i", x[a[close]], x[b[close]]) >= threshold
            yield a[keep], b[keep]
            continue
        a, b = np.nonzero(near)
        a, b = part[a], right[b]
        exact = np.concatenate([np.einsum("ij,ij->i", x[a[j : j + 100_000]], x[b[j : j + 100_000]]) for j in range(0, len(a), 100_000)]) if len(a) else np.empty(0)
        yield a[exact >= threshold], b[exact >= threshold]


def _compare(key, t, threshold: float, item: str):
    """A task's two blocks of a cell: counts of links, and edges enough for their components."""
    import numpy as np
    import pyarrow as pa

    cell, lo, hi = (k.as_py() for k in key)
    n = t.num_rows
    x = unit(np.frombuffer(b"".join(t.column("x").to_pylist()), item).reshape(n, -1).astype(np.float64))
    home, block, times, reps = (t.column(c).to_numpy() for c in ("home", "block", "times", "rep"))
    seen = t.column("visits").to_pylist()
    # Sorted: a row's number, then the cells it visits.
    visits = np.repeat(np.arange(n) << 32, [len(v) // 4 for v in seen]) + np.frombuffer(b"".join(seen), np.int32)
    count, label = np.zeros(n, np.int64), np.arange(n)
    left, right = np.nonzero(block == lo)[0], np.nonzero(block == hi)[0]
    for a, b in linked(x, left, right, threshold, narrow_frame(x.shape[1])):
        if lo == hi:
            a, b = a[a < b], b[a < b]
        # A pair that meets in both homes counts in the lower one.
        here, other = np.where(home[a] == cell, a, b), np.where(home[a] == cell, home[b], home[a])
        pair = (here << 32) + other
        met = visits[np.minimum(np.searchsorted(visits, pair), len(visits) - 1)] == pair if len(pair) else np.empty(0, bool)
        a, b = a[(other >= cell) | ~met], b[(other >= cell) | ~met]
        count += np.bincount(a, times[b], n).astype(np.int64) + np.bincount(b, times[a], n).astype(np.int64)
        star_edges(a, b, label)
    some, more = np.nonzero(count)[0], np.nonzero(label != np.arange(n))[0]
    none = lambda k: [None] * k
    k1, k2 = (t.column(c).to_numpy()[some].tolist() for c in ("k1", "k2"))
    return pa.table({
        "k1": pa.array(k1 + none(len(more)), pa.int64()), "k2": pa.array(k2 + none(len(more)), pa.int64()), "n": pa.array(count[some].tolist() + none(len(more)), pa.int64()),
        "a": pa.array(none(len(some)) + reps[more].tolist(), pa.int64()), "b": pa.array(none(len(some)) + reps[label[more]].tolist(), pa.int64()),
    })


def _links(reps: DataFrame, threshold: float, item: str) -> DataFrame:
    """(k1, k2, n) and (a, b) for distinct vectors (k1, k2, rep, times, v) of one length: counts of links, and edges between their reps."""
    import numpy as np

    spark, n = reps.sparkSession, reps.count()
    sample = reps.orderBy("k1", "k2").limit(FIT_SAMPLE).select("v").collect()
    centres = spark.sparkContext.broadcast(spherical_kmeans(unit(np.array([r.v for r in sample])), max(1, min(MOST_CELLS, len(sample), n // CELL_ROWS))))
    angle = float(np.arccos(np.clip(threshold, -1.0, 1.0)))
    reach = np.sin(angle / 2) + 1e-7

    def farthest(batches):
        import pyarrow as pa

        for b in batches:
            near = unit(matrix(b.column(0))) @ centres.value.T if b.num_rows else np.empty((0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(near.argmax(1).astype(np.int32)), pa.array(near.max(1, initial=-1.0))], names=["home", "cos"])

    # One row a cell: the angle from its centre within which all its own vectors lie.
    radius = np.full(len(centres.value), -1.0)
    for r in reps.select("v").mapInArrow(farthest, "home int, cos double").groupBy("home").agg(F.min("cos").alias("cos")).collect():
        radius[r.home] = np.arccos(min(1.0, max(-1.0, r.cos))) + 1e-6

    def assign(batches):
        import pyarrow as pa

        c = centres.value
        square = (c * c).sum(1)
        apart = np.sqrt(np.maximum(square[:, None] + square - 2 * c @ c.T, 0))
        for b in batches:
            raw = matrix(b.column(4))
            x = unit(raw) if len(raw) else raw
            near = x @ c.T if len(x) else np.empty((0, len(c)))
            home = near.argmax(1)
            # (own - other) / apart is the sine of the angle to the border between two cells; and a cell's own vectors lie within its radius.
            go = near[np.arange(len(x)), home][:, None] - near <= reach * apart[home] + 1e-9
            go &= np.arccos(np.clip(near, -1, 1)) - radius[None] <= angle + 1e-6
            go[np.arange(len(x)), home] = True
            at, cell = np.nonzero(go)
            visits = [v.astype(np.int32).tobytes() for v in np.split(cell, np.cumsum(np.bincount(at, minlength=len(x)))[:-1])]
            take = pa.array(at)
            out = [pa.array(cell, pa.int32()), pa.array(home[at], pa.int32()), *[b.column(k).take(take) for k in range(4)], pa.array(visits, pa.binary()).take(take), pa.array([r.tobytes() for r in raw.astype(item)], pa.binary()).take(take)]
            yield pa.RecordBatch.from_arrays(out, names=["cell", "home", "k1", "k2", "rep", "times", "visits", "x"])

    placed = durable(reps.select("k1", "k2", "rep", "times", "v").mapInArrow(assign, "cell int, home int, k1 long, k2 long, rep long, times long, visits binary, x binary"))
    at_home = F.col("home") == F.col("cell")
    # One row a cell, at most MOST_CELLS.  Blocks of its own vectors come first, then blocks of guests, which are compared with the former only.
    rows = lambda most: max(1, min(most, BLOCK_BYTES // (8 * centres.value.shape[1])))
    blocks = placed.groupBy(F.col("cell").alias("bcell")).agg(F.ceil(F.count_if(at_home) / rows(BLOCK_ROWS)).alias("homes"), F.ceil(F.count_if(~at_home) / rows(GUEST_ROWS)).alias("guests")).where("homes > 0")
    h = F.xxhash64("k1", "k2")
    own = placed.join(F.broadcast(blocks), F.col("cell") == F.col("bcell")).withColumn("block", F.when(at_home, F.pmod(h, F.col("homes"))).otherwise(F.col("homes") + F.pmod(h, F.greatest("guests", F.lit(1)))))
    dealt = own.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1 + F.when(at_home, F.col("guests")).otherwise(0)))).withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with"))
    return durable(dealt.select("cell", "lo", "hi", "home", "block", "k1", "k2", "rep", "times", "visits", "x").groupBy("cell", "lo", "hi").applyInArrow(lambda key, t: _compare(key, t, threshold, item), LINKS))


LINKS = "k1 long, k2 long, n long, a long, b long"


def near_duplicate_vectors(frame: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of frame.

    Vectors of one length link if their cosine in double precision is at least the threshold.  Each lives in the cell of its nearest
    centre and visits every cell whose border is within half the threshold's angle and whose radius reaches it: of two linked
    vectors with different homes one is that near to the border between them, so it visits the other's home, and no link is lost
    whatever the centres.  Equal vectors are compared once and count as often as they occur.  A cell of any size is compared
    block against block: a task holds two blocks, and returns counts and edges enough for the components, never all pairs.
    Vectors that are null, zero, or hold null or non-finite components link with nothing; so does a row with a null id, which is
    kept.  Rows that share an id but not a vector have each its own links and are one node of the components.  Empty tables give
    none.  Other columns are not read.  Components that need more than 40 rounds raise an error.
    """
    spark = frame.sparkSession
    item = "<f4" if dict(frame.dtypes)[vec_col] == "array<float>" else "<f8"  # so vectors move as they are stored
    # Two hashes of the components, 128 bits, name a vector.
    rows = durable(usable(frame, id_col, vec_col).withColumn("k1", F.when(F.col("ok"), F.xxhash64("v"))).withColumn("k2", F.when(F.col("ok"), F.xxhash64(F.lit(77), "v"))))
    reps = durable(rows.where("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times"), F.first("v").alias("v")))
    lengths = [r.d for r in reps.select(F.size("v").alias("d")).distinct().orderBy("d").collect()]  # one, unless the table is ragged
    found = reduce(DataFrame.unionByName, [_links(reps.where(F.size("v") == d), threshold, item) for d in lengths], spark.createDataFrame([], LINKS))
    links = found.where("k1 is not null").groupBy(F.col("k1").alias("l1"), F.col("k2").alias("l2")).agg(F.sum("n").alias("n"))
    # Rows that share an id are one node, so a rep stands for its id in the components.
    of = durable(reps.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), "rep", "times").join(links, (F.col("r1") == F.col("l1")) & (F.col("r2") == F.col("l2")), "left").select("r1", "r2", "rep", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links")))
    known = rows.select("vec_id", "k1", "k2", "ok").join(of, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")), "left")
    ids = known.where("ok and vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    parts = connected_components(found.where("a is not null").select("a", "b").unionByName(ids))
    out = known.join(parts, (F.col("vec_id") == F.col("node")) & F.col("ok"), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
