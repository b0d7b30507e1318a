"""Ball k-means on integer vectors: clusters are balls, and a member is compared only with the centroids that its annulus can reach."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, shared_dir

DIM, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Components and clusters beyond these are refused: squared distances would not fit 64 bits, and a table of all pairs of centroids not a task.
MOST_COMPONENT, MOST_CLUSTERS = 1 << 27, 4096
#: Rows taken at once.
ROWS = 8192


def kept_vectors(frame: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id long, q array<long>) of vectors with exactly dim components, none null or non-finite; q is floor(scale * component)."""
    x = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    x = x.where((F.size("v") == dim) & fine)
    small = F.forall("v", lambda c: F.abs(c * scale) < MOST_COMPONENT)
    q = F.when(small, F.transform("v", lambda c: F.floor(c * scale))).otherwise(F.raise_error(F.lit(f"a component times {scale} reaches {MOST_COMPONENT}")).cast("array<long>"))
    return x.select("vec_id", q.alias("q"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest sha256 of `seed:vec_id`, in that order; rows that share an id by their components, null ids never."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.where("vec_id IS NOT NULL").select("q", digest.alias("h")).orderBy("h", "q").limit(clusters).collect()
    return [list(r.q) for r in rows]


def products(x, c):
    """x @ c.T exactly, for integers: by doubles where all sums stay below 2**53."""
    import numpy as np

    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if x.shape[1] * top * top < 1 << 53:
        return (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x @ c.T


def squared(x, c):
    """Squared distances of all rows of x from all rows of c."""
    return (x * x).sum(1)[:, None] - 2 * products(x, c) + (c * c).sum(1)[None]


def nearest(x, c):
    """For a first assignment: each row's nearest centroid, the smaller number among equals, and its squared distance."""
    import numpy as np

    d = squared(x, c)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def reassign(x, before, c, apart, order):
    """Each row's nearest centroid, given its cluster before; apart: squared distances of centroids, order: by it, themselves first.

    All bounds are in squares of integers, so they are exact.  A member at d from its own centroid cannot be nearer to one at more
    than 2 d from that (at exactly 2 d it may tie).  The neighbours of a ball are the centroids within twice its radius; members
    before the first such border are the stable core, and one in the annulus between the borders of neighbours m and m + 1 is
    compared with the nearest m alone.  Radii are those of the rows given, which are never larger than a whole cluster's.
    Returns (cluster, squared distance, number of distances computed besides those from a row's own centroid).
    """
    import numpy as np

    own = ((x - c[before]) ** 2).sum(1)
    best, at, looked = own.copy(), before.copy(), 0
    by = np.argsort(before, kind="stable")
    bounds = np.searchsorted(before[by], np.arange(len(c) + 1))
    for i in np.flatnonzero(np.diff(bounds)):
        rows = by[bounds[i] : bounds[i + 1]]
        reach = 4 * own[rows]
        others = order[i][order[i] != i]
        borders = apart[i, others]
        # How many neighbours each member's annulus reaches: all whose border is not beyond it.
        m = np.searchsorted(borders, reach, side="right")
        active = np.flatnonzero(m)
        if not len(active):
            continue  # the stable core alone
        active = active[np.argsort(-m[active], kind="stable")]
        left = m[active]
        for t in range(int(left[0])):
            sub = rows[active[: int(np.searchsorted(-left, -t, side="left"))]]  # members that reach more than t neighbours
            j = int(others[t])
            d = ((x[sub] - c[j]) ** 2).sum(1)
            looked += len(sub)
            better = (d < best[sub]) | ((d == best[sub]) & (j < at[sub]))
            best[sub[better]], at[sub[better]] = d[better], j
    return at, best, looked


def _pass(vectors: DataFrame, centroids: list[list[int]], first: bool) -> DataFrame:
    """One assignment of all rows where they lie.  Rows of two kinds: (vec_id, q, cluster, distance), and each task's sums
    (cluster, n, sums, inertia, looked) with n not null, at most one for each cluster."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        c = np.array(centroids, np.int64)
        apart = squared(c, c)
        order = np.argsort(apart, axis=1, kind="stable")
        n, sums, inertia, looked = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64), 0
        names = ["vec_id", "q", "cluster", "distance", "n", "sums", "inertia", "looked"]
        long, lists = pa.int64(), pa.list_(pa.int64())
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, c.shape[1])
                if first:
                    at, d = nearest(x, c)
                    looked += len(x) * len(c)
                else:
                    at, d, more = reassign(x, part.column(2).to_numpy(zero_copy_only=False).astype(np.int64), c, apart, order)
                    looked += more + len(x)
                by = np.argsort(at, kind="stable")
                seen, starts = np.unique(at[by], return_index=True)
                sums[seen] += np.add.reduceat(x[by], starts, axis=0)
                n += np.bincount(at, minlength=len(c))
                inertia[seen] += np.add.reduceat(d[by], starts)
                k, none = part.num_rows, lambda kind, k=part.num_rows: pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(at.astype(np.int32)), pa.array(d), none(long), none(lists), none(long), none(long)], names=names)
        some = np.flatnonzero(n)
        if len(some):
            k, each = len(some), np.zeros(len(some), np.int64)
            each[0] = looked
            yield pa.RecordBatch.from_arrays([pa.nulls(k, long), pa.nulls(k, lists), pa.array(some.astype(np.int32)), pa.nulls(k, long), pa.array(n[some]), pa.array(list(sums[some]), lists), pa.array(inertia[some]), pa.array(each)], names=names)

    return vectors.mapInArrow(run, "vec_id long, q array<long>, cluster int, distance long, n long, sums array<long>, inertia long, looked long")


def _summed(rows: DataFrame, dim: int) -> list:
    """Each cluster's (cluster, n, inertia, looked, sums), from the tasks' sums alone: other columns of the table are not read."""
    sums = [F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dim)]
    return rows.where("n IS NOT NULL").groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), F.sum("looked").alias("looked"), *sums).collect()


def assign(frame: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, id_col: str = "vec_id", vec_col: str = "embedding", told: list | None = None) -> DataFrame:
    """(vec_id, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256) for every vector that is kept.

    Distances are squared and exact; equal ones go to the smaller cluster.  Vectors of another length, or with null or non-finite
    components, are left out; zero vectors, repeated rows and rows without an id count as any other, but null ids are never first
    centroids.  Fewer vectors than clusters give as many clusters as there are vectors; none, or an empty table, no rows.  Components
    that would overflow raise an error.  Other columns are not read.  Each pass reads what the last one wrote to the checkpoint
    folder, changes rows where they lie, and shuffles a row for each task and cluster; the driver gets a row a cluster.  told: a list
    that gets, for each pass, the number of distances computed.
    """
    if not 0 < clusters <= MOST_CLUSTERS:
        raise ValueError(f"1 to {MOST_CLUSTERS} clusters")
    spark, vectors = frame.sparkSession, kept_vectors(frame, dim, scale, id_col, vec_col)
    centroids = first_centroids(vectors, clusters, seed)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    root, before, state = shared_dir(spark), None, vectors
    for k in range(rounds + 1):
        path = f"{root}/{k}"
        _pass(state, centroids, k == 0).write.option("compression", "zstd").parquet(path)
        rows = spark.read.parquet(path)
        by = _summed(rows, dim)
        if told is not None:
            told.append(sum(r.looked for r in by))
        if k < rounds:
            for r in by:
                centroids[r.cluster] = [r[f"s{j}"] // r.n for j in range(dim)]
        state = rows.where("n IS NULL").select("vec_id", "q", "cluster")
        if before:
            remove(spark, before)
        before = path
    return _result(spark, rows, by, centroids)


def _result(spark: SparkSession, rows: DataFrame, by: list, centroids: list[list[int]]) -> DataFrame:
    total = sum(r.inertia for r in by)
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    known = spark.createDataFrame([(r.cluster, r.inertia, total, sha(centroids[r.cluster])) for r in by], "k int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = rows.where("n IS NULL").select("vec_id", "cluster", "distance")
    # A row a cluster, of which there are MOST_CLUSTERS at most.
    return out.join(F.broadcast(known), F.col("cluster") == F.col("k")).drop("k")


def _sql() -> str:
    near = lambda k: f"""
a{k} AS (SELECT row_no, vec_id, q, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
  SELECT row_no, vec_id, q, c.cluster, list_sum(list_transform(list_zip(q, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{k} c) GROUP BY row_no, vec_id, q)"""  # noqa: E731
    # floor(sum / count) in integers
    moved = lambda k: f"""
m{k} AS (SELECT cluster, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range({DIM})) AS j FROM a{k}) GROUP BY cluster, j),
n{k} AS (SELECT cluster, list((s - (((s % n) + n) % n)) // n ORDER BY j) AS c FROM m{k} GROUP BY cluster),
c{k + 1} AS (SELECT c{k}.cluster, coalesce(n{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN n{k} USING (cluster))"""  # noqa: E731
    return f"""WITH kept AS (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
c0 AS (SELECT (row_number() OVER (ORDER BY h, q) - 1)::INT AS cluster, q AS c FROM (SELECT sha256('{SEED}:' || vec_id) AS h, q FROM kept WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {CLUSTERS})),
{",".join(near(k) + "," + moved(k) for k in range(ROUNDS))},{near(ROUNDS)},
i AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{ROUNDS} GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia, (SELECT sum(cluster_inertia)::BIGINT FROM i) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN i USING (cluster) JOIN c{ROUNDS} USING (cluster)"""


SQL = _sql()
