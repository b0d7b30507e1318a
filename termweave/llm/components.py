"""Connected components of a large edge list, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def star_edges(a, b, label):
    """Joins numbered nodes along edges (a, b) in place: label[i] becomes the least number that i's edges reach, over calls too.

    label starts as 0..n-1; afterwards (i, label[i]) where they differ are edges enough for the same components, at most n - 1.
    """
    import numpy as np

    while True:
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return label
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(nxt := label[label], label):
            label[:] = nxt


def _towards_least(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): links each v, and u itself, to the least of u and its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("lv")).select(F.col("u").alias("u0"), F.least("u", "lv").alias("m"))
    return pairs.join(least, pairs.u == least.u0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 40) -> DataFrame:
    """(node long, component long): the least node id reachable, for every node with an edge to another node.

    Minima of a node's edges are taken before the shuffle; then its edges, of sixteen bytes each, meet its minimum in a sort-merge
    join, whose partitions adaptive execution splits where one node has very many.  The edge list never grows.  Null ends and
    loops are ignored.  Each round is written to the checkpoint folder, so the plan stays short and lost executors cost one round.
    Rounds grow as the logarithm of the longest chain; more than `most_rounds` of them raise an error, and no result is given.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v").distinct()
    e = durable(e)
    seen = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        joined = _towards_least(large)
        small = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        e = durable(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    # Settled: every edge leads from a node to its component's least node.
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
