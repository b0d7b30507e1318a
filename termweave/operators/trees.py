"""Hierarchies of dotted codes, as C04.588.33: depths, common ancestors, and joins of codes with their ancestors by intervals.

A code's descendants are the codes between `code.` and `code/` in byte order, as the slash follows the full stop there.  So a
hierarchy is a set of intervals that nest, and what lies below a node is found by order alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import steps


def segments(code: Column) -> Column:
    return F.split(code, "[.]")


def depth(code: Column) -> Column:
    """How many segments a code has; 0 for null or empty."""
    return F.when(F.length(code) > 0, F.size(segments(code))).otherwise(F.lit(0))


def low(code: Column) -> Column:
    """A code and all below it lie from here ..."""
    return F.concat(code, F.lit("."))


def high(code: Column) -> Column:
    """... to before here, each with a full stop after it."""
    return F.concat(code, F.lit("/"))


def is_below(code: Column, node: Column) -> Column:
    """Whether code is node or a descendant of it."""
    return (low(code) >= low(node)) & (low(code) < high(node))


def ancestors(code: Column) -> Column:
    """All nodes above a code, from the root down, without itself."""
    s = segments(code)
    return F.when(F.size(s) > 1, F.transform(F.sequence(F.lit(1), F.size(s) - 1), lambda n: F.array_join(F.slice(s, 1, n), "."))).otherwise(F.array().cast("array<string>"))


def common_ancestor(codes: Column) -> Column:
    """The deepest node that is, or is above, every code of an array; '' where they share none, null for an empty array or a null one.

    Codes that lie furthest apart in byte order of their segments share the least, so two of them decide for all.
    """
    known = F.filter(codes, lambda c: c.isNotNull())
    cut = F.transform(known, segments)

    def shared(a: Column, b: Column) -> Column:
        same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
        n = F.array_position(same, F.lit(False)).cast("int")
        return F.slice(a, 1, F.when(n > 0, n - 1).otherwise(F.size(a)))

    return F.when(F.size(known) > 0, F.array_join(shared(F.array_min(cut), F.array_max(cut)), "."))


def deepest(codes: Column) -> Column:
    """The deepest of an array of codes, the first in order among equals; null for none."""
    return F.get(F.array_sort(F.transform(F.filter(codes, lambda c: c.isNotNull()), lambda c: F.struct((-depth(c)).alias("d"), c.alias("c")))), F.lit(0))["c"]


def nearest_node(rows: DataFrame, code: str, nodes: DataFrame, node: str = "node", proper: bool = True, name: str = "nearest", partitions: int | None = None) -> DataFrame:
    """rows with `name`, the deepest of `nodes` above their code (or equal to it, unless `proper`); null where there is none.

    A join by range without a cross product: codes and nodes are sorted together in ranges of bytes, and the nodes that are open at
    a place are, for each depth, the last one before it there, if it still holds the code.  What is open at the end of a range is
    carried to the next ones as a row for each range and depth.  A code shared by very many rows is spread over ranges, as rows are
    dealt by a hash of theirs within equal codes.  Depths that nodes have are few: they are read first, and more than 64 raise an
    error.  Repeated nodes count once; null and empty codes have no nearest node, and null and empty nodes hold none.
    """
    spark = rows.sparkSession
    n = nodes.where(F.length(node) > 0).select(F.col(node).alias("__code")).distinct()
    depths = sorted(r[0] for r in n.select(depth(F.col("__code")).alias("d")).distinct().limit(65).collect())
    if len(depths) > 64:
        raise ValueError("nodes have more than 64 different depths")
    if not depths:
        return rows.withColumn(name, F.lit(None).cast("string"))
    payload = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    below = rows.select(F.col(code).alias("__code"), F.coalesce(low(F.col(code)), F.lit("")).alias("__key"), F.lit(1).alias("__kind"), F.xxhash64(payload).alias("__salt"), payload.alias("__row"))
    marks = n.select("__code", low(F.col("__code")).alias("__key"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__salt"), F.lit(None).cast(below.schema["__row"].dataType).alias("__row"))
    # A node comes before equal codes; where only nodes above count, after them.
    order = ["__key", F.desc("__kind") if proper else F.asc("__kind"), "__salt"]
    both = below.unionByName(marks)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = steps.written(both.repartitionByRange(count, *[F.col(o) if isinstance(o, str) else o for o in order]).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = lambda d: F.when((F.col("__kind") == 0) & (depth(F.col("__code")) == d), F.col("__code"))
    ends = x.where("__kind = 0").groupBy("__part").agg(*[F.max_by(at(d), F.when(at(d).isNotNull(), F.col("__key"))).alias(f"__e{d}") for d in depths])
    everywhere = x.select("__part").distinct().join(ends, "__part", "left")
    # A row a range.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = everywhere.select(F.col("__part").alias("__p"), *[F.last(f"__e{d}", ignorenulls=True).over(before).alias(f"__c{d}") for d in depths])
    x = x.select("*", *[F.last(at(d), ignorenulls=True).over(inside).alias(f"__o{d}") for d in depths]).where("__kind = 1")
    x = x.join(F.broadcast(carried), F.col("__part") == F.col("__p"))
    held = [F.coalesce(f"__o{d}", f"__c{d}") for d in depths]
    fits = lambda c: F.when(F.col("__key").startswith(F.concat(c, F.lit("."))) & (F.lit(not proper) | (c != F.col("__code"))), c)
    return x.select("__row.*", F.coalesce(*[fits(c) for c in reversed(held)]).alias(name))


def specificity(mapped: DataFrame, codes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, codes, deepest, specificity, common): of each group of concepts, the codes that they have in order, the deepest, its
    depth, and the nearest node above all.

    mapped: (keys, cui), codes: (cui, code).  Groups whose concepts have no code have specificity 0 and nulls; null codes are none.
    """
    known = codes.where(F.length("code") > 0).select(F.col("cui").alias("__cui"), "code").distinct()
    x = mapped.select(*keys, "cui").distinct().join(known, F.col("cui") == F.col("__cui"), "left")
    x = x.groupBy(*keys).agg(F.array_sort(F.collect_set("code")).alias("codes"))
    x = x.select(*keys, "codes", deepest(F.col("codes")).alias("deepest"), common_ancestor(F.col("codes")).alias("common"))
    return x.select(*keys, "codes", "deepest", depth(F.col("deepest")).alias("specificity"), "common")


def phrase_specificity(u: DataFrame, codes: DataFrame) -> DataFrame:
    """(doc_id, utt_no, label, no, value): `label|text|confidence|specificity|words|characters` for each phrase of annotated utterances.

    Confidence is the first mapping's score, specificity the depth of the deepest code of any mapped concept, 0 without one; words
    are what blanks separate.
    """
    from .annotations import KEYS, phrases

    ph = phrases(u)
    concepts = ph.select(*KEYS, "no", F.explode(F.flatten(F.transform("mappings", lambda m: F.transform(m["evs"], lambda e: e["cui"])))).alias("cui"))
    by = specificity(concepts, codes, (*KEYS, "no")).select(*[F.col(k).alias(f"__{k}") for k in (*KEYS, "no")], "specificity")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in (*KEYS, "no")])
    x = ph.join(by, same, "left")
    confidence = F.coalesce(-F.get("mappings", F.lit(0))["neg_score"], F.lit(0))
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    return x.select(*KEYS, "no", F.concat_ws("|", "label", "text", confidence, F.coalesce("specificity", F.lit(0)), words, F.length("text")).alias("value"))
