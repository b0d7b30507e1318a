"""An insertion-ordered store of (seq, key, property, value) facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def put(facts: DataFrame, new: DataFrame) -> DataFrame:
    """facts and new ones, whose seq must follow."""
    return facts.unionByName(new)


def get(facts: DataFrame, key=None, prop=None) -> DataFrame:
    x = facts if key is None else facts.where(F.col("key") == key)
    return x if prop is None else x.where(F.col("property") == prop)


def erase_first(facts: DataFrame, what: DataFrame) -> DataFrame:
    """facts without the first one that equals each row of what in key, property and value."""
    names = ["key", "property", "value"]
    w = what.select(*[F.col(c).alias(f"w_{c}") for c in names]).distinct()
    same = lambda: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in names])
    first = facts.join(w, same(), "left_semi").groupBy(*names).agg(F.min("seq").alias("gone")).select("gone")
    return facts.join(first, F.col("seq") == F.col("gone"), "left_anti")


def erase_all(facts: DataFrame, what: DataFrame) -> DataFrame:
    """facts without those that match a row of what in key and property."""
    w = what.select(F.col("key").alias("w_key"), F.col("property").alias("w_property")).distinct()
    return facts.join(w, F.col("key").eqNullSafe(F.col("w_key")) & F.col("property").eqNullSafe(F.col("w_property")), "left_anti")
