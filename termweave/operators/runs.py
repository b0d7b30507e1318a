"""Runs of equal neighbours and running values over a global order, without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .steps import written

#: Order values to a block; a block is sorted in one task, and one summary row a block in another.
BLOCK = 1 << 17


def with_runs(df: DataFrame, key: str, order: str, block: int = BLOCK) -> DataFrame:
    """df with run_id: the order value of the first row of each run of neighbours with an equal key, in the order of a unique long column."""
    x = df.withColumn("__b", F.floor(F.col(order) / block))
    inside = Window.partitionBy("__b").orderBy(order)
    ends = x.groupBy("__b").agg(F.max_by(key, order).alias("__k"))
    ends = ends.select(F.col("__b").alias("__eb"), F.lag("__k").over(Window.orderBy("__b")).alias("__before"), F.lag(F.lit(1)).over(Window.orderBy("__b")).alias("__any"))
    x = x.join(ends, F.col("__b") == F.col("__eb"))
    lag, has = F.lag(key).over(inside), F.lag(F.lit(1)).over(inside)
    before = F.when(has.isNotNull(), lag).otherwise(F.col("__before"))
    any_before = has.isNotNull() | F.col("__any").isNotNull()
    x = x.withColumn("__start", F.when(~any_before | ~F.col(key).eqNullSafe(before), F.col(order)))
    starts = x.groupBy("__b").agg(F.max("__start").alias("__s")).select(F.col("__b").alias("__sb"), F.max("__s").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"))
    x = x.join(starts, F.col("__b") == F.col("__sb"))
    run = F.coalesce(F.max("__start").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.col("__carried"))
    return x.withColumn("run_id", run.cast("long")).drop("__b", "__eb", "__before", "__any", "__start", "__sb", "__carried")


def ranked(df: DataFrame, order: str, name: str = "line_no") -> DataFrame:
    """df with the number of each row, from 1, in a global order: rows are sorted in ranges, and a range's rows are numbered after those of all ranges before it."""
    x = written(df.orderBy(order).withColumn("__r", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    before = x.groupBy("__r").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"))
    before = before.select(F.col("__r").alias("__q"), "__first", (F.sum("__n").over(Window.orderBy("__r")) - F.col("__n")).alias("__before"))
    return x.join(F.broadcast(before), F.col("__r") == F.col("__q")).withColumn(name, F.col("__before") + F.col("__i") - F.col("__first") + 1).drop("__r", "__i", "__q", "__first", "__before")
