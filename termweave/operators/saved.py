"""Tables that are derived once and used again while their source stays the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DONE = "_SUCCESS"


def fingerprint(source: DataFrame, *parameters) -> str:
    """Names the rows of source, whatever their order and partitions, and the parameters: two sums of hashes of rows and their number.

    One pass, summed where the rows lie.  Column names and types count; repeated rows count each.
    """
    row = [F.col(f"`{c}`") for c in source.columns]
    sums = [F.sum(F.xxhash64(*row, F.lit(seed)).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    schema = ",".join(f"{n}:{t}" for n, t in source.dtypes)
    said = F.concat_ws("|", F.lit(schema), F.lit(repr(parameters)), F.count(F.lit(1)).cast("string"), *[F.coalesce(s, F.lit("0")) for s in sums])
    return source.agg(F.sha2(said, 256).alias("f")).first().f


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def is_done(spark: SparkSession, folder: str) -> bool:
    fs, at = _fs(spark, f"{folder}/{DONE}")
    return fs.exists(at)


def reuse(source: DataFrame, folder: str, build: Callable[[DataFrame], DataFrame], *parameters) -> DataFrame:
    """build(source), read from folder if it was built there from equal rows with equal parameters before; otherwise built and kept there.

    A version lies in a folder named by its fingerprint, and is put there by one rename when it is whole: a reader sees all of it or
    none.  Of writers that build the same version at once the first stays, and the others read that.  A changed source gives a new
    version beside the old ones, which others may still be reading; `forget` removes those.  What an interrupted build leaves is not
    read, and `forget` removes it too.
    """
    spark = source.sparkSession
    version = f"{folder.rstrip('/')}/{fingerprint(source, *parameters)}"
    if not is_done(spark, version):
        part = f"{folder.rstrip('/')}/_building-{uuid.uuid4().hex}"
        build(source).write.parquet(part)
        fs, at = _fs(spark, part)
        target = spark._jvm.org.apache.hadoop.fs.Path(version)
        renamed = not fs.exists(target) and fs.rename(at, target)
        inside = spark._jvm.org.apache.hadoop.fs.Path(f"{version}/{at.getName()}")
        if fs.exists(inside):  # another writer's folder came in between, and this one landed in it
            fs.delete(inside, True)
        elif not renamed:
            fs.delete(at, True)
        if not is_done(spark, version):
            raise RuntimeError(f"could not put {version} in place")
    return spark.read.parquet(version)


def forget(spark: SparkSession, folder: str, *keep: str) -> list[str]:
    """Removes all versions in folder but those whose fingerprints are given; returns the names of what went."""
    fs, at = _fs(spark, folder)
    if not fs.exists(at):
        return []
    gone = []
    for s in fs.listStatus(at):
        if s.isDirectory() and s.getPath().getName() not in keep:
            fs.delete(s.getPath(), True)
            gone.append(s.getPath().getName())
    return sorted(gone)
