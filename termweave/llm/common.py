"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as every operator here counts them: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only on one machine, where that is unset, one of its own."""
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="termweave-")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that spark.checkpoint.dir names."""
    return f"{_checkpoint_root(spark)}/termweave-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that is no longer read, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared checkpoint folder: computed once, and read again after an executor is lost.

    spark.cleaner.referenceTracking.cleanCheckpoints=true makes Spark delete them once nothing refers to them.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(_checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def worker_cache(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker, whatever task runs in it, and until another owner asks for its own."""
    held = sys.modules.setdefault("_termweave_worker_cache", types.ModuleType("_termweave_worker_cache")).__dict__
    if owner not in held:
        for other in [k for k in held if not k.startswith("__")]:
            del held[other]
        held[owner] = {}
    return held[owner]


def slices(batches, rows: int = 1000):
    """Arrow batches in parts of so many rows, so that what Python makes of a part is small however long its texts are on average."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those given that no column of df has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"{n}_"
        taken.add(n.lower())
        out.append(n)
    return out
