"""Tables between the steps of an operator, in the folder that spark.checkpoint.dir names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """That folder; a temporary one only on a local master, where a session names none."""
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="termweave-")


def written(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and written there: a short plan, and nothing to compute again when executors are lost."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, folder: str) -> DataFrame:
    """The rows of df as compressed files of that folder, which stay; read again by them alone."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
