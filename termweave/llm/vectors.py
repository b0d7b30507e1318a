"""What operators on embeddings share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(frame: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id long, v array<double>, ok boolean).  ok: an id, and a vector that is not null or zero, of finite components only."""
    x = frame.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
    return x.withColumn("ok", F.coalesce(fine & F.col("vec_id").isNotNull(), F.lit(False)))


def matrix(column):
    """A list column of equal lengths as a float64 matrix."""
    import numpy as np
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.empty((0, 0))


def unit(x):
    import numpy as np

    big = np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    y = x / big
    return y / np.sqrt((y * y).sum(1, keepdims=True))
