"""Running operators on streams: runs of equal neighbours, and the running union of a document's concepts.

State is kept by key and written to the query's checkpoint, so a stream that stops goes on where it was.  Rows of a key must come in
order over batches; within a batch they are sorted.  The batch operators over the same rows give the same results.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def runs(stream: DataFrame, key: str = "cui", order: str = "line_no", source: str = "source") -> DataFrame:
    """(source, order, key, run_id): run_id is the order value of the first row of a run of neighbours with equal keys, in each source.

    The state of a source is its last key and run.  Null keys are equal to each other; a row whose order value is not above all
    before it fails the query.
    """

    def step(who: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("at", kind="stable")
        last, started, run, at = state.get if state.exists else (None, False, 0, 0)
        out = []
        for o, k in zip(rows["at"].tolist(), rows["k"].tolist(), strict=True):
            k = None if pd.isna(k) else k
            if started and o <= at:
                raise ValueError(f"{who[0]}: {o} comes after {at}")
            if not started or k != last:
                run = o
            last, started, at = k, True, o
            out.append((who[0], o, k, run))
        state.update((last, started, run, at))
        yield pd.DataFrame(out, columns=["source", "line_no", "cui", "run_id"])

    x = stream.select(F.col(source).cast("string").alias("source"), F.col(order).cast("long").alias("at"), F.col(key).cast("string").alias("k"))
    return x.groupBy("source").applyInPandasWithState(step, "source string, line_no long, cui string, run_id long", "last string, started boolean, run long, at long", "append", GroupStateTimeout.NoTimeout)


def running_union(stream: DataFrame) -> DataFrame:
    """(doc_id, utt_no, n, saved): after each utterance the sorted set of what its document has held so far, joined by `;`.

    stream: (doc_id, utt_no, items array<string>).  The state of a document is its set, in order.  Null items are none; rows that
    share a document and utterance are one.
    """

    def step(who: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = set(state.get[0]) if state.exists else set()
        rows: dict = {}
        for p in parts:
            for u, items in zip(p["utt_no"].tolist(), p["items"].tolist(), strict=True):
                rows.setdefault(u, set()).update(i for i in ([] if items is None else items) if i is not None)
        out = []
        for u in sorted(rows):
            held |= rows[u]
            out.append((who[0], u, len(held), ";".join(sorted(held))))
        state.update((sorted(held),))
        yield pd.DataFrame(out, columns=["doc_id", "utt_no", "n", "saved"])

    x = stream.select(F.col("doc_id").cast("long"), F.col("utt_no").cast("long"), "items")
    return x.groupBy("doc_id").applyInPandasWithState(step, "doc_id long, utt_no long, n int, saved string", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def to_folder(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Appends what is there now to Parquet files and returns; called again it goes on with what has come since."""
    stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
