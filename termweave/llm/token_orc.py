"""Token ids in ORC: integer run lengths, row indexes and Bloom filters on document ids, in ascending id order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tokens import END_ID, encoder, tokenizer_path

#: Bytes of text to a file, about; and how the files are laid out: ORC itself encodes runs of integers and indexes rows.
RANGE_BYTES = 256 << 20
LAYOUT = {"orc.stripe.size": str(16 << 20), "orc.row.index.stride": "2000", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "compression": "zstd"}


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes (doc_id, ids array<int>, n_tokens, part, start_in_part) for every row of docs to ORC files in ascending doc_id order.

    Each file holds one range of ids, sorted; part numbers the ranges, null ids first, rows that repeat an id by text.
    start_in_part counts the ids before a document within its part, so that files can be written side by side.  A null or empty
    text is the end id alone, a text of any length is one row, repeated rows are written each, and an empty table gives files
    without rows.  Other columns are not read, whatever their names.
    """
    tokenizer = tokenizer or tokenizer_path()

    def encode(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, before, ids_of = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            step = 256
            for i in range(0, b.num_rows, step):
                one = b.slice(i, step)
                raw = [ids_of(t.as_py()) + end for t in one.column(1)]
                n = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
                offsets = np.concatenate(([0], np.cumsum(n)))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(raw), "<i4")))
                yield pa.RecordBatch.from_arrays([one.column(0), ids, pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(before + offsets[:-1])], names=["doc_id", "ids", "n_tokens", "part", "start_in_part"])
                before += int(offsets[-1])

    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    # Ranges of about RANGE_BYTES of text, and no fewer than shuffles have partitions.
    size = slim.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    # Encoding follows the exchange: the pass that samples the ranges reads rows but encodes nothing.
    ordered = slim.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("t")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("t"))
    tokens = ordered.mapInArrow(encode, "doc_id long, ids array<int>, n_tokens long, part int, start_in_part long")
    tokens.write.options(**LAYOUT).orc(path)


def read_tokens(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The rows of files by write_tokens, of ids from low to high if given: then stripes are skipped by their statistics and Bloom filters."""
    df = spark.read.schema("doc_id long, ids array<int>, n_tokens long, part int, start_in_part long").orc(path)
    if low is not None:
        df = df.where(F.col("doc_id") >= low) if low != high else df.where(F.col("doc_id") == low)
    return df if high is None else df.where(F.col("doc_id") <= high)


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of files by write_tokens: start counts all ids before the document in the order of the files."""

    def crc(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for b in batches:
            ids = b.column(1)
            flat, at = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))))
            sums = [zlib.crc32(flat[s:e].tobytes()) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(at), pa.int64()), b.column(2), b.column(3), pa.array(sums, pa.int64())], names=["doc_id", "n_tokens", "part", "start_in_part", "ids_crc32"])

    files = read_tokens(spark, path)
    rows = files.select("doc_id", "ids", "part", "start_in_part").mapInArrow(crc, "doc_id long, n_tokens long, part int, start_in_part long, ids_crc32 long")
    # One row for each range that was written; the running total is over those.
    base = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(base), F.col("part") == F.col("p")).select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")
