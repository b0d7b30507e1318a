"""Files of annotation terms as a data source: spark.read.format("annotated_terms") and .write.format("annotated_terms").

    register(spark)
    spark.read.format("annotated_terms").load(folder)                                        utterances, nested
    spark.read.format("annotated_terms").schema("label string, header struct<...>").load(f)  headers only: phrases are not parsed
    documents(term_lines(u)).write.format("annotated_terms").mode("overwrite").save(folder)  a file a partition

Paths are what pyarrow.fs opens: local folders that all executors share, and object stores by their URI.  read_annotated goes through
Spark's own text reader instead, and numbers documents.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .annotated import HEADER, PHRASE, TermError, parse_block

END = b"\n'EOU'.\n"
#: Bytes of a file to a partition, about, and bytes read at once.
SPLIT_BYTES, READ_BYTES = 64 << 20, 1 << 20
SCHEMA = f"path string, place long, starts boolean, header {HEADER}, label string, text string, pos struct<start:int,length:int>, phrases array<{PHRASE}>"


def opened(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of those in a folder in order of names, save hidden ones."""
    from pyarrow import fs

    store, at = opened(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(at, info.size)]
    found = store.get_file_info(fs.FileSelector(at))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._")


def blocks(file, start: int, end: int):
    """(place, text) of the blocks of an open file that begin from start to before end; one that begins there is read to its own end.

    A block begins the file, or follows the mark that ends an utterance; what is held is a block and a read.
    """
    at = max(0, start - len(END))
    file.seek(at)
    held, begun = b"", start == 0
    while True:
        cut = held.find(END)
        if cut < 0:
            more = file.read(READ_BYTES)
            if not more:
                break
            held += more
            continue
        if begun:
            yield at, held[:cut].decode()
        at, held, begun = at + cut + len(END), held[cut + len(END) :], True
        if at >= end:
            return
    if begun and held.strip():
        yield at, held.decode()


@dataclass
class Piece(InputPartition):
    path: str
    start: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.options = schema, options

    def partitions(self):
        size = int(self.options.get("splitbytes", SPLIT_BYTES))
        return [Piece(p, i, min(n, i + size)) for p, n in files(self.options["path"]) for i in range(0, n, size)] or [Piece("", 0, 0)]

    def read(self, piece):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if not piece.path:
            return
        schema, names = to_arrow_schema(self.schema), set(self.schema.fieldNames())
        store, _ = opened(self.options["path"])
        rows = []
        with store.open_input_file(piece.path) as file:
            for place, text in blocks(file, piece.start, piece.end):
                try:
                    one = parse_block(text, whole="phrases" in names)
                except (TermError, ValueError, TypeError, IndexError, KeyError) as e:
                    raise TermError(f"{piece.path}, at byte {place}: {e}") from e
                if one:
                    rows.append({k: v for k, v in {"path": piece.path, "place": place, **one}.items() if k in names})
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


@dataclass
class Written(WriterCommitMessage):
    name: str


class Writer(DataSourceArrowWriter):
    """A file for each partition with rows, first in a folder of the job's own; the driver moves them into place when all are whole.

    A job that fails takes its folder away; what tasks write that were still running then lies in a hidden folder, which no reader sees.
    """

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, f"_job-{uuid.uuid4().hex}"

    def write(self, batches):
        from pyspark import TaskContext

        store, at = opened(self.path)
        folder, name, out = f"{at}/{self.job}", f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.terms", None
        try:
            for b in batches:
                if b.num_rows and out is None:
                    store.create_dir(folder, recursive=True)
                    out = store.open_output_stream(f"{folder}/{name}")
                for v in b.column("value").to_pylist():
                    if v is not None:
                        out.write(f"{v}\n".encode())
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else "")

    def commit(self, messages):
        store, at = opened(self.path)
        old = [p for p, _ in files(self.path)] if self.overwrite and self._there(store, at) else []
        store.create_dir(at, recursive=True)
        for p in old:
            store.delete_file(p)
        for m in messages:
            if m is not None and m.name:
                store.move(f"{at}/{self.job}/{m.name}", f"{at}/{m.name}")
        self._clear(store, at)
        store.open_output_stream(f"{at}/_SUCCESS").close()

    def abort(self, messages):
        self._clear(*opened(self.path))

    @staticmethod
    def _there(store, at):
        from pyarrow import fs

        return store.get_file_info(at).type == fs.FileType.Directory

    def _clear(self, store, at):
        """What tasks that failed or ran twice left goes with the job's folder."""
        if self._there(store, f"{at}/{self.job}"):
            store.delete_dir(f"{at}/{self.job}")


class AnnotatedTerms(DataSource):
    @classmethod
    def name(cls):
        return "annotated_terms"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return Reader(schema, self.options)

    def writer(self, schema, overwrite):
        if "value" not in schema.fieldNames():
            raise ValueError("a column value with lines of terms is what can be written")
        return Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AnnotatedTerms)


def documents(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Lines of terms (doc_id, utt_no, value) as they are written: a document in one partition, documents and utterances in order."""
    n = partitions or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartitionByRange(n, F.col("doc_id")).sortWithinPartitions("doc_id", "utt_no").select("value")


# The readers and writers travel with the query, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
