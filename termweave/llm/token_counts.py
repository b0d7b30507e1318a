"""Token counts of whole texts: what a vocabulary's strings are alone is proved once, and only other pre-tokens are merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import byte_pairs
from .common import worker_cache
from .tokens import tokenizer_path

#: The tokenizer and the limit of the query; both are parameters.
TOKENIZER, LIMIT = "byte_bpe_50k.json", 512
#: Merged pre-tokens that a worker keeps besides the proved ones.
MOST_PIECES = 200_000


class PieceCounts(dict):
    """Pre-tokens to their number of tokens: one for each proved string, by merging for all others."""

    def __init__(self, whole, proved: list[str], most: int = MOST_PIECES):
        super().__init__(dict.fromkeys(proved, 1))
        self.merge, self.proved, self.most = byte_pairs.PieceIds(whole).merged, proved, most + len(proved)

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(piece))
        if len(piece) <= byte_pairs.LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(dict.fromkeys(self.proved, 1))
            self[piece] = n
        return n


def counter(path: str, proved: list[str] | None):
    """A function from a text to its number of tokens.

    proved: what byte_pairs.whole_tokens gives for path; None for files of another kind, which the library counts by itself.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    whole = byte_pairs.load(path)
    library = lambda text: len(whole.encode(text, add_special_tokens=False).ids)
    if proved is None:
        return library
    of, pieces, odd = PieceCounts(whole, proved).__getitem__, byte_pairs.PRETOKEN.findall, byte_pairs.ODD.search
    specials = byte_pairs.special_strings(whole)

    def count(text: str) -> int:
        if any(map(text.__contains__, specials)):
            return library(text)
        if not odd(text):
            return sum(map(of, pieces(text)))
        return sum(library(c) if odd(c) else sum(map(of, pieces(c))) for c in byte_pairs.BEFORE_SPACE.split(text))

    return count


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, n_bytes long, n_tokens long, over_limit boolean) for every row of docs; over_limit: more than `limit` tokens.

    tokenizer: the path of a .json file for the tokenizers library or of a .model file for sentencepiece.  Counts are the library's
    for the whole text, without begin, end or padding; special strings in a text count as the library counts them by default.  Null
    and empty texts have 0 bytes and 0 tokens, repeated rows and null ids are counted each, an empty table gives no rows, and other
    columns are not read.  Nothing is shuffled: each text is counted where it is read.  A worker holds a batch of texts, the pre-tokens
    of one text and a table of bounded size.  The proved strings, no more than the vocabulary has, are sent to the executors once.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)
    proved = byte_pairs.whole_tokens(path) if path.endswith(".json") and byte_pairs.is_byte_level(path) else None
    sent = docs.sparkSession.sparkContext.broadcast(proved)

    def count(batches):
        import pyarrow as pa

        known = worker_cache("token_counts")
        if path not in known:
            known[path] = counter(path, sent.value)
        of = known[path]
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                n = pa.array([of(t.as_py()) for t in part.column(1)], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), n], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
