"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termweave.llm import mixing, near_copies, packing, pu_quality, toxicity
from termweave.llm.common import remove, shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic; null and empty texts have no words and stay, repeated rows stay or go together, long texts are judged whole, and columns of any names are kept."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; null and empty texts share one score, repeated rows stay or go together, long texts are judged whole, and columns of any names are kept."""
    return pu_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more): that with the smallest id.

    Fingerprints in vantage-point trees and bands propose, exact similarity decides.  Texts without words are one group; rows without an id stay.
    """
    return near_copies.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a null source is one more source, texts without words take up nothing."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences (packing.pack takes with_ids=True to carry the ids); a text without words is its end id alone, repeated rows are packed each."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizers and classifiers have no SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; what a stage returns is written as Parquet and read again as the next one's documents, then removed.

    An empty table gives an empty one, with all columns of the last stage.
    """
    docs, root, before = table(spark, sf_dir, "documents"), shared_dir(spark), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
