"""Word, string and concept indexes of a term table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .runs import with_runs


def concept_flags(terms: DataFrame, first_term_is_concept: bool = True, assume_runs: bool = False) -> DataFrame:
    """terms with is_concept and index_cui: the first row of each run of a concept names it, or else its preferred name does."""
    if first_term_is_concept:
        x = terms if assume_runs else with_runs(terms, "cui", "line_no")
        x = x.withColumn("is_concept", F.col("run_id") == F.col("line_no"))
    else:
        x = terms.withColumn("is_concept", (F.col("ts") == "P") & (F.col("stt") == "PF"))
    return x.withColumn("index_cui", F.when(F.col("is_concept"), F.lit(T.CONCEPT_PLACEHOLDER)).otherwise(F.col("cui")))


def strings(terms: DataFrame, *keep: str) -> DataFrame:
    """(sui, norm_string, string), and the columns to keep."""
    return terms.select(*keep, "sui", T.normalize(F.col("str"))["norm"].alias("norm_string"), F.col("str").alias("string"))


def concepts(flagged: DataFrame, dummy: bool = True) -> DataFrame:
    """(cui, string) of the rows that name concepts; the dummy row comes along."""
    x = flagged.where("is_concept").select("cui", F.col("str").alias("string"))
    return x.unionByName(x.sparkSession.createDataFrame([(T.CONCEPT_PLACEHOLDER, "X")], "cui string, string string")) if dummy else x


def words(flagged: DataFrame, pairs: DataFrame | None = None, *keep: str) -> DataFrame:
    """(i, n, word, sui, cui), and the columns to keep: each word of the normalized strings, save strings whose first and last words are a listed pair."""
    x = flagged.select(*keep, "sui", F.col("index_cui").alias("cui"), T.words(T.normalize(F.col("str"))["norm"]).alias("w")).where(F.size("w") > 0)
    if pairs is not None:
        x = x.withColumn("first", F.col("w")[0]).withColumn("last", F.element_at("w", -1)).join(pairs.select("first", "last").distinct(), ["first", "last"], "left_anti")
    return x.select(*keep, F.size("w").alias("n"), F.posexplode("w").alias("p", "word"), "sui", "cui").select(*keep, (F.col("p") + 1).alias("i"), "n", "word", "sui", "cui")


def lines(df: DataFrame, *columns: str) -> DataFrame:
    cols: list[str | Column] = list(columns or df.columns)
    return df.select(F.concat_ws("|", *cols).alias("value"))
