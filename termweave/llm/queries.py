"""The queries of this subpackage, each over its whole table with the parameters meant for use, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, ann, ball_kmeans, embed_dedup, licenses, mixing, packing, pu_quality, simhash, token_counts, token_orc, toxicity, url_rules
from .common import durable, remove, shared_dir, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens"
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path)
    out = durable(token_orc.digest(spark, path))
    remove(spark, path)
    return out


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.templates_frame(spark))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_kmeans.assign(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {"op1_mixing": op1_mixing, "op2_quality": op2_quality, "op3_embedding_dedup": op3_embedding_dedup, "op4_url_rules": op4_url_rules, "op5_toxicity": op5_toxicity, "op6_simhash": op6_simhash, "op7_token_orc": op7_token_orc, "op8_packing": op8_packing, "op9_ann": op9_ann, "op10_licenses": op10_licenses, "op11_token_counts": op11_token_counts, "op12_ball_kmeans": op12_ball_kmeans, "op13_alignment": op13_alignment}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.SQL, "op4_url_rules": url_rules.SQL, "op12_ball_kmeans": ball_kmeans.SQL}
