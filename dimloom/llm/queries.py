"""Registered queries of the operators, by name: (spark, folder of test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.llm import (
    bpe,
    centroids,
    forest,
    jaccard,
    lempel_ziv,
    neighbours,
    packing,
    personal,
    secrets,
    shards,
    spelling,
    toxicity,
    unigram,
)
from dimloom.llm.common import table
from dimloom.llm.oracles import ORACLES


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel_ziv.document_fingerprints(table(spark, sf_dir, "documents"))


def may_learn() -> Column:
    """Labels of the other ids are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), may_learn()
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken")
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), 8)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_fingerprints": op2_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_neighbours": op5_neighbours,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sharding": op8_sharding,
    "op9_personal_data": op9_personal_data,
    "op10_secrets": op10_secrets,
    "op11_embedding_duplicates": op11_embedding_duplicates,
    "op12_spelling_forms": op12_spelling_forms,
    "op13_centroid_clusters": op13_centroid_clusters,
}

__all__ = ["ORACLES", "QUERIES"]
