"""One query per operator over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    block_search,
    class_ngrams,
    embedding_forest,
    jaccard_join,
    mixing,
    packing,
    pu_quality,
    repetition,
    substring_dedup,
    toxicity,
    url_rules,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


@query
def op1_relative_lz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.parse(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op4_parity_sketch_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_documents(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op6_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return drawn.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


ORACLE_SQL["op6_systematic_mixing"] = mixing.ORACLE_SQL


@query
def op8_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


@query
def op9_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pu_quality.score(docs, pu_quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_factorization_machine_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_projection_tree_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text_key")


@query
def op2_loser_tree_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_and_merge(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "place"
    )


@query
def op11_mixed_precision_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op12_brown_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_ngrams.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_geometric_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return block_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE_SQL["op13_geometric_block_search"] = block_search.ORACLE_SQL
