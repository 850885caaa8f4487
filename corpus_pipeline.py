"""The corpus pipeline: documents through five stages, each on all that the one before kept.

Texts go to Python in batches of BATCH_ROWS and BATCH_BYTES at most, which the stages set in the
session: with whole rows of text on their way through the JVM, Spark's usual batches of 10,000 rows would take
a third of a small executor's memory. No result depends on it.

Defined cases: documents with null or empty text are not toxic, are like no other, lose nothing,
are mixed with size 0 and packed as an end alone; repeated rows are one group of copies; a null
id or source is kept; an empty table gives no pieces; columns beyond those of documents pass until packing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, mixing, packing, substring_dedup, toxicity
from tidemark.session import materialize


BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what Spark sends to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose toxicity score stays below the limit."""
    small_batches(spark)
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.harmless(docs, machine)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return jaccard_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that recur, their characters counted anew."""
    small_batches(spark)
    return substring_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    small_batches(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text_key")


NEAR_WORDS, NEAR_PERCENT = 5, 80
STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard join", one_of_similar),
    ("substring dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
