"""The corpus pipeline: toxicity, near-duplicates, repeated passages, mixing, encoding.

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows the text. Null texts pass all
stages and are encoded as empty texts. Empty tables pass through; other columns are dropped at the start.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, mixing, near_dup, substring, toxicity
from tidemark.llm.common import written

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; learned from the labelled documents of ``sf_dir``."""
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs.select(*DOCUMENT), model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates."""
    return near_dup.deduplicated(docs.select(*DOCUMENT))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text lacks the passages that occur in an earlier one; no document is dropped."""
    out = substring.dedup(docs.select(*DOCUMENT))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*DOCUMENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson counts to sources' target weights (sizes to the power 0.7), shuffled."""
    return mixing.mix(docs.select(*DOCUMENT)).select(*DOCUMENT)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): token ids of every text, and whether decoding gives the text again."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(docs, path, pattern)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dup", without_near_duplicates),
    ("substring", without_repeated_passages),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]
#: SQL expresses neither the learned scores nor the sampling of token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
