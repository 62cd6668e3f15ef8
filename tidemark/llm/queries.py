"""The registered queries of the training-data operators: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe, filter_audit, language_model, lexical_search, licenses, merkle, mixing, near_dup, neighbours, quality, substring, toxicity, url_filter,
)

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents").select(*DOCUMENT))


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(documents, labels)
    return toxicity.score(documents, model).select(
        "doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages")
    )


def op4_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compared(table(spark, folder, "documents"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(table(spark, folder, "documents"))


def op7_substring(spark: SparkSession, folder: str) -> DataFrame:
    out = substring.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "removed_chars", "removed_words", F.size("removed").cast("long").alias("n_removed"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(table(spark, folder, "documents"), path, pattern), path, pattern))


def op9_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.score(documents, quality.fit(documents, labels))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_neighbours, op3_toxicity, op4_merkle, op5_licenses, op6_language_model, op7_substring, op8_byte_bpe, op9_near_dup,
        op10_quality, op11_lexical_search, op12_url_filter, op13_filter_audit,
    )
}
ORACLES: dict[str, str] = {"op1_mixing": mixing.ORACLE, "op9_near_dup": near_dup.ORACLE, "op11_lexical_search": lexical_search.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
