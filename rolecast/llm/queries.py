"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rolecast.llm.byte_bpe import encoded_digests
from rolecast.llm.divergence import divergence_sql, source_divergence
from rolecast.llm.language_model import document_scores
from rolecast.llm.languages import document_languages
from rolecast.llm.leaks import find_leaks
from rolecast.llm.near_copies import document_near_copies
from rolecast.llm.quality import document_quality
from rolecast.llm.repeats import document_repeats
from rolecast.llm.secrets import find_secrets, secret_digests
from rolecast.llm.shards import document_shards, shards_sql
from rolecast.llm.token_counts import token_counts
from rolecast.llm.token_files import token_digests
from rolecast.llm.vector_codes import codes_sql, vector_codes

WORD_TOKENIZER = "word_bpe_49k.json"
SHARDS = 40
BYTE_RANKS = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_repeats(documents(spark, sf_dir))


@query
def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER))


@query
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(documents(spark, sf_dir), SHARDS)


ORACLES["op1_shards"] = shards_sql(SHARDS)


@query
def op2_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_languages(documents(spark, sf_dir))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir), public_tokenizers.path(WORD_TOKENIZER), end_id=2)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(documents(spark, sf_dir), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


@query
def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_near_copies(documents(spark, sf_dir))


@query
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(documents(spark, sf_dir))


@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(find_secrets(documents(spark, sf_dir), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLES["op12_vector_codes"] = codes_sql()


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


ORACLES["op13_source_divergence"] = divergence_sql()
