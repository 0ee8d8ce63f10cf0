"""Registered queries of the subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment,
    bpe,
    jaccard,
    lexical,
    licences,
    line_dedup,
    mixing,
    neighbours,
    packing,
    quality_cnn,
    quality_rules,
    sharding,
    token_counts,
)
from tidemark.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op1_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.report(documents(spark, folder))


@query
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, folder))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, folder))


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(documents(spark, folder))


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.report(documents(spark, folder))


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), vocabulary(WORD_TOKENIZER))


@query
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, vocabulary(BYTE_RANKS), pattern()))


@query
def op9_quality_cnn(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cnn.report(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.histogram(documents(spark, folder), vocabulary(BYTE_RANKS), pattern())
    return token_counts.suffix_sums(counts)


@query
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.report(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query
def op12_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, folder))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.report(documents(spark, folder), vocabulary(BYTE_TOKENIZER), vocabulary(PIECE_MODEL))


SQL |= {
    "op5_line_dedup": line_dedup.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op11_lexical_search": lexical.SQL,
    "op12_mix_sources": mixing.SQL,
}
