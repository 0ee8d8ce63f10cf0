"""The corpus pipeline: rules, classifier, line dedup, near duplicates, packing.

Every stage takes all documents that its predecessor kept and returns them with the columns of
documents, the last one packed pieces. The classifier and the packing cannot be written as SQL, so
there is no twin; the stages are tested against plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import catalog, jaccard, line_dedup, packing, quality_cnn, quality_rules
from tidemark.llm.common import SOLID, fresh
from tidemark.session import scratch_folder


def _counted(docs: DataFrame) -> DataFrame:
    """Set the number of characters of texts that may have changed, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without their hosts' boilerplate lines."""
    return _counted(quality_rules.apply_rules(docs))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores at its threshold or above."""
    return quality_cnn.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages seen before; one of which nothing is left goes."""
    gone = fresh(docs, "_gone")
    done = line_dedup.dedup_lines(docs, removed=gone)
    return _counted(done.where((F.size(gone) == 0) | F.col("text").rlike(SOLID)).drop(gone))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, the one of least doc_id."""
    return jaccard.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack_documents(docs, catalog.vocabulary(catalog.WORD_TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result but the last written to the shared folder and read again; the folder
    is removed when the application ends."""
    folder = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
