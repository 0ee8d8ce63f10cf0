"""Exact histogram of encoded lengths and what its suffix sums answer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, require, staged, strings
from tidemark.llm.tokens import byte_level

# Lengths per block of the two-level sums.
BLOCK = 4096


def lengths(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """One row (`length`) per document; a null or empty text has length 0."""
    require(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = byte_level(ranks, pattern)
        for batch in batches:
            for a, b in chunks(column(batch, text)):
                counts = [len(i) for i in vocabulary.encode_all(strings(batch.slice(a, b - a), text))]
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], names=["length"])

    return df.select(text).mapInArrow(run, "length bigint")


def histogram(df: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """(length, docs) for every length that occurs; counts are summed before the shuffle. Staged, so that
    readers of several sums do not encode the texts again."""
    return staged(lengths(df, ranks, pattern, text).groupBy("length").agg(F.count("*").alias("docs")))


def suffix_sums(counts: DataFrame) -> DataFrame:
    """Per length L of a histogram (length, docs): documents and tokens of that length, documents and
    tokens of length L or more, documents up to L, tokens left when every document is cut at L, and
    the share of documents up to L.

    Sums run inside blocks of BLOCK lengths, then over the blocks' totals; the longest text bounds
    the number of blocks. An empty table gives no rows.
    """
    blocks = counts.withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("docs")
    totals = blocks.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_later"),
        F.sum("d").over(everything).alias("all_docs"),
        F.sum("t").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.join(totals, "block").select(
        "length", "docs", tokens.alias("tokens"), "all_docs", "all_tokens",
        (F.sum("docs").over(inside) + F.col("docs_later")).alias("docs_at_least"),
        (F.sum(tokens).over(inside) + F.col("tokens_later")).alias("tokens_at_least"),
    )
    up_to = F.col("all_docs") - F.col("docs_at_least") + F.col("docs")
    return rows.select(
        "length", "docs", "tokens", "docs_at_least", "tokens_at_least",
        up_to.alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        (up_to / F.col("all_docs")).alias("share_up_to"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(limit, tokens_kept, docs_cut, tokens_lost) for any context limits, read from `suffix_sums`.

    What a limit cuts is told by the suffix sums at the least length above it, so one row per limit
    is picked in one pass; limits are the caller's list, and an empty table has zeros.
    """
    limits = sorted({int(x) for x in limits})
    if not limits:
        return sums.sparkSession.createDataFrame([], "`limit` bigint, tokens_kept bigint, docs_cut bigint, tokens_lost bigint")
    above = F.struct("length", "docs_at_least", "tokens_at_least")
    picked = sums.agg(
        F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("all_tokens"),
        F.array(*[
            F.struct(F.lit(x).cast("bigint").alias("limit"), F.min(F.when(F.col("length") > x, above)).alias("next")) for x in limits
        ]).alias("at"),
    ).select("all_tokens", F.explode("at").alias("at"))
    cut = F.coalesce("at.next.docs_at_least", F.lit(0))
    lost = F.coalesce("at.next.tokens_at_least", F.lit(0)) - F.col("at.limit") * cut
    return picked.select(
        "at.limit", (F.col("all_tokens") - lost).alias("tokens_kept"), cut.alias("docs_cut"), lost.alias("tokens_lost")
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length up to which at least that share of the documents lie."""
    spark = sums.sparkSession
    wanted = spark.createDataFrame([(float(x),) for x in shares], "share double")
    return (
        wanted.join(sums.select("length", "share_up_to"), F.col("share_up_to") >= F.col("share"), "left")
        .groupBy("share").agg(F.min("length").alias("length"))
    )
