"""Contiguous shards of nearly equal bytes, cut by global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, require, staged, widened

LAW = "bytes"


def running_sums(size: str, part: str, row: str, before: str):
    """Number the rows of a partition and sum the sizes before each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = context.partitionId() if context else 0
        rows = total = 0
        for batch in batches:
            sizes = np.asarray(batch.column(batch.schema.get_field_index(size)), np.int64)
            after = total + np.cumsum(sizes)
            extra = {
                part: np.full(len(sizes), number, np.int64),
                row: np.arange(rows, rows + len(sizes), dtype=np.int64),
                before: after - sizes,
            }
            rows += len(sizes)
            total = int(after[-1]) if len(sizes) else total
            columns = [*batch.columns, *map(pa.array, extra.values())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *extra])

    return run


def shard_by_bytes(df: DataFrame, order: list[str], size: str, shards: int = 16) -> DataFrame:
    """Add `shard` and `slot` to rows that are laid out by `order` and cut at equal shares of `size`.

    Rows are range-partitioned on `order` plus the row's own number, so that any number of equal
    rows is dealt over several partitions. Each partition sums its sizes once; the totals of the
    partitions (one row each) give every partition its global offset, and a row lies in the shard
    in which the middle of its bytes falls. A shard's size therefore misses the target by less than
    one row at either end, a row larger than a shard leaves its neighbours empty, and `slot` counts
    from 0 in every shard. `size` is a positive long; nulls in `order` come first; an empty table
    gives no rows. Column names of the input may not be `shard` or `slot`.
    """
    require(df, *order, size)
    if {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError("the table has a column shard or slot already")
    tie, part, row, before = (fresh(df, f"_{x}") for x in ("tie", "part", "row", "before"))
    numbered = df.withColumn(tie, F.monotonically_increasing_id())
    keys = [*order, tie]
    laid = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    schema = widened(laid, f"`{part}` bigint, `{row}` bigint, `{before}` bigint")
    # Staged: the offsets below hold for exactly this layout.
    rows = staged(laid.mapInArrow(running_sums(size, part, row, before), schema))
    totals = [
        (r[0], int(r[1]), int(r[2]))
        for r in rows.groupBy(part).agg(F.sum(size), F.count("*")).orderBy(part).collect()
    ]  # one row per partition
    total = sum(t[1] for t in totals)
    starts, base, count = [], 0, 0
    for number, bytes_, n in totals:
        starts.append((number, base, count))
        base, count = base + bytes_, count + n
    spark = df.sparkSession
    start, first = fresh(df, "_start"), fresh(df, "_first")
    offsets = spark.createDataFrame(starts, f"`{part}` bigint, `{start}` bigint, `{first}` bigint")
    at = F.col(before) + F.col(start)
    middle = fresh(df, "_middle")
    number = fresh(df, "_number")
    # whole numbers up to 2^63 / 32: enough for 280 PB in 16 shards
    placed = rows.join(offsets, part).withColumn(middle, (2 * at + F.col(size)) * shards).select(
        *df.columns,
        F.expr(f"cast(`{middle}` div {2 * max(total, 1)} as int)").alias("shard"),
        (F.col(row) + F.col(first)).alias(number),
    )
    firsts = placed.groupBy("shard").agg(F.min(number).alias(start))  # at most `shards` rows
    return (
        placed.join(F.broadcast(firsts), "shard")
        .select(*df.columns, "shard", (F.col(number) - F.col(start)).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document of (doc_id, text): its shard, slot, size and checksum.

    size: UTF-8 bytes of the text, none for null, plus 1. text_crc32 of a null text is that of the
    empty one. Rows are ordered by doc_id (null first), checksum and size; repeated rows keep a place
    each. Other columns are not read.
    """
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard_by_bytes(slim, ["doc_id", "text_crc32", "size"], "size", shards).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
