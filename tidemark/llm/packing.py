"""Cost-balanced packing of tokenised documents into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, require, staged, strings
from tidemark.llm.tokens import lower_words

CAPACITY = 4096
END_ID = 2
# Pieces that one task packs; work grows with pieces times sequences of such a group.
GROUP_PIECES = 16_384
# A document's last piece is cut once more, at a multiple of this, so that pieces of one awkward
# length (thousands of copies, say) still fill sequences.
CUT = 1024
# Estimated cost of a piece, in units of a token's linear layers of width 4096: attention inside the
# piece takes 1 / (6 * width) of that per pair of tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / 24_576

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = f"{PIECE}, sequence_id bigint, offset bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Ids of every whole text plus the end id, cut every `capacity` ids, what is left at a multiple
    of CUT.

    A null text counts as empty: its only id is the end id. Repeated rows give pieces each.
    """
    require(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = lower_words(tokenizer)
        last = np.array([end], np.uint32)
        for batch in batches:
            for a, b in chunks(column(batch, "text")):
                part = batch.slice(a, b - a)
                rows: list[tuple] = []
                for doc, ids in zip(
                    column(part, "doc_id").to_pylist(), vocabulary.encode_all(strings(part, "text")), strict=True
                ):
                    data = np.concatenate((ids, last)).astype("<u4")
                    for at, to in cuts(len(data), capacity):
                        rows.append((doc, at, to - at, zlib.crc32(data[at:to].tobytes()), len(data)))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, PIECE)


def cuts(size: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Begin and end of a document's pieces."""
    full = size // capacity * capacity
    edges = {*range(0, full + 1, capacity), full + (size - full) // CUT * CUT, size}
    edges = sorted(edges)
    return list(zip(edges[:-1], edges[1:], strict=True))


def costs(lengths: np.ndarray) -> np.ndarray:
    return LINEAR * lengths + QUADRATIC * lengths.astype(float) ** 2


def balance(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The sequence of each piece: largest cost first, to the cheapest sequence that still has room.

    There are as many sequences as the tokens need; a piece that fits nowhere opens another.
    """
    order = np.argsort(-lengths, kind="stable")
    cost_of = costs(lengths)
    n = max(1, int(-(-lengths.sum() // capacity)))
    room = np.zeros(len(lengths) + 1, np.int64)
    cost = np.zeros(len(lengths) + 1)
    room[:n] = capacity
    result = np.zeros(len(lengths), np.int64)
    for i in order:
        size = lengths[i]
        priced = np.where(room[:n] >= size, cost[:n], np.inf)
        k = int(np.argmin(priced))
        if priced[k] == np.inf:
            k, n = n, n + 1
            room[k] = capacity
        result[i] = k
        room[k] -= size
        cost[k] += cost_of[i]
    return result


def pack(cut: DataFrame, capacity: int = CAPACITY, group: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (PIECE columns) of at most `capacity` tokens.

    Full pieces are sequences of their own. The others are dealt by row number into groups of about
    `group` pieces, each packed in one task; no group depends on any value of the data, so copies and
    repeated ids do not gather. Every piece keeps its row. An empty table gives no rows. Sequence ids
    are odd for full pieces and even for packed ones.
    """
    rows = staged(cut.withColumn("row", F.monotonically_increasing_id()))
    short = rows.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        lengths = np.asarray(table.column("length"))
        sequence = balance(lengths, capacity)
        order = np.argsort(sequence, kind="stable")
        after = np.cumsum(lengths[order])
        new = np.ones(len(order), bool)
        new[1:] = sequence[order][1:] != sequence[order][:-1]
        base = (after - lengths[order])[new]
        offset = np.empty(len(order), np.int64)
        offset[order] = after - lengths[order] - np.repeat(base, np.diff(np.append(np.flatnonzero(new), len(order))))
        number = np.asarray(table.column("group"))
        ids = ((number.astype(np.int64) << 32) + sequence) * 2
        return table.select([*(f.split()[0] for f in PIECE.split(", "))]).append_column(
            "sequence_id", pa.array(ids)
        ).append_column("offset", pa.array(offset))

    dealt = short.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("bigint"))
    packed = dealt.groupBy("group").applyInArrow(run, PACKED)
    full = rows.where(F.col("length") == capacity).select(
        *(f.split()[0] for f in PIECE.split(", ")),
        (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity), capacity)
