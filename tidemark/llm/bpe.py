"""Byte-level BPE: whole texts to ids with character offsets, and ids back to bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, column, require, strings, widened
from tidemark.llm.tokens import byte_level


def _replace(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *extra.values()], names=[*batch.schema.names, *extra]
    )


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in chunks(column(batch, text)):
            yield batch.slice(a, b - a)


def encode(
    df: DataFrame, ranks: str, pattern: str, text: str = "text", tokens: str = "tokens",
    offsets: bool = False,
) -> DataFrame:
    """Add the ids of every whole text as array<int>; with `offsets`, also each token's first and
    last-plus-one character as `token_start` and `token_end`.

    A null or empty text has no ids. A character that is split over several tokens lies in the span
    of each. Texts are handled a few megabytes at a time; one text is never cut. Added names must
    not exist. No special token is recognised.
    """
    require(df, text)
    added = [tokens, *(["token_start", "token_end"] if offsets else [])]
    schema = widened(df, ", ".join(f"`{c}` array<int>" for c in added))

    def run(batches):
        vocabulary = byte_level(ranks, pattern)
        for part in _slices(batches, text):
            texts = strings(part, text)
            ids = vocabulary.encode_all(texts)
            extra = {tokens: pa.array(ids, pa.list_(pa.int32()))}
            if offsets:
                spans = [vocabulary.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                extra["token_start"] = pa.array([s[0] for s in spans], pa.list_(pa.int32()))
                extra["token_end"] = pa.array([s[1] for s in spans], pa.list_(pa.int32()))
            yield _replace(part, extra)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, pattern: str, tokens: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for; null ids give no bytes. Unknown ids raise."""
    require(df, tokens)
    schema = widened(df, f"`{decoded}` binary")

    def run(batches):
        vocabulary = byte_level(ranks, pattern)
        for batch in batches:
            ids = column(batch, tokens)
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                done = [vocabulary.decode(x or ()) for x in ids.slice(a, 256).to_pylist()]
                yield _replace(part, {decoded: pa.array(done, pa.binary())})

    return df.mapInArrow(run, schema)


def round_trip(
    df: DataFrame, ranks: str, pattern: str, text: str = "text", tokens: str = "tokens", decoded: str = "decoded",
    split: str = "n_split",
) -> DataFrame:
    """`encode` with offsets and `decode` in one pass; the text itself is dropped. `split` counts the
    tokens that begin inside a character, whose span overlaps that of the token before."""
    require(df, text)
    schema = widened(df.drop(text), f"`{tokens}` array<int>, `{decoded}` binary, `{split}` bigint")

    def run(batches):
        vocabulary = byte_level(ranks, pattern)
        for part in _slices(batches, text):
            texts = strings(part, text)
            ids = vocabulary.encode_all(texts)
            done = [vocabulary.decode(i.tolist()) for i in ids]
            spans = [vocabulary.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
            inside = [int((start[1:] < end[:-1]).sum()) for start, end in spans]
            part = part.remove_column(part.schema.get_field_index(text))
            yield _replace(part, {
                tokens: pa.array(ids, pa.list_(pa.int32())), decoded: pa.array(done, pa.binary()),
                split: pa.array(inside, pa.int64()),
            })

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, tokens: str = "tokens", decoded: str = "decoded", split: str = "n_split") -> DataFrame:
    """Per document: number of ids, digests of the decimal ids and of the decoded bytes, split tokens."""
    return df.select(
        "doc_id",
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(tokens).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
        F.col(split).alias("n_split"),
    )
