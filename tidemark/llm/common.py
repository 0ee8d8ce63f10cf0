"""Shared helpers: staging, Arrow text batches, hashed words and shingles, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import checkpointed, stored

# A character that is neither a blank nor one of tab to carriage return.
SOLID = "[^\\x20\\x09-\\x0D]"
# Text handled at once by a vectorised step; work arrays are about 30 times as large.
CHUNK_BYTES = 1 << 21


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing, there are {df.columns}")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def widened(df: DataFrame, added: str) -> StructType:
    """The table's schema and more columns, given as in SQL."""
    more = StructType.fromDDL(added)
    if clash := {c.lower() for c in df.columns} & {c.lower() for c in more.names}:
        raise ValueError(f"the table has columns {sorted(clash)} already")
    return StructType([*df.schema.fields, *more.fields])


def staged(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder, lineage cut."""
    return checkpointed(df)


def numbered_once(df: DataFrame, row: str) -> DataFrame:
    """The rows with a number in the order of the table, written once to the shared folder.

    Numbers given anew in every pass would differ when the scan is split otherwise, as it is when
    executors come or go.
    """
    return stored(df.withColumn(row, F.monotonically_increasing_id()), "numbered")


def content_keys(df: DataFrame) -> list[str]:
    """Names of three columns for `with_content`, none of which the table has."""
    return [fresh(df, f"_key{i}") for i in range(3)]


def with_content(df: DataFrame, keys: list[str], name: str, text: str) -> DataFrame:
    """Add hashes of a column and of the text (two): rows that are equal in both have equal keys."""
    return df.withColumns({
        keys[0]: F.xxhash64(name), keys[1]: F.xxhash64(text), keys[2]: F.xxhash64(F.lit("second"), text),
    })


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes of text; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in column(batch, name).to_pylist()]


# --- hashed words --------------------------------------------------------------

_RNG = np.random.default_rng(20240501)
BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
FOLDED = BYTES.copy()
FOLDED[ord("A") : ord("Z") + 1] = FOLDED[ord("a") : ord("z") + 1]
STEP = [np.uint64(x | 1) for x in _RNG.integers(1, 1 << 63, 8, dtype=np.uint64)]
# Keys of the places in a stretch that are kept; those of longer stretches are computed again.
KEPT_PLACES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _place_keys(n: int) -> np.ndarray:
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_PLACES = _place_keys(KEPT_PLACES)


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of units, each unit given by a random 64-bit value.

    A unit is multiplied by a random number of its place and the products are added, so two different
    stretches agree with a probability near 2^-60, however alike or regular they are. (Powers of
    one base in place of the numbers would not do: modulo 2^64 regular words of two units collide for
    every base.)
    """
    length = ends - starts
    after = np.cumsum(length)
    n = int(after[-1]) if len(after) else 0
    place = np.arange(n) - np.repeat(after - length, length)
    most = int(length.max()) if len(length) else 0
    keys = _PLACES if most <= KEPT_PLACES else _place_keys(most)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[np.repeat(starts, length) + place] * keys[place], out=sums[1:])
    return mix(sums[after] - sums[after - length] + length.astype(np.uint64))


def alike(units: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> bool:
    """Whether every stretch equals, unit by unit, the one whose number `first` gives."""
    length = ends - starts
    if not np.array_equal(length, length[first]):
        return False
    after = np.cumsum(length)
    place = np.arange(int(after[-1]) if len(after) else 0) - np.repeat(after - length, length)
    return np.array_equal(units[np.repeat(starts, length) + place], units[np.repeat(starts[first], length) + place])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offset of each, a null being empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Spans:
    """Stretches of a byte buffer: which bytes lie in words, where stretches begin and end, and the
    place of every text's first one."""

    word: np.ndarray | None
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray | None


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray | None = None) -> Spans:
    """The words of all texts: maximal runs without the bytes 0x20 and 0x09 to 0x0D, or of `word`."""
    if word is None:
        word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    if not len(data):
        before = after = word
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return Spans(word, starts, ends, np.searchsorted(starts, offsets))


def text_hashes(data: np.ndarray, s: Spans, fold: bool) -> np.ndarray:
    """64-bit hashes of stretches; with `fold`, A-Z count as a-z."""
    return stretch_hashes((FOLDED if fold else BYTES)[data], s.starts, s.ends)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z as a-z, and the place of each text's first word."""
    data, offsets = text_bytes(texts)
    s = spans(data, offsets)
    return text_hashes(data, s, True), s.first


def shingle_hashes(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's begin.

    A text with fewer words is one shingle; a text without words has none.
    """
    words, first = word_hashes(texts)
    counts = np.diff(first)
    windows = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), windows)
    at = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    length = np.minimum(counts, width)[doc]
    value = np.zeros(len(doc), np.uint64)
    for k in range(width):
        inside = k < length
        place = np.where(inside, at + k, 0)
        value = value * STEP[0] + np.where(inside, words[place] if len(words) else 0, np.uint64(k + 1))
    value = mix(value ^ length.astype(np.uint64))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(counts) + 1))


def set_hashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit hash for the set of sorted values of each text; 0 for the empty set."""
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values * s)))) for s in STEP[1:3]]
    a, b = ((s[first[1:]] - s[first[:-1]]) for s in sums)
    size = np.diff(first).astype(np.uint64)
    return np.where(size > 0, mix(a ^ mix(b + size)), np.uint64(0))


# --- connected components ------------------------------------------------------


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest-neighbour contraction: (id, component) of every id in `edges` (a, b).

    Every vertex moves to its smallest neighbour, edges are renamed and loops leave, until no edge
    is left. Each round is written to the shared folder; the number of rounds grows with the
    logarithm of the number of vertices, ids being unordered hashes. The component is the id of one
    of its vertices. Nothing is collected but a test for emptiness.
    """
    edges = edges.select("a", "b").where("a <> b")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = None
    for _ in range(rounds):
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")))
        if labels is None:
            labels = least.select(F.col("a").alias("id"), F.col("to").alias("component"))
        else:
            labels = (
                labels.join(least, labels["component"] == least["a"], "left")
                .select("id", F.coalesce("to", "component").alias("component"))
            )
        labels = staged(labels)
        to_b = least.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        both = staged(
            both.join(least, "a").join(to_b, "b")
            .select(F.col("to").alias("a"), F.col("to_b").alias("b"))
            .where("a <> b").distinct()
        )
        if both.isEmpty():
            return labels
    raise RuntimeError("components did not settle")
