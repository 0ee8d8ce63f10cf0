"""Base measures of a text and the cross-document frequency of its lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    STEP, Spans, chunks, column, content_keys, fresh, mix, require, spans, staged, stretch_hashes, text_bytes,
    text_hashes, widened, with_content,
)

# A line is boilerplate of its host when more than MIN_DOCS different texts and more than SHARE
# percent of the host's different texts hold it, or more than MANY_DOCS whatever their share: the
# limit does not grow with the host beyond that number.
MIN_DOCS = 20
SHARE = 5
MANY_DOCS = 200
# A document of which more than this percent of the words lie in boilerplate lines is depleted.
DEPLETED = 50
MIN_WORDS = 50
MAX_REPEAT = 50

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
LINES = "text_key bigint, line_keys array<bigint>, line_words array<int>"


def _per(doc_edges: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive edges."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[doc_edges[1:]] - sums[doc_edges[:-1]]


def _line_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every line of every text, and the document of each."""
    feeds = np.flatnonzero(data == 10)
    doc_of_feed = np.searchsorted(offsets, feeds, side="right") - 1
    docs = np.concatenate((np.arange(len(offsets) - 1), doc_of_feed))
    starts = np.concatenate((offsets[:-1], feeds + 1))
    order = np.lexsort((starts, docs))
    docs, starts = docs[order], starts[order]
    last = np.append(docs[1:] != docs[:-1], True) if len(docs) else np.zeros(0, bool)
    ends = np.where(last, offsets[docs + 1], np.append(starts[1:], 0) - 1)
    return starts, ends, docs


def measure_texts(texts: pa.Array) -> dict[str, pa.Array]:
    """MEASURES and LINES of every whole text, a null one counting as empty.

    line_keys: distinct hashes of the normalised lines with a word (words with A-Z as a-z, joined
    by one space); line_words: words of all lines with that hash.
    """
    data, offsets = text_bytes(texts)
    n_docs = len(offsets) - 1
    s = spans(data, offsets)
    exact, folded = text_hashes(data, s, False), text_hashes(data, s, True)
    n_words = np.diff(s.first)
    doc = np.repeat(np.arange(n_docs), n_words)

    # windows of three words
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    three = mix((exact[at] * STEP[0] + exact[at + 1]) * STEP[0] + exact[at + 2])
    order = np.lexsort((three, doc[at]))
    same = np.zeros(len(at) + 1, bool)
    if len(at):
        h, d = three[order], doc[at][order]
        same[1:-1] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    twice = at[order][same[1:] | same[:-1]]
    covered = np.zeros(len(doc), bool)
    for k in range(3):
        covered[twice + k] = True

    # lines
    starts, ends, line_doc = _line_edges(data, offsets)
    first_word = np.searchsorted(s.starts, starts)
    line_words = np.searchsorted(s.starts, ends) - first_word
    solid = line_words > 0
    raw = text_hashes(data, Spans(None, starts, ends, None), False)
    n_lines = np.bincount(line_doc[solid], minlength=n_docs)
    key = raw[solid]
    order = np.lexsort((key, line_doc[solid]))
    h, d = key[order], line_doc[solid][order]
    distinct = np.bincount(d[np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (d[1:] != d[:-1])))], minlength=n_docs) if len(h) else n_lines

    line_hash = stretch_hashes(folded, first_word[solid], (first_word + line_words)[solid])
    order = np.lexsort((line_hash, line_doc[solid]))
    h, d, w = line_hash[order], line_doc[solid][order], line_words[solid][order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    begin = np.flatnonzero(new)
    words = np.add.reduceat(w, begin) if len(begin) else np.zeros(0, np.int64)
    edges = np.searchsorted(d[begin], np.arange(n_docs + 1)).astype(np.int32)

    inside = s.word & ((data & 0xC0) != 0x80)
    text_key = text_hashes(data, Spans(None, offsets[:-1], offsets[1:], None), False)
    return {
        "n_words": pa.array(n_words, pa.int64()),
        "word_chars": pa.array(_per(offsets, inside), pa.int64()),
        "n_symbols": pa.array(_per(offsets, _SYMBOL[data]), pa.int64()),
        "n_dup_lines": pa.array(n_lines - distinct, pa.int64()),
        "n_repeat_words": pa.array(_per(s.first, covered), pa.int64()),
        "text_key": pa.array(text_key.view(np.int64)),
        "line_keys": pa.ListArray.from_arrays(edges, pa.array(h[begin].view(np.int64))),
        "line_words": pa.ListArray.from_arrays(edges, pa.array(words.astype(np.int32))),
    }


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by MEASURES and LINES; other columns stay, of other names than these."""
    require(docs, text)
    rest = docs.drop(text)
    schema = widened(rest, f"{MEASURES}, {LINES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for a, b in chunks(column(batch, text)):
                part = batch.slice(a, b - a)
                extra = measure_texts(column(part, text))
                part = part.remove_column(at)
                yield pa.RecordBatch.from_arrays([*part.columns, *extra.values()], names=[*part.schema.names, *extra])

    return docs.select(*rest.columns, F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def boilerplate(
    measured: DataFrame, min_docs: int = MIN_DOCS, share: int = SHARE, many_docs: int = MANY_DOCS,
) -> DataFrame:
    """(host_key, line_key) of lines above both limits or above `many_docs`, from rows with host_key
    and LINES.

    Documents of equal text are one document here: else each line of a text copied more than
    `many_docs` times would be boilerplate, and all of its copies would be rejected as depleted, the
    first one too. Copies are left to the operators that keep one of them.
    Distinct texts are counted with a partial step on (line, text), so a line that a third of the
    documents hold is spread over all tasks.
    """
    lines = measured.select("host_key", "text_key", F.explode("line_keys").alias("line_key"))
    counts = lines.groupBy("host_key", "line_key").agg(F.count_distinct("text_key").alias("docs"))
    hosts = measured.groupBy("host_key").agg(F.count_distinct("text_key").alias("host_docs"))
    above = (F.col("docs") * 100 > F.col("host_docs") * share) | (F.col("docs") > many_docs)
    return (
        counts.where(F.col("docs") > min_docs).join(hosts, "host_key")
        .where(above)
        .select("host_key", "line_key")
    )


def _slim(docs: DataFrame, host: str, text: str, *more) -> DataFrame:
    require(docs, host, text)
    return docs.select(
        *more, F.monotonically_increasing_id().alias("row"), F.xxhash64(host).alias("host_key"),
        F.col(text).alias("text"),
    )


def _hits(measured: DataFrame) -> DataFrame:
    """(row, line_key, words) of every boilerplate line of every document."""
    lines = measured.select(
        "row", "host_key", F.explode(F.arrays_zip("line_keys", "line_words")).alias("line")
    ).select("row", "host_key", F.col("line.line_keys").alias("line_key"), F.col("line.line_words").alias("words"))
    return lines.join(boilerplate(measured), ["host_key", "line_key"]).drop("host_key")


def judge(docs: DataFrame, id: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Per row: `id`, the measures, the words in boilerplate lines, base_failed and `kept`.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEAT percent of the words in repeated
    three-word windows. kept: not base_failed, and at most DEPLETED percent of the words in
    boilerplate lines of the host. Null or empty texts have no words and fail; documents without a
    host (null) form one host. Every row is judged, repeated ones alike. Other columns are not read.
    """
    measured = staged(measure(_slim(docs, host, text, F.col(id).alias("id"))))
    removed = _hits(measured).groupBy("row").agg(F.sum("words").alias("removed"))
    return (
        measured.drop("line_keys", "line_words", "text_key", "host_key").join(removed, "row", "left").drop("row")
        .withColumn("boilerplate_words", F.coalesce("removed", F.lit(0))).drop("removed")
        .withColumn("base_failed", _failed())
        .withColumn("kept", ~F.col("base_failed") & _enough(F.col("boilerplate_words")))
    )


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def _enough(boilerplate_words):
    return 100 * boilerplate_words <= DEPLETED * F.col("n_words")


def report(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "boilerplate_words", "base_failed", "kept",
    )


def without_lines(texts: pa.Array, dropped: pa.Array) -> list[str | None]:
    """The texts without the lines whose normalised hash is among each one's dropped keys."""
    result = []
    for text, keys in zip(texts.to_pylist(), dropped.to_pylist(), strict=True):
        if keys and text is not None:
            lines = text.split("\n")
            data = measure_lines(pa.array(lines, pa.large_string()))
            gone = set(keys)
            text = "\n".join(line for line, key in zip(lines, data, strict=True) if key not in gone)
        result.append(text)
    return result


def measure_lines(lines: pa.Array) -> list[int | None]:
    """The normalised hash of every line, None for one without words."""
    keys = measure_texts(lines)["line_keys"].to_pylist()
    return [k[0] if k else None for k in keys]


def apply_rules(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The documents that `judge` keeps, with their boilerplate lines removed and all columns as they
    were. A verdict depends on host and text only and is joined by their hashes, so no row needs a
    number that two passes must agree on. Verdicts are written first: the join then only moves its
    rows, and a text with very many copies can be split."""
    require(docs, host, text)
    gone, keys = fresh(docs, "_gone"), content_keys(docs)
    keyed = with_content(docs, keys, host, text)
    measured = staged(measure(_slim(keyed, host, text, *[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)])))
    found = _hits(measured).groupBy("row").agg(F.sum("words").alias("words"), F.collect_set("line_key").alias(gone))
    verdict = staged(
        measured.select("row", "key0", "key1", "key2", "n_words", _failed().alias("failed")).join(found, "row", "left")
        .where(~F.col("failed") & _enough(F.coalesce("words", F.lit(0))))
        .groupBy(*[F.col(f"key{i}").alias(k) for i, k in enumerate(keys)]).agg(F.first(gone).alias(gone))
    )
    joined = keyed.join(verdict, keys).drop(*keys)
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(column(batch, text)):
                part = batch.slice(a, b - a)
                cleaned = pa.array(without_lines(part.column(at), column(part, gone)), pa.string())
                columns = [cleaned if i == at else part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), l AS (
    SELECT doc_id, source, md5(text) AS content, unnest(string_split(text, chr(10))) AS line FROM d
), n AS (
    SELECT doc_id, source, content, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM l
), k AS (
    SELECT *, len(lw) AS words, translate(array_to_string(lw, ' '), '{_UPPER}', '{_LOWER}') AS normal
    FROM n WHERE len(lw) > 0
), hosts AS (
    SELECT source, count(DISTINCT md5(text)) AS host_docs FROM d GROUP BY source
), counts AS (
    SELECT source, normal, count(DISTINCT content) AS docs FROM k GROUP BY source, normal
), flagged AS (
    SELECT c.source, c.normal FROM counts c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
    WHERE docs > {MANY_DOCS} OR (docs > {MIN_DOCS} AND docs * 100 > host_docs * {SHARE})
), gone AS (
    SELECT doc_id, sum(words) AS words FROM k JOIN flagged f
        ON k.source IS NOT DISTINCT FROM f.source AND k.normal = f.normal
    GROUP BY doc_id
), dup AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM k GROUP BY doc_id
), pos AS (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3
), win AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM pos
), rep AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM win, (VALUES (0), (1), (2)) AS t(j) WHERE n >= 2 GROUP BY doc_id
), m AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.words, 0) AS BIGINT) AS boilerplate_words
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words)
        AND 100 * boilerplate_words <= {DEPLETED} * n_words AS kept
FROM m
"""
