"""Removal of passages that repeat, by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SOLID, fresh, numbered_once, require, widened

WINDOW = 3


def windows(docs: DataFrame, row: str, id: str, lines: str, width: int) -> DataFrame:
    """(row, id, pos, h1, h2) of every window of `width` lines that holds a solid character; a text of
    fewer lines is one window of them all, hashed with their number."""
    parts = ", ".join(f"`{lines}`[i + {k}]" for k in range(width))
    solid = " or ".join(f"`{lines}`[i + {k}] rlike '{SOLID}'" for k in range(width)).replace("\\", "\\\\")
    hashed = (
        f"transform(sequence(0, size(`{lines}`) - {width}), i -> struct(i as pos, "
        f"if({solid}, xxhash64({parts}), null) as h1, xxhash64('second', {parts}) as h2))"
    )
    some = f"exists(`{lines}`, x -> x rlike '{SOLID}')".replace("\\", "\\\\")
    whole = f"size(`{lines}`), `{lines}`"
    hashed = (
        f"if(size(`{lines}`) >= {width}, {hashed}, array(struct(0 as pos, "
        f"if({some}, xxhash64('short', {whole}), null) as h1, xxhash64('second short', {whole}) as h2)))"
    )
    return (
        docs.where(F.size(lines) >= 1)
        .select(F.col(row).alias("row"), F.col(id).alias("id"), F.explode(F.expr(hashed)).alias("w"))
        .select("row", "id", "w.pos", "w.h1", "w.h2")
        .where("h1 is not null")
    )


def later_windows(found: DataFrame) -> DataFrame:
    """(row, pos) of every window that occurs earlier, by (id, row, pos), in the whole table.

    First places are the minimum of each hash pair, taken before the shuffle as well; the join back
    can be split on hot windows because nothing above it needs a key's rows together.
    """
    firsts = (
        found.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "row", "pos")).alias("first"))
        .where("n > 1")
        .select("h1", "h2", F.col("first.row").alias("first_row"), F.col("first.pos").alias("first_pos"))
    )
    return (
        found.join(firsts, ["h1", "h2"])
        .where("row <> first_row or pos <> first_pos")
        .select("row", "pos")
    )


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WINDOW,
    removed: str | None = None, total: str | None = None,
) -> DataFrame:
    """The documents, without lines that lie in a window seen before.

    Lines are the parts between line feeds. A window is `width` consecutive lines of one document,
    blank ones included, at least one of them not blank; a text of fewer lines is one window of all of
    them. Windows are equal when two 64-bit hashes of their lines are. The first occurrence, by (id,
    row, position), stays; all lines covered by any later window go, overlaps merging. Null texts
    stay as they are. A document may become empty. Equal rows count as documents of their own, in the
    order of the table; a null id comes first. All columns are kept; `removed` names a column for the
    sorted positions that went, `total` one for the number of lines, both new.

    The rows are written once with a number, which carries the positions.
    """
    require(docs, id, text)
    for name in (removed, total):
        if name:
            widened(docs, f"`{name}` int")
    row, lines, gone, keep = (fresh(docs, f"_{x}") for x in ("row", "lines", "gone", "keep"))
    numbered = numbered_once(docs, row)
    split = numbered.select(row, id, F.split(text, "\n").alias(lines))
    later = later_windows(windows(split, row, id, lines, width))
    # at most one entry per line of the document
    positions = later.groupBy(F.col("row").alias(row)).agg(F.collect_set("pos").alias(gone))
    joined = numbered.join(positions, row, "left").withColumn(lines, F.split(text, "\n"))
    last = F.size(lines) - 1
    covered = F.array_distinct(
        F.flatten(F.transform(gone, lambda p: F.sequence(p, F.least(p + width - 1, last))))
    )
    joined = joined.withColumn(gone, covered).withColumn(
        keep, F.array_except(F.sequence(F.lit(0), last), F.col(gone))
    )
    cleaned = F.when(F.col(gone).isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(F.col(lines), i)), "\n")
    )
    result = [cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if removed:
        result.append(F.coalesce(F.array_sort(gone), F.array().cast("array<int>")).alias(removed))
    if total:
        result.append(F.greatest(F.size(lines), F.lit(0)).cast("bigint").alias(total))
    return joined.select(*result)


def report(docs: DataFrame) -> DataFrame:
    """Per document: lines, removed lines and their positions, digest of the text that stays."""
    done = dedup_lines(docs.select("doc_id", "text"), removed="removed", total="n_lines")
    return done.select(
        "doc_id", "n_lines",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


SQL = r"""
WITH l AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
), w AS (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id) AS n, line AS a,
        lead(line, 1) OVER (PARTITION BY doc_id ORDER BY pos) AS b,
        lead(line, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS c
    FROM l
), f AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY least(n, 3), a, b, c ORDER BY doc_id, pos) AS nth
    FROM w
    WHERE (c IS NOT NULL OR (n < 3 AND pos = 0))
        AND regexp_matches(a || coalesce(b, '') || coalesce(c, ''), '[^\x20\x09-\x0D]')
), gone AS (
    SELECT DISTINCT doc_id, pos + k AS pos FROM f, (VALUES (0), (1), (2)) AS t(k) WHERE nth > 1
), s AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
        coalesce(string_agg(CAST(g.pos AS VARCHAR), ',' ORDER BY g.pos), '') AS removed_lines,
        sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
    FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
    GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(s.n_lines, 0) AS n_lines, coalesce(s.n_removed, 0) AS n_removed,
    coalesce(s.removed_lines, '') AS removed_lines, s.kept_sha256
FROM documents d LEFT JOIN s ON d.doc_id = s.doc_id
"""
