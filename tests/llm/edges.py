"""Awkward documents: nulls in every column, empty and very long texts, ties, repeated rows, and extra
columns with names that operators use themselves."""

from __future__ import annotations

LONG = " ".join(f"word{i * 7919 % 60013}x{i % 31}" for i in range(60_000))
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, n_words bigint, "
    "tokens string, score string, part int, `group` int, length int, component string, id string, host_key string"
)
SAME = "one two three four five six\nseven eight nine ten\neleven twelve thirteen\nfourteen"


def _row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), *[None] * 10)


ROWS = [
    _row(1, SAME),
    _row(2, SAME),
    _row(2, SAME),
    _row(None, SAME, None, None),
    _row(3, None),
    _row(4, ""),
    _row(5, " \t\n\r\n "),
    _row(6, LONG),
    _row(7, LONG + " tail"),
    _row(8, "Ünïcode ñ 漢字 🙂 don't <|endoftext|> á   x"),
    _row(9, "a\n" * 50),
    _row(None, None, None, None),
    _row(10, "ONE two three FOUR five six\nseven eight nine ten\neleven twelve thirteen\nfourteen"),
    _row(11, "short text"),
]


def frame(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def ids(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())


ALL_IDS = sorted((r[0] is None, r[0] or 0) for r in ROWS)


def regular_words(n: int) -> tuple[str, str]:
    """Two different words of n letters (a power of two) with the same hash under every polynomial
    modulo 2^64: a Thue-Morse word and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


# Small clean corpora in which nothing is shared.
UNLIKE = {
    "one": [(1, "just one document of seven words")],
    "two": [(1, "alpha beta gamma delta epsilon zeta"), (2, "one two three four five six seven")],
    "many": [(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(200)],
}
