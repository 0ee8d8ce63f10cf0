"""Sharding and line dedup against plain versions and SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest

from tests.llm import edges
from tests.parity import differences
from tidemark.llm import jaccard, quality_rules, line_dedup, sharding


def _shards(rows):
    """(id, size, crc, shard) by plain prefix sums, each row where the middle of its bytes falls."""
    slim = sorted(
        ((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    )
    total, at, out = sum(r[3] for r in slim), 0, []
    for known, i, crc, size in slim:
        out.append((i if known else None, size, crc, (2 * at + size) * 16 // (2 * total)))
        at += size
    return out


@pytest.mark.parametrize("source", ["edges", "table"])
def test_shards(spark, data, source):
    docs = edges.frame(spark) if source == "edges" else spark.read.parquet(f"{data}/documents.parquet")
    rows = sharding.shard_documents(docs).collect()
    want = _shards([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in rows) == Counter(want)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_shards_are_contiguous_and_even(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "repeat('x', cast(id % 97 as int)) as text")
    got = sharding.shard_documents(rows.union(rows)).collect()
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    target = sum(size.values()) / 16
    assert len(size) == 16 and max(abs(v - target) for v in size.values()) <= 2 * 98
    ordered = [r["shard"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert ids == sorted(ids) and ordered == sorted(ordered)


def test_one_id_for_all_rows(spark):
    rows = spark.range(2000).selectExpr("cast(null as bigint) as doc_id", "'same' as text")
    got = sharding.shard_documents(rows).collect()
    assert Counter(r["shard"] for r in got) == Counter({k: 125 for k in range(16)})


def test_no_rows(spark):
    none = edges.frame(spark, [])
    assert sharding.shard_documents(none).collect() == []
    assert line_dedup.report(none).collect() == []


def _dedup(rows, width=3):
    """Plain version: rows in order of id, then of the table."""
    seen, result = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        doc_id, text = rows[i]
        if text is None:
            result.append((doc_id, 0, 0, "", None))
            continue
        lines, gone = text.split("\n"), set()
        for p in range(max(1, len(lines) - width + 1)):
            window = tuple(lines[p : p + width])
            if not any(c not in " \t\n\x0b\x0c\r" for x in window for c in x):
                continue
            if window in seen:
                gone |= set(range(p, p + len(window)))
            seen.add(window)
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone)
        result.append((doc_id, len(lines), len(gone), ",".join(map(str, sorted(gone))), hashlib.sha256(kept.encode()).hexdigest()))
    return result


def test_line_dedup_of_awkward_documents(spark):
    rows = [(r[0], r[1]) for r in edges.ROWS] + [(20, "p\nq\nr\ns\nt"), (21, "x\np\nq\nr\ns\nt\ny"), (22, "q\nr\ns"), (23, "\n\n\n\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert Counter(tuple(r) for r in line_dedup.report(docs).collect()) == Counter(_dedup(rows))


def test_rows_keep_their_numbers_when_the_scan_is_split_otherwise(spark, tmp_path):
    """Repeated rows and copies under two splits of the same files: the same rows stay."""
    rows = [(i % 7, f"first {i % 5}\nsecond {i % 5}\nthird {i % 3}\n" + "filler words of a text " * 20, f"h{i % 2}") for i in range(400)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6).write.parquet(f"{tmp_path}/t")
    before, found = spark.conf.get("spark.sql.files.minPartitionNum", None), []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.files.minPartitionNum", n)
            docs = spark.read.parquet(f"{tmp_path}/t")
            done = [line_dedup.dedup_lines(docs), jaccard.one_of_each(docs), quality_rules.apply_rules(docs)]
            spark.conf.set("spark.sql.files.minPartitionNum", "17" if n == "1" else "1")  # as when executors come or go
            found.append([Counter(map(tuple, d.collect())) for d in done])
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if before is None else spark.conf.set("spark.sql.files.minPartitionNum", before)
    assert found[0] == found[1]


def test_line_dedup_keeps_columns(spark):
    done = line_dedup.dedup_lines(edges.frame(spark), removed="gone_lines")
    assert done.columns == [*edges.frame(spark).columns, "gone_lines"]
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(edges.frame(spark), removed="score")
    assert edges.ids(done) == edges.ALL_IDS


def test_line_dedup_equals_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    assert differences(line_dedup.report(spark.read.parquet(f"{data}/documents.parquet")), con, line_dedup.SQL) == []


def test_short_texts_form_one_window(spark):
    """Texts of one and two lines: later equal ones go, other line counts and blank ones do not."""
    rows = [(1, "one line"), (2, "one line"), (3, "one line\n"), (4, "one line\n"), (5, "a\nb"), (6, "a\nb"), (7, "b\na"),
            (8, ""), (9, ""), (10, " \n\t"), (11, " \n\t"), (12, None), (13, "a\nb\nx"), (14, "p\nq\nr"), (15, "p\nq\nr"), (None, "one line")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    done = line_dedup.dedup_lines(docs, removed="gone").collect()
    gone = {r["doc_id"]: r["gone"] for r in done if r["gone"]}
    assert gone == {1: [0], 2: [0], 4: [0, 1], 6: [0, 1], 15: [0, 1, 2]}
    assert {r["doc_id"]: r["text"] for r in done} == dict(rows) | dict.fromkeys(gone, "")
