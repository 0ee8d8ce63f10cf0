from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm import edges
from tidemark.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall(text.translate(UPPER)) if text else []


def brute(docs, items, top=10):
    """(item_id, rank, doc_id, score) by the definition; rows count for themselves."""
    found = [(d, Counter(cut(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    N, L = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    result = []
    for item, text in items:
        scored = []
        for d, c, n in found:
            m = 25 + (75 * n * N) // L
            score = 0
            for t in cut(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scored)[:top], 1):
            result.append((item, rank, None if none else d, -score))
    return result


def key(row):
    return [(x is not None, x) for x in row]


def run(docs, items, **more):
    return sorted((tuple(r) for r in lexical.search(docs, items, **more).drop("query").collect()), key=key)


@pytest.fixture
def queries(spark):
    def make(rows):
        return spark.createDataFrame(
            [(i, t, 1, "x", 2) for i, t in rows], "item_id bigint, text string, rank int, query string, score int"
        )

    return make


ITEMS = [
    (1, edges.SAME), (1, "one ONE two"), (None, "word7919x1 short Ünïcode 漢字 漢字"), (2, None), (3, ""), (4, "- . !"),
    (5, "nowhere"), (6, edges.LONG), (7, "a"),
]


def test_awkward_documents(spark, queries):
    docs = edges.frame(spark)
    rows = [(r[0], r[1]) for r in edges.ROWS]
    assert run(docs, queries(ITEMS)) == sorted(brute(rows, ITEMS), key=key)
    assert run(edges.frame(spark, []), queries(ITEMS)) == []
    assert run(docs, queries([])) == run(docs, queries([(2, None)])) == []


@pytest.fixture(scope="module")
def tables(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/benchmark.parquet")


def test_twin_and_brute_force(tables, data):
    docs, items = tables
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    got = run(docs, items)
    expected = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert got == sorted(expected, key=key)
    assert got == sorted(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({lexical.SQL})").fetchall(), key=key)


@pytest.mark.parametrize(
    "limits",
    [
        {"SHARD_POSTINGS": 100, "BLOCK_DOCS": 4},  # many shards, the first of them set the bar
        {"BLOCK_DOCS": 3, "KEPT_BYTES": 1},  # small blocks, each list blocked again for every query
        {"BLOCK_TERMS": 50},  # many blocks of queries
    ],
)
def test_limits_change_nothing(tables, monkeypatch, limits):
    docs, items = tables
    items = items.limit(12) if "BLOCK_TERMS" in limits else items
    expected = run(docs, items)
    blocks = lexical.query_blocks
    if "BLOCK_TERMS" in limits:
        monkeypatch.setattr(lexical, "query_blocks", lambda *a: blocks(*a, limit=limits["BLOCK_TERMS"]))
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    assert run(docs.repartition(5), items) == expected


def test_blocks_are_skipped_and_summaries_bound_their_documents():
    """Two kinds of documents: a query of one kind leaves most blocks of a word common to both alone."""
    rng = np.random.default_rng(5)
    words = [b"common", *[b"%d" % i for i in range(80)]]
    vocabulary = {w: i for i, w in enumerate(words)}
    docs = []
    for i in range(3000):
        kind = (i % 2) * 40
        docs.append(np.unique(np.concatenate(([0], 1 + kind + rng.integers(0, 40, 25)))))
    first = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    term = np.concatenate(docs)
    query = np.sort(np.concatenate(([0], 1 + rng.choice(40, 20, replace=False))))
    weights = np.where(np.arange(len(words)) == 0, 50_000, 3000)
    shard = lexical.Shard(np.full(3000, 100), first, term, np.ones(len(term), np.int64), weights, [query])
    scored = []
    plain = shard.scores
    shard.scores = lambda d, v: scored.append(len(d)) or plain(d, v)
    queries = lexical.Queries([(0, 0)], [query], [np.ones(len(query), np.int64)], vocabulary)
    (_, found, scores), = lexical.search_shard(shard, np.arange(3000), queries, weights, [0])
    vector = np.zeros(len(words), np.int64)
    vector[query] = weights[query]
    every = plain(np.arange(3000), vector)
    best = np.lexsort((np.arange(3000), -every))[:10]
    assert sorted(found.tolist()) == sorted(best.tolist())
    assert sum(scored) < 2000
    listed, begin, summary, terms = shard.blocks(0)
    for b, (lo, hi) in enumerate(zip(begin, np.append(begin[1:], len(listed)), strict=True)):
        bound = (summary[b] * vector[terms]).sum()
        assert all(bound >= every[d] for d in listed[lo:hi])
