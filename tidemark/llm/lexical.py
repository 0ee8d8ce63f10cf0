"""Exact ranked lexical search: posting lists in geometric blocks with coordinatewise-maximum summaries.

Queries are a stated set, taken in blocks of bounded vocabulary. Documents are cut into terms once per
block of queries and dealt to shards of bounded size; a shard holds one posting list per term. A
list is clustered by the similarity of its documents (random projections of their weighted terms), and
every block keeps the largest impact of each term among its documents. A block's summary therefore
bounds the score of each of its documents from above, and a block is skipped only when that bound is
below the score that the ten best found so far have reached.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, mix, require, staged

TOP = 10
# Distinct terms per block of queries; term numbers fit into 15 bits.
BLOCK_TERMS = 1 << 15
# Postings per shard.
SHARD_POSTINGS = 1_000_000
# Documents per block of a posting list, on average.
BLOCK_DOCS = 64
# A list of so few documents has no summary: to score them costs no more than to bound them.
FEW_DOCS = 4
# Dimensions of the projections by which documents are clustered.
DIMS = 24
# Bytes of summaries that a task keeps; beyond them lists are blocked again when needed.
KEPT_BYTES = 1 << 28
# One shard in so many is searched first; the scores it reaches are where the others begin.
FIRST_SHARDS = 16

_TERM = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
# Bytes of terms as they are, A-Z as a-z, all others as a blank.
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in set(_TERM) else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of ASCII letters and digits and of all non-ASCII characters."""
    return text.encode().translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Queries:
    """A block of queries: their keys, each one's term numbers and how often it holds them."""

    keys: list[tuple]
    terms: list[np.ndarray]
    times: list[np.ndarray]
    vocabulary: dict[bytes, int]


def query_blocks(items: DataFrame, id: str, text: str, limit: int = BLOCK_TERMS) -> Iterator[Queries]:
    """Blocks of queries of at most `limit` different terms together, or one query that has more.

    Every row is a query of its own with the key (number, id); rows without terms are left out.
    """
    keys, lists, vocabulary = [], [], {}

    def block() -> Queries:
        counts = [Counter(vocabulary[t] for t in ts) for ts in lists]
        return Queries(
            keys, [np.array(sorted(c), np.int64) for c in counts],
            [np.array([c[t] for t in sorted(c)], np.int64) for c in counts], vocabulary,
        )

    for number, row in enumerate(items.select(id, text).toLocalIterator()):
        found = terms(row[1])
        new = set(found) - vocabulary.keys()
        if keys and len(vocabulary) + len(new) > limit:
            yield block()
            keys, lists, vocabulary, new = [], [], {}, set(found)
        if found:
            keys.append((number, row[0]))
            lists.append(found)
            for t in sorted(new):
                vocabulary[t] = len(vocabulary)
    if keys:
        yield block()


POSTINGS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document of (doc_id, text): its number of terms, and those of the vocabulary with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            n, edge, found, tfs = [], [0], [], []
            for text in column(batch, "text"):
                words = terms(text.as_py())
                counts = Counter([t for t in map(get, words) if t is not None])
                n.append(len(words))
                found.extend(counts.keys())
                tfs.extend(counts.values())
                edge.append(len(found))
            edges = pa.array(edge, pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(x, pa.int32())) for x in (found, tfs)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"]
            )

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, POSTINGS)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of every document from its number of terms."""
    if 75 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 25 + (75 * n * n_docs) // max(n_terms, 1)
    return np.array([25 + (75 * int(x) * n_docs) // n_terms for x in n], np.int64)


class Shard:
    """Documents with their impacts, and the posting lists of their terms, blocked when first needed."""

    def __init__(self, m: np.ndarray, first: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, queries: list[np.ndarray]):
        """`first` and `term` give each document's terms, `queries` the terms of each query."""
        self.first, self.term, self.queries = first, term.astype(np.int64), queries
        asked = np.concatenate(queries)
        order = np.argsort(asked, kind="stable")
        self.asking = np.repeat(np.arange(len(queries)), [len(q) for q in queries])[order]
        self.asking_first = np.searchsorted(asked[order], np.arange(len(weights) + 1))
        doc = np.repeat(np.arange(len(m)), np.diff(first))
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        order = np.argsort(self.term, kind="stable")
        self.post_doc = doc[order]
        self.post_first = np.searchsorted(self.term[order], np.arange(len(weights) + 1))
        most = np.zeros(len(weights), np.int64)
        np.maximum.at(most, self.term, self.impact)
        self.most = most
        # unit projections of the weighted impacts
        signs = (mix(np.arange(len(weights), dtype=np.uint64)[:, None] * np.uint64(DIMS) + np.arange(DIMS, dtype=np.uint64)) >> np.uint64(63))
        signs = signs.astype(np.float32) * 2 - 1
        weighted = (self.impact * weights[self.term]).astype(np.float32)
        self.sketch = np.zeros((len(m), DIMS), np.float32)
        for k in range(DIMS):
            self.sketch[:, k] = np.bincount(doc, weighted * signs[self.term, k], len(m))
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, tuple] = {}
        self.kept = 0
        self.local = np.full(len(weights), -1, np.int64)
        self.none = np.zeros(0, np.int64)

    def places(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the terms of the documents stand, and where each document's begin among those."""
        length = self.first[docs + 1] - self.first[docs]
        after = np.cumsum(length)
        at = np.repeat(self.first[docs] - (after - length), length) + np.arange(int(after[-1]) if len(after) else 0)
        return at, after - length

    def near(self, t: int) -> np.ndarray:
        """The terms of the queries that hold t; only these can add to a score that t takes part in."""
        together = np.zeros(len(self.local), bool)
        for q in self.asking[self.asking_first[t] : self.asking_first[t + 1]].tolist():
            together[self.queries[q]] = True
        return np.flatnonzero(together)

    def blocks(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
        """(documents, begin of each block, summaries, their terms) of a posting list."""
        if t in self.lists:
            return self.lists[t]
        docs = self.post_doc[self.post_first[t] : self.post_first[t + 1]]
        if len(docs) <= FEW_DOCS:
            return docs, np.zeros(min(1, len(docs)), np.int64), None, self.none
        n = -(-len(docs) // BLOCK_DOCS)
        heads = docs[np.linspace(0, len(docs) - 1, n).astype(np.int64)]
        center = self.sketch[heads]
        half = (center * center).sum(1) / 2
        # nearest of the heads; what all documents of the list share cancels out
        block = np.concatenate([
            np.argmax(self.sketch[docs[i : i + 4096]] @ center.T - half, axis=1) for i in range(0, len(docs), 4096)
        ])
        order = np.argsort(block, kind="stable")
        docs, block = docs[order], block[order]
        new = np.concatenate(([True], block[1:] != block[:-1]))
        block, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        terms = self.near(t)
        self.local[terms] = np.arange(len(terms))
        summary = np.zeros((len(begin), len(terms)), np.int32)  # an impact is below 1,000,000
        for i in range(0, len(docs), 4096):
            at, head = self.places(docs[i : i + 4096])
            to = self.local[self.term[at]]
            row = np.repeat(block[i : i + 4096], np.diff(np.append(head, len(at))))
            kept = to >= 0
            np.maximum.at(summary.reshape(-1), row[kept] * len(terms) + to[kept], self.impact[at][kept].astype(np.int32))
        self.local[terms] = -1
        if self.kept + summary.nbytes > KEPT_BYTES:
            self.lists.clear()
            self.kept = 0
        self.kept += summary.nbytes
        found = self.lists[t] = (docs, begin, summary, terms)
        return found

    def scores(self, docs: np.ndarray, vector: np.ndarray) -> np.ndarray:
        at, head = self.places(docs)
        return np.add.reduceat(self.impact[at] * vector[self.term[at]], head)


def search_shard(
    shard: Shard, ids: np.ndarray, queries: Queries, weights: np.ndarray, floors: list[int], top: int = TOP
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, documents, scores): the best of the shard, unless they are certain not to be among the best of all.

    `ids` order documents of equal score. A list is left out when all lists from it on, taken in the
    order of their largest contributions, cannot reach the bar together; a block when its summary cannot.
    """
    seen = np.full(len(ids), -1, np.int64)
    vector = np.zeros(len(weights), np.int64)
    for q, (terms_, times) in enumerate(zip(queries.terms, queries.times, strict=True)):
        factor = times * weights[terms_]
        most = factor * shard.most[terms_]
        order = np.argsort(-most, kind="stable")
        remaining = np.cumsum(most[order][::-1])[::-1]
        vector[terms_] = factor
        bar = max(floors[q], 1)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for t, rest in zip(terms_[order].tolist(), remaining.tolist(), strict=True):
            if rest < bar:
                break
            listed, begin, summary, near = shard.blocks(t)
            if summary is None:
                bound = np.full(len(begin), rest)
            else:
                bound = summary[:, np.searchsorted(near, terms_)] @ factor
            by_bound = np.argsort(-bound, kind="stable")
            end = np.append(begin[1:], len(listed))
            done, step = 0, 2
            while done < len(by_bound):
                group = by_bound[done : done + step]
                group = group[bound[group] >= bar]
                if not len(group):
                    break
                found = np.concatenate([listed[begin[b] : end[b]] for b in group])
                found = found[seen[found] != q]
                done, step = done + step, step * 2
                if not len(found):
                    continue
                seen[found] = q
                score = shard.scores(found, vector)
                good = score >= bar
                docs, scores = np.concatenate((docs, found[good])), np.concatenate((scores, score[good]))
                if len(docs) > top:
                    best = np.lexsort((ids[docs], -scores))[:top]
                    docs, scores = docs[best], scores[best]
                if len(docs) >= top:
                    bar = max(bar, int(scores.min()))
        vector[terms_] = 0
        yield q, docs, scores


FOUND = "query int, doc_id bigint, score bigint"


def _search(queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, floors: list[int], top: int):
    """The task that searches one shard."""

    def run(rows: pa.Table) -> pa.Table:
        lists = rows.column("terms").combine_chunks()
        first = np.asarray(lists.offsets, np.int64)
        term, tf = (
            np.asarray(rows.column(n).combine_chunks().flatten(), np.int64) for n in ("terms", "tfs")
        )
        m = length_norms(np.asarray(rows.column("n"), np.int64), n_docs, n_terms)
        doc_id = rows.column("doc_id")
        ids = np.asarray(doc_id.fill_null(np.iinfo(np.int64).max), np.int64)
        # places in the order of ids, null last
        place = np.lexsort((ids, np.asarray(doc_id.is_null())))
        order = np.empty(len(ids), np.int64)
        order[place] = np.arange(len(ids))
        shard = Shard(m, first - first[0], term, tf, weights, queries.terms)
        best = list(search_shard(shard, order, queries, weights, floors, top))
        at = np.concatenate([d for _, d, _ in best]) if best else np.zeros(0, np.int64)
        return pa.table({
            "query": pa.array(np.repeat([q for q, _, _ in best], [len(d) for _, d, _ in best]).astype(np.int32)),
            "doc_id": doc_id.combine_chunks().take(pa.array(at)),
            "score": pa.array(np.concatenate([s for _, _, s in best]) if best else np.zeros(0, np.int64)),
        })

    return run


def _search_block(docs: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(query, doc_id, score): the best of every shard for each query of a block, at least the best of all."""
    found = staged(
        postings(docs, queries.vocabulary).withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    )
    n_docs, n_terms, hits = found.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    df = [0] * len(queries.vocabulary)
    for t, n in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term
        df[t] = n
    weights = np.array([term_weight(n_docs, n) for n in df], np.int64)
    shards = max(1, -(-hits // SHARD_POSTINGS))
    dealt = found.where(F.size("terms") > 0).withColumn(
        "shard", F.pmod("deal", F.lit(shards)).cast("int")
    ).drop("deal")

    def search(rows: DataFrame, floors: list[int]) -> DataFrame:
        return rows.groupBy("shard").applyInArrow(_search(queries, weights, n_docs, n_terms, floors, top), FOUND)

    floors = [0] * len(queries.keys)
    if shards < 2 * FIRST_SHARDS:
        return search(dealt, floors)
    cut = shards // FIRST_SHARDS
    begun = staged(search(dealt.where(F.col("shard") < cut), floors))
    ranked = begun.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"))))
    for q, score in ranked.where(F.col("r") == top).select("query", "score").collect():  # one row per query
        floors[q] = score
    return begun.union(search(dealt.where(F.col("shard") >= cut), floors))


def search(
    docs: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", top: int = TOP
) -> DataFrame:
    """(query, `id`, rank, doc_id, score): the `top` best documents of (doc_id, text) for every row of `items`.

    Scores are whole numbers as in SQL below and exact; documents score above 0 and equal scores are
    ranked by doc_id, a null one last. Every row of either table counts for itself, repeated ones too;
    query numbers the rows of `items`, which are read on the driver block by block. Null and empty
    texts have no terms: such items give no rows, such documents are not counted. Empty tables give no
    rows. Other columns are not read. Per block of queries the documents are read once.
    """
    require(docs, "doc_id", "text")
    require(items, id, text)
    spark = docs.sparkSession
    kind = items.schema[id].dataType.simpleString()
    results = []
    for queries in query_blocks(items, id, text):
        keys = spark.createDataFrame(
            [(i, *key) for i, key in enumerate(queries.keys)], f"query int, number bigint, `{id}` {kind}"
        )
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        found = _search_block(docs, queries, top)
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        results.append(
            ranked.join(F.broadcast(keys), "query").select(F.col("number").alias("query"), id, "rank", "doc_id", "score")
        )
    if not results:
        return spark.createDataFrame([], f"query bigint, `{id}` {kind}, rank int, doc_id bigint, score bigint")
    union = results[0]
    for more in results[1:]:
        union = union.union(more)
    return union


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items).select("item_id", "rank", "doc_id", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH dt AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term
), len AS (
    SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id
), total AS (
    SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), it AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), score AS (
    SELECT it.item_id, tf.doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM it JOIN tf USING (term) JOIN weight USING (term) JOIN len USING (doc_id), total
    GROUP BY it.item_id, tf.doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
