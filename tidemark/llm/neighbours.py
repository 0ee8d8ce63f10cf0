"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Every tree splits on one random direction per level, at the median of each node. The trees are
fitted on a bounded sample; every row is then routed to its leaf in every tree. A query walks all
trees through one priority queue, nearest leaves first, until a number of leaves that reaches
TARGET of the true neighbours among the sample. Leaves are scored in blocks of rows and queries and
the best of all blocks are kept.

Inner products become distances by one more component that gives all rows the length of the longest.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.common import column, require, staged

TREES, LEAF_ROWS = 12, 256
# Different vectors the trees are fitted on, and queries among them that set the search length.
SAMPLE, PROBES, TARGET = 16_384, 200, 0.97
# Least rows of the sample in a leaf.
LEAF_SAMPLE = 8
# Leaves that are scored together, and the most bytes of rows, and of queries, in a block.
JOINED_LEAVES, BLOCK_BYTES = 128, 16 << 20
EVERY = 20
# Candidates kept beyond those asked for while block scores differ in the last bits.
SPARE = 12


@dataclass
class Forest:
    """directions: tree x (dims + 1) x depth; cuts: for each level, tree x nodes."""

    directions: np.ndarray
    cuts: list[np.ndarray]
    longest: float
    leaves: int  # searched per query

    @property
    def depth(self) -> int:
        return len(self.cuts)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - np.einsum("ij,ij->i", rows, rows), 0)
        return np.hstack((rows, np.sqrt(rest)[:, None]))

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        length = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        return np.hstack((queries * (self.longest / length), np.zeros((len(queries), 1))))

    def route(self, lifted: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree: rows x trees."""
        result = np.zeros((len(lifted), len(self.directions)), np.int64)
        for t, direction in enumerate(self.directions):
            along = lifted @ direction
            node = result[:, t]
            for level, cuts in enumerate(self.cuts):
                node = node * 2 + (along[:, level] > cuts[t][node])
            result[:, t] = node
        return result

    def search(self, aimed: np.ndarray, most: int) -> list[tuple[int, int]]:
        """The `most` nearest (tree, leaf) of one query, over all trees, nearest first."""
        along = np.einsum("d,tdl->tl", aimed, self.directions).tolist()
        queue = [(0.0, t, 0, 0) for t in range(len(along))]
        found = []
        while queue and len(found) < most:
            far, tree, level, node = heapq.heappop(queue)
            while level < self.depth:
                gap = along[tree][level] - self.cuts[level][tree, node]
                side = int(gap > 0)
                heapq.heappush(queue, (far + gap * gap, tree, level + 1, node * 2 + 1 - side))
                level, node = level + 1, node * 2 + side
            found.append((tree, node))
        return found


def fit(sample: np.ndarray, rows: int, longest: float, k: int = 20, seed: int = 11) -> Forest:
    """Trees over a sample of `rows` different vectors, and the number of leaves to search.

    For PROBES rows of the sample, their k nearest of the sample are found by brute force; enough
    leaves are searched to hold TARGET of them. The sample being thinner than the table, its
    neighbours are farther away and the number errs on the long side.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    wanted = int(np.ceil(np.log2(max(rows / LEAF_ROWS, 1))))
    allowed = int(np.log2(max(len(sample) / LEAF_SAMPLE, 1)))
    depth = max(0, min(wanted, allowed))
    directions = rng.standard_normal((TREES, dims + 1, depth))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True) if depth else 1
    forest = Forest(directions, [], longest, 1)
    lifted = forest.lifted(sample)
    nodes = np.zeros((TREES, len(sample)), np.int64)
    for level in range(depth):
        cuts = np.zeros((TREES, 1 << level))
        for t in range(TREES):
            along = lifted @ directions[t][:, level]
            order = np.lexsort((along, nodes[t]))
            edges = np.searchsorted(nodes[t][order], np.arange((1 << level) + 1))
            for node, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                if b > a:
                    cuts[t, node] = along[order[(a + b - 1) // 2]]
            nodes[t] = nodes[t] * 2 + (along > cuts[t][nodes[t]])
        forest.cuts.append(cuts)
    total = TREES << depth
    if depth and len(sample) > 1:
        probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
        aimed = forest.aimed(sample[probes])
        ranks = []
        for q, (i, target) in enumerate(zip(probes, aimed, strict=True)):
            score = sample @ sample[i]
            score[i] = -np.inf
            near = np.argsort(-score)[: min(k, len(sample) - 1)]
            place = np.full((TREES, 1 << depth), total)
            for rank, leaf in enumerate(forest.search(target, total)):
                place[leaf] = rank
            ranks.append(place[np.arange(TREES)[:, None], nodes[:, near]].min(axis=0))
        forest.leaves = int(np.quantile(np.concatenate(ranks), TARGET)) + 1
    else:
        forest.leaves = total
    return forest


def usable(vectors: DataFrame, id: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, key, vec) of the rows that take part, key being a 128-bit hash of the vector, and the
    number of components. Rows without an id, and vectors that are null, zero or of another length
    than most, or hold null or non-finite components take no part."""
    plain = vectors.select(
        F.col(id).cast("bigint").alias("vec_id"), F.col(vector).cast(ArrayType(DoubleType())).alias("v")
    ).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = plain.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.col("n").desc(), F.col("dims").desc()).first()
    dims = most["dims"] if most else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([np.asarray(x, np.float64) for x in column(batch, "v").to_numpy(zero_copy_only=False)]) + 0.0
            data = [v.tobytes() for v in values]
            keys = [hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id"), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
                names=["vec_id", "key", "vec"],
            )

    return plain.where(F.size("v") == dims).mapInArrow(run, "vec_id bigint, key binary, vec binary"), dims


def _matrix(values: pa.Array | pa.ChunkedArray) -> np.ndarray:
    data = values.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1) if data else np.zeros((0, 1))


def _list(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def best_of_block(k: int):
    """Score the queries of a block against the rows of the leaves that each one visits; the best of
    all these leaves are sent on."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        asked, found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if index.num_rows and queries.num_rows:
            vectors, leaf = _matrix(index.column("vec")), np.asarray(index.column("leaf"))
            least = np.asarray(index.column("least"))
            wanted, visits = _matrix(queries.column("vec")), queries.column("leaves").to_pylist()
            near: list[list[np.ndarray]] = [[] for _ in visits]
            by_leaf: dict[int, list[int]] = {}
            for i, leaves in enumerate(visits):
                for x in leaves:
                    by_leaf.setdefault(x, []).append(i)
            order = np.argsort(leaf, kind="stable")
            for x, asking in by_leaf.items():
                at = order[slice(*np.searchsorted(leaf[order], (x, x + 1)))]
                if not len(at):
                    continue
                if len(at) > k + SPARE:
                    score = wanted[asking] @ vectors[at].T
                    top = np.argpartition(-score, k + SPARE - 1, axis=1)[:, : k + SPARE]
                    for i, places in zip(asking, at[top], strict=True):
                        near[i].append(places)
                else:
                    for i in asking:
                        near[i].append(at)
            for i, parts in enumerate(near):
                if parts:
                    places = np.concatenate(parts)
                    # the same sum for a pair wherever it is computed
                    exact = np.einsum("ij,ij->i", vectors[places], np.broadcast_to(wanted[i], (len(places), wanted.shape[1])))
                    best = np.lexsort((least[places], -exact))[:k]
                    asked.append(np.full(len(best), i))
                    found.append(places[best])
                    scores.append(exact[best])
        rows = np.concatenate(found)
        return pa.table(
            {
                "query": queries.column("key").take(pa.array(np.concatenate(asked))),
                "key": index.column("key").take(pa.array(rows)),
                "least": index.column("least").take(pa.array(rows)),
                "score": pa.array(np.concatenate(scores)),
            }
        )

    return run


def search(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by `every`.

    Score is the inner product in double precision. Equal vectors are searched and indexed once: of
    each, the k + 1 least ids can matter, since ties go to the smaller id; a query's own id is left
    out afterwards. A repeated (id, vector) counts once, an id with several vectors is several
    candidates and as many queries. Fewer candidates than k give fewer rows, an empty table none.
    Every row is indexed; only the trees' cuts come from at most SAMPLE different vectors.
    """
    require(vectors, id, vector)
    spark = vectors.sparkSession
    rows, dims = usable(vectors, id, vector)
    rows = staged(rows)
    # the rank limit is applied in every task before the shuffle as well
    nth = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = rows.groupBy("key", "vec_id").agg(F.first("vec").alias("vec")).withColumn("nth", nth).where(f"nth <= {k + 1}")
    classes = staged(
        few.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("least", F.col("ids")[0])
    )
    count = classes.count()
    asked = staged(
        classes.join(rows.where(F.col("vec_id") % every == 0).select("key").distinct(), "key", "left_semi").select("key", "vec")
    )

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(column(batch, "vec"))
            top = float(np.sqrt(np.einsum("ij,ij->i", m, m)).max()) if len(m) else 0.0
            yield pa.RecordBatch.from_arrays([pa.array([top])], names=["norm"])

    longest = classes.select("vec").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0] or 1.0
    sample = [r["vec"] for r in classes.select("key", "vec").orderBy("key").limit(SAMPLE).collect()]
    matrix = np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), -1) if sample else np.zeros((0, max(dims, 1)))
    forest = fit(matrix, count, longest, k)
    shared = spark.sparkContext.broadcast(forest)
    groups = -(-(1 << forest.depth) // JOINED_LEAVES)

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            m = _matrix(column(batch, "vec"))
            if not len(m):
                continue
            leaves = trees.route(trees.lifted(m))
            for t in range(leaves.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(t * groups + leaves[:, t] // JOINED_LEAVES), pa.array(leaves[:, t]),
                        column(batch, "key"), column(batch, "vec"), column(batch, "least"),
                    ],
                    names=["block", "leaf", "key", "vec", "least"],
                )

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        fields = [("block", pa.int64()), ("leaves", pa.list_(pa.int64())), ("key", pa.binary()), ("vec", pa.binary())]
        for batch in batches:
            data = column(batch, "vec").to_pylist()
            m = _matrix(column(batch, "vec"))
            for a in range(0, len(m), 256):
                out = []
                for i, target in enumerate(trees.aimed(m[a : a + 256]), a):
                    at: dict[int, list[int]] = {}
                    for tree, leaf in trees.search(target, trees.leaves):
                        at.setdefault(tree * groups + leaf // JOINED_LEAVES, []).append(leaf)
                    out += [(block, leaves, batch.column(0)[i].as_py(), data[i]) for block, leaves in at.items()]
                yield _list(out, fields)

    index = classes.select("key", "vec", "least").mapInArrow(
        to_leaves, "block bigint, leaf bigint, key binary, vec binary, least bigint"
    )
    visits = staged(asked.select("key", "vec").mapInArrow(
        to_visits, "block bigint, leaves array<bigint>, key binary, vec binary"
    ))
    # one row per block, at most TREES * SAMPLE / LEAF_SAMPLE / JOINED_LEAVES of them
    most = max(1024, BLOCK_BYTES // (8 * max(dims, 1)))
    sizes = (
        index.groupBy("block").agg(F.count("*").alias("n")).withColumn("row_parts", F.ceil(F.col("n") / most))
        .join(visits.groupBy("block").agg(F.count("*").alias("q")), "block")
        .select("block", "row_parts", F.ceil(F.col("q") / most).alias("query_parts"))
    )
    sizes = F.broadcast(staged(sizes))
    to = F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))
    index = index.join(sizes, "block").withColumn(
        "row_part", F.pmod(F.xxhash64("key"), "row_parts")
    ).withColumn("query_part", to)
    visits = visits.join(sizes, "block").withColumn(
        "query_part", F.pmod(F.xxhash64("key"), "query_parts")
    ).withColumn("row_part", F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1)))
    on = ["block", "row_part", "query_part"]
    scored = index.select(*on, "leaf", "key", "vec", "least").groupBy(*on).cogroup(
        visits.select(*on, "leaves", "key", "vec").groupBy(*on)
    ).applyInArrow(best_of_block(k + 1), "query binary, key binary, least bigint, score double")

    found = scored.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("least").alias("least"))
    one = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "least"))
    found = (
        found.withColumn("nth", one).where(f"nth <= {k + 1}").join(classes.select("key", "ids"), "key")
        .select("query", "score", F.explode("ids").alias("vec_id"))
    )
    each = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    lists = (
        found.withColumn("nth", each).where(f"nth <= {k + 1}")
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    )
    own = rows.where(F.col("vec_id") % every == 0).select("key", F.col("vec_id").alias("query_id")).distinct()
    answers = own.join(lists, own["key"] == lists["query"]).select(
        "query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near")
    )
    return answers.select("query_id", F.posexplode("near").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
