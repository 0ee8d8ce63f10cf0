"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np

from tidemark.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _brute(ids, x, q, k=20):
    score = x @ x[q]
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def _answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


def test_recall_and_scores(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = table.collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = _answers(neighbours.search(table))
    queries = np.flatnonzero(ids % 20 == 0)
    assert set(found) == set(ids[queries].tolist())
    place = {int(v): i for i, v in enumerate(ids)}
    hits = 0
    for q in queries:
        got = found[int(ids[q])]
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(abs(g[2] - x[place[g[1]]] @ x[q]) < 1e-9 for g in got)
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        hits += len({g[1] for g in got} & {w[0] for w in _brute(ids, x, q)})
    assert hits / (20 * len(queries)) >= 0.9


def test_lengths_differ(spark):
    """Inner product, not angle: long vectors win."""
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((1500, 8)) * rng.lognormal(0, 1, (1500, 1))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    found = _answers(neighbours.search(table))
    ids, x = np.arange(1500), x.astype(np.float64)
    hits = sum(len({g[1] for g in found[q]} & {w[0] for w in _brute(ids, x, q)}) for q in range(0, 1500, 20))
    assert hits / (75 * 20) >= 0.9


def test_recall_in_deep_trees_with_a_large_cluster(spark):
    """20,000 vectors, a third of them nearly equal: trees of depth 7, queries in and out of the cluster."""
    rng = np.random.default_rng(4)
    n, dims = 20_000, 24
    x = rng.standard_normal((60, dims))[rng.integers(0, 60, n)] + 0.5 * rng.standard_normal((n, dims))
    crowd = np.arange(n) % 3 == 1
    x[crowd] = x[1] + 0.01 * rng.standard_normal((crowd.sum(), dims))
    x = x.astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    found = _answers(neighbours.search(table, every=100))
    ids, x = np.arange(n), x.astype(np.float64)
    recall = {True: [], False: []}
    for q in range(0, n, 100):
        recall[bool(crowd[q])].append(len({g[1] for g in found[q]} & {w[0] for w in _brute(ids, x, q)}) / 20)
    assert min(len(v) for v in recall.values()) >= 60
    assert np.mean(recall[True]) >= 0.9 and np.mean(recall[False]) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (21, [1.0, 0.0], 1), (21, [1.0, 0.0], 2), (22, [2.0, 0.0], 1),
        (40, [0.0, 0.0], 1), (60, None, 1), (80, [nan, 1.0], 1), (100, [inf, 1.0], 1), (120, [None, 1.0], 1),
        (140, [1.0, 2.0, 3.0], 1), (None, [5.0, 5.0], 1), (23, [0.0, 1.0], None), (24, [-1.0, 0.0], 1),
    ]
    found = _answers(neighbours.search(spark.createDataFrame(rows, SCHEMA)))
    want = [(1, 22, 2.0), (2, 20, 1.0), (3, 21, 1.0), (4, 23, 0.0), (5, 24, -1.0)]
    assert found == {0: want, 20: [want[0], (2, 0, 1.0), *want[2:]]}


def test_one_vector_many_times(spark):
    rows = spark.range(600).selectExpr("id as vec_id", "array(1f, 2f) as embedding", "0 as label", "id as key", "id as block")
    found = _answers(neighbours.search(rows))
    assert len(found) == 30
    assert [g[1] for g in found[0]] == list(range(1, 21))
    assert [g[1] for g in found[500]] == list(range(20))


def test_empty_and_alone(spark):
    assert neighbours.search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert neighbours.search(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).collect() == []
