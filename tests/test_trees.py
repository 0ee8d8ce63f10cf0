"""Boosted trees grown from histograms against a plain version, and their expression."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, tree_search
from tidemark.session import stored

N, FEATURES = 400, ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    """Few and many values, missing ones with a meaning, a constant and a column of NULL only."""
    rng = np.random.default_rng(12)
    a, b = rng.normal(size=N), rng.integers(0, 5, N).astype(float)
    y = ((a > 0.2) ^ (b > 2)).astype(int)
    gone = rng.random(N) < 0.15
    y[gone] = 1
    rows = [
        (int(y[i]), int(rng.integers(0, 3)), float(rng.random()), None if gone[i] else float(a[i]), float(b[i]), 1.0, None)
        for i in range(N)
    ]
    return stored(spark.createDataFrame(rows, "label int, fold int, hash double, a double, b double, c double, d double").repartition(4))


def _plain(frame, cuts, problem):
    """Trees by the definition, one node after the other: margins of all rows and the nodes of each tree."""
    p, n = problem.params, len(frame)
    x = frame[FEATURES].to_numpy(float)
    y, fold, h = frame["label"].to_numpy(float), frame["fold"].to_numpy(), frame["hash"].to_numpy()
    margin, trees = np.zeros(n), []

    def soft(g):
        return np.sign(g) * max(abs(g) - p["reg_alpha"], 0)

    def worth(g, h):
        return soft(g) ** 2 / (h + p["reg_lambda"])

    for t in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-margin))
        g, c = prob - y, prob * (1 - prob)
        turned = h + problem.turn(t)
        used = (fold != problem.fold) & (turned - np.floor(turned) < p["subsample"])
        nodes, node = {}, np.zeros(n, int)
        todo = [(0, 0)]
        while todo:
            i, level = todo.pop(0)
            at = used & (node == i)
            G, H = g[at].sum(), c[at].sum()
            nodes[i] = -soft(G) / (H + p["reg_lambda"]) * p["learning_rate"]
            best = (max(1e-6, p["gamma"] - 1e-12), None)
            if level < p["max_depth"]:
                for j in problem.columns(t, len(FEATURES)):
                    for cut in [*cuts[j], np.inf]:
                        for missing_left in (False, True):
                            left = np.where(np.isnan(x[:, j]), missing_left, x[:, j] < cut)
                            gl, hl = g[at & left].sum(), c[at & left].sum()
                            if min(hl, H - hl) < p["min_child_weight"]:
                                continue
                            gain = worth(gl, hl) + worth(G - gl, H - hl) - worth(G, H)
                            if gain > best[0] + 1e-9:
                                best = (gain, left)
            if best[1] is not None:
                node = np.where(node == i, np.where(best[1], 2 * i + 1, 2 * i + 2), node)
                todo += [(2 * i + 1, level + 1), (2 * i + 2, level + 1)]
        margin = margin + np.array([nodes[k] for k in node])
        trees.append(nodes)
    return margin


DRAWS = [
    {"n_estimators": 4, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.8, "gamma": 0, "min_child_weight": 1, "reg_alpha": 0, "reg_lambda": 1},
    {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.6, "colsample_bytree": 0.6, "gamma": 0.1, "min_child_weight": 5, "reg_alpha": 1, "reg_lambda": 2},
]


@pytest.mark.parametrize("every", [10, 1])
def test_trees_equal_the_plain_version(table, monkeypatch, every):
    monkeypatch.setattr(tree_search, "WRITTEN_EVERY", every)
    ready, cuts = tree_search.prepared(table, FEATURES)
    problems = tree_search.fold_problems(DRAWS, 3)
    search = tree_search.Search(ready, len(FEATURES), problems)
    search.fit()
    got = {}
    for r in search.scores().collect():
        got.setdefault(r["problem"], []).append(r["score"])
    frame = table.toPandas()
    for m, p in enumerate(problems):
        want = _plain(frame, cuts, p)[(frame["fold"] == p.fold).to_numpy()]
        assert np.allclose(sorted(got.get(m, [])), sorted(want), atol=1e-9)


def test_the_model_is_the_winner_on_all_rows(table):
    found = tree_search.search(table, FEATURES, DRAWS, 3)
    assert found.aucs[found.best] == max(found.aucs) > 0.6
    frame, cuts = table.toPandas(), tree_search.find_cuts(table, FEATURES)
    want = 1 / (1 + np.exp(-_plain(frame, cuts, tree_search.Problem(DRAWS[found.best], tree_search.ALL, found.best))))
    got = [r[0] for r in table.select(found.model.probability()).collect()]
    assert np.allclose(sorted(got), sorted(want))
    odd = table.sparkSession.createDataFrame([(float("nan"), 1.0, 1.0, None), (None, 1.0, 1.0, None)], "a double, b double, c double, d double")
    assert len({r[0] for r in odd.select(found.model.probability()).collect()}) == 1
    assert models.fitted_from(FEATURES, found.model.as_json()) == found.model


def test_cuts_are_values_at_even_shares(table):
    cuts = tree_search.find_cuts(table, FEATURES)
    values = np.sort(table.toPandas()["a"].dropna().to_numpy())
    want = sorted({values[int(np.ceil(round((i + 1) / 32 * len(values), 9))) - 1] for i in range(31)})
    assert cuts[0] == want and cuts[1] == [0.0, 1.0, 2.0, 3.0, 4.0] and cuts[2] == [1.0] and cuts[3] == []


@pytest.mark.parametrize("labels", [[], [1] * 9, [0, 1]])
def test_odd_training_sets(spark, labels):
    rows = stored(spark.createDataFrame([(y, i % 3, i / 10, float(i)) for i, y in enumerate(labels)], "label int, fold int, hash double, a double"))
    found = tree_search.search(rows, ["a"], DRAWS, 3)
    scored = rows.select(found.model.probability().alias("p")).where(F.col("p").between(0, 1))
    assert scored.count() == len(labels)
