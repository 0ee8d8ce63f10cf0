"""Batched regression search, many train dates, stored training sets."""

from __future__ import annotations

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import dataset, linear_search, models, sums
from tidemark.session import stored

N, P = 1500, 6
FEATURES = [f"f{i}" for i in range(P)]


@pytest.fixture(scope="module")
def table(spark):
    """Correlated, repeated and constant features, some of them without influence."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(N, P)) * [1, 10, 0.1, 1, 1, 1] + [0, 50, 0, 0, 0, 3]
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    x[:, 4], x[:, 5] = x[:, 1], 3.0
    y = (x[:, 0] + x[:, 1] / 10 + rng.logistic(size=N) > 6.3).astype(int)
    rows = [(int(a), int(i % 3), *map(float, r)) for i, (a, r) in enumerate(zip(y, x, strict=True))]
    return stored(spark.createDataFrame(rows, f"label int, fold int, {', '.join(f'{c} double' for c in FEATURES)}").repartition(5))


def _solved(table, problems):
    by = linear_search.scaling(table, FEATURES)
    rows = linear_search.scaled(table, FEATURES, by)
    search = linear_search.Search(rows, P, problems)
    return rows, search, search.solve()


def test_gradients_vanish_in_sql(table):
    """Every draw and fold: the penalised gradient at the weights, computed by another engine."""
    draws = models.draw_params(models.LR_SPACE, 48)
    problems = linear_search.fold_problems(draws, 3)
    rows, _, beta = _solved(table, problems)
    con = duckdb.connect()
    frame = rows.toPandas()
    con.register("rows", frame)
    for p, b in list(zip(problems, beta, strict=True))[::7]:
        z = " + ".join(f"{v!r} * x{i}" for i, v in enumerate(b[:-1].tolist())) + f" + {float(b[-1])!r}"
        balanced = "count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label))" if p.balanced else "1.0"
        xs = [f"x{i}" for i in range(P)] + ["1.0"]
        gradient = con.execute(
            f"SELECT {', '.join(f'sum(w * (1 / (1 + exp(-z)) - label) * {x})' for x in xs)} "
            f"FROM (SELECT *, {z} AS z, {balanced} AS w FROM rows WHERE fold <> {p.fold})"
        ).fetchone()
        for g, v in zip(gradient, b.tolist(), strict=True):
            if not p.l1:
                assert abs(p.C * g + v) <= 1e-6 * max(1, p.C)
            elif v:
                assert abs(p.C * g + np.sign(v)) <= 1e-6 * max(1, p.C)
            else:
                assert abs(p.C * g) <= 1 + 1e-6


def test_no_other_point_is_better(table):
    problems = [linear_search.Problem(0.05, l1, b) for l1 in (True, False) for b in (True, False)]
    _, search, beta = _solved(table, problems)
    every = np.arange(len(problems))

    def value(at):
        loss, _, _ = search.sums(at, every)
        return search.C * loss + np.where(search.l1, np.abs(at).sum(1), (at**2).sum(1) / 2)

    best, rng = value(beta), np.random.default_rng(1)
    for size in (1e-3, 0.1, 1.0):
        assert (value(beta + size * rng.normal(size=beta.shape)) >= best).all()
    assert (beta[:2] == 0).any() and not (beta[2:, :3] == 0).any()


def test_scores_rank_like_another_solver(spark, table):
    """The other solver leaves the constant free of penalty, so ranks and not weights are compared."""
    problem = linear_search.Problem(1.0, False, False, 0)
    rows, _, beta = _solved(table, [problem])
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(P)], outputCol="features").transform(rows)
    fit = LogisticRegression(regParam=1.0 / (1.0 * N * 2 / 3), standardization=False, tol=1e-10, maxIter=500).fit(vectors.where("fold <> 0"))
    assert np.abs(np.array(fit.coefficients) - beta[0, :-1]).max() < 0.01


def test_search_takes_the_best_mean_auc(table):
    draws = models.draw_params(models.LR_SPACE, 6)
    found = linear_search.search(table, FEATURES, draws, 3)
    assert found.aucs[found.best] == max(found.aucs) > 0.75
    again = linear_search.search(table, FEATURES, draws, 3)
    assert (found.beta == again.beta).all() and found.aucs == again.aucs
    frame = table.toPandas()
    x = (frame[FEATURES].to_numpy() - found.scaling.mean) / found.scaling.spread
    weights, constant = found.scaling.raw(found.beta)
    assert np.allclose(x @ found.beta[:-1] + found.beta[-1], frame[FEATURES].to_numpy() @ weights + constant)
    # the mean of the folds' areas by all pairs
    _, _, beta = _solved(table, linear_search.fold_problems([draws[found.best]], 3))
    areas = []
    for fold in range(3):
        inside = (frame["fold"] == fold).to_numpy()
        z, y = x[inside] @ beta[fold, :-1] + beta[fold, -1], frame["label"].to_numpy()[inside]
        gap = z[y == 1][:, None] - z[y == 0]
        areas.append(((gap > 0).mean() + (gap == 0).mean() / 2))
    assert found.aucs[found.best] == pytest.approx(np.mean(areas))


@pytest.mark.parametrize("labels", [[], [1] * 9, [0] * 9, [0, 1]])
def test_odd_training_sets(spark, labels):
    """No rows, one class, a row each: the search ends and gives finite weights."""
    rows = stored(spark.createDataFrame([(y, i % 3, float(i)) for i, y in enumerate(labels)], "label int, fold int, x double"))
    found = linear_search.search(rows, ["x"], models.draw_params(models.LR_SPACE, 4), 3)
    assert np.isfinite(found.beta).all() and len(found.aucs) == 4


def test_partials_are_added_level_by_level(spark, monkeypatch):
    rows = spark.range(1000).select(F.col("id").cast("double").alias("v")).repartition(40)
    monkeypatch.setattr(sums, "FAN_IN", 3)

    def work(batches):
        return np.array([sum(np.asarray(b.column(0)).sum() for b in batches), 1.0])

    assert sums.parts_of(rows) == 40
    assert sums.summed(rows, work, 2, 40).tolist() == [999 * 500.0, 40.0]
    assert sums.summed(rows.where("v < 0"), lambda b: np.zeros(2), 2, 1).tolist() == [0.0, 0.0]


def test_many_dates_split_like_one_at_a_time(spark):
    data = stored(spark.range(4000).selectExpr(
        "concat('C', id) as Customer_ID", "add_months(date'2022-11-01', cast(id % 20 as int)) as snapshot_date",
        "if(id % 9 = 0, null, cast(id * 7919 % 5 = 0 as int)) as label"))
    days = [dt.date(2024, 1, 1), dt.date(2024, 3, 1), dt.date(2024, 8, 1), dt.date(2030, 1, 1)]
    many, cuts = dataset.split_many(data, days)
    for day in days:
        one = dataset.split_train_test_oot(data, day)
        got = many.where(F.col("train_date") == F.lit(day)).drop("train_date")
        assert sorted(map(str, got.collect())) == sorted(map(str, one.select(got.columns).collect()))
    assert {r["train_date"] for r in cuts.collect()} == set(days[:3])
    with pytest.raises(ValueError):
        dataset.split_many(many, days)


def test_one_scan_for_all_dates(spark):
    data = stored(spark.createDataFrame([("a", dt.date(2023, 5, 1), 1)], "Customer_ID string, snapshot_date date, label int"))
    plans = [
        dataset.split_many(data, days)[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
        for days in ([dt.date(2024, 3, 1)], [dt.date(2024, k, 1) for k in range(1, 13)])
    ]
    assert plans[0] == plans[1] <= 4
