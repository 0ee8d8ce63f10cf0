"""Registry, selection, deployment and retrain log through several cycles."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.operators.models import LinearModel, TrainedModel
from tidemark.operators.tree_search import TreeModel
from tidemark.plans import lifecycle
from tidemark.sources.files import upsert_history


def _register(spark, folder, rows):
    frame = spark.createDataFrame(rows, "model_name string, auc_oot double, auc_test double").withColumn(
        "path", F.concat(F.lit("bank/"), "model_name")
    )
    day = F.to_date(F.regexp_extract("model_name", r"(\d{4}_\d{2}_\d{2})$", 1), "yyyy_MM_dd")
    upsert_history(frame.withColumn("snapshot_date", day), f"{folder}/registry", ["model_name"], "snapshot_date")


def _months(row):
    return [str(d) for d in row["reference_months"]]


def test_cycles(spark, tmp_path):
    folder = str(tmp_path)
    _register(spark, folder, [("model_lr_2024_01_01", 0.9, 0.5), ("model_gbt_2024_01_01", 0.8, 0.5)])
    first = lifecycle.deploy(spark, folder, dt.date(2024, 2, 1)).collect()
    assert [(r["model_name"], r["selection_value"]) for r in first] == [("model_lr_2024_01_01", 0.9)]
    assert _months(first[0]) == ["2023-11-01", "2023-12-01"]

    # a worse model comes: the old one stays, with the months it had
    _register(spark, folder, [("model_lr_2024_02_01", None, 0.7)])
    second = {str(r["snapshot_date"]): r for r in lifecycle.deploy(spark, folder, dt.date(2024, 3, 1)).collect()}
    assert second["2024-03-01"]["model_name"] == "model_lr_2024_01_01"
    assert _months(second["2024-03-01"]) == _months(first[0]) and len(second) == 2

    # three newer ones of the family push it out; a model of the future does not compete
    _register(spark, folder, [("model_lr_2024_03_01", 0.6, 0.1), ("model_lr_2024_04_01", 0.85, 0.1), ("model_lr_2024_09_01", 0.99, 0.9)])
    for _ in range(2):
        third = {str(r["snapshot_date"]): r for r in lifecycle.deploy(spark, folder, dt.date(2024, 5, 1)).collect()}
        assert third["2024-05-01"]["model_name"] == "model_lr_2024_04_01" and len(third) == 3
        assert _months(third["2024-05-01"]) == ["2024-02-01", "2024-03-01"]


def test_retrain_log_keeps_the_last_decision(spark, tmp_path):
    schema = "model_name string, snapshot_date date, retraining boolean, reason string"
    day = dt.date(2024, 1, 1)
    lifecycle.log_decisions(spark.createDataFrame([("m", day, False, "a")], schema), str(tmp_path))
    log = lifecycle.log_decisions(spark.createDataFrame([("m", day, True, "b"), ("n", day, False, "c")], schema), str(tmp_path))
    assert {(r["model_name"], r["reason"]) for r in log.collect()} == {("m", "b"), ("n", "c")}


def test_months_are_scored_by_the_model_of_their_time(spark, tmp_path):
    """Two kinds of models, saved and deployed; months between, before and after the deployments."""
    folder, day = str(tmp_path), [dt.date(2024, k, 1) for k in range(1, 7)]
    linear = TrainedModel("model_lr", day[0], ("x", "y"), LinearModel(("x", "y"), (0.5, -1.0), 0.25), {"C": 1.0}, 0.75)
    tree = ((0, 1.0, True, 0.0), (None, None, None, -2.0), (None, None, None, 2.0))
    trees = TrainedModel("model_gbt", day[2], ("x",), TreeModel(("x",), (tree, tree)), {"max_depth": 1}, None)
    saved = {m.name: models.save(spark, m, f"{folder}/bank") for m in (linear, trees)}
    assert [models.load(spark, p) for p in saved.values()] == [linear, trees]
    frame = spark.createDataFrame([(day[1], linear.name, saved[linear.name]), (day[3], trees.name, saved[trees.name])], "snapshot_date date, model_name string, path string")
    upsert_history(frame, f"{folder}/{lifecycle.DEPLOYMENTS}", ["snapshot_date"], "snapshot_date")
    rows = [(f"c{k}{v}", d, v, 2.0, mob) for k, d in enumerate(day) for v in (None, 0.5, 3.0) for mob in (0, 1)]
    rows.append(("none", day[1], None, None, 0))
    store = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, x double, y double, mob int")
    got = {(r["Customer_ID"], r["snapshot_date"]): (r["model_name"], r["model_predictions"]) for r in lifecycle.score_months(spark, folder, store, day[:5]).collect()}

    def p(z):
        return 1 / (1 + 2.718281828459045 ** -z)

    want = {}
    for k in (1, 2):
        for v in (None, 0.5, 3.0):
            want[f"c{k}{v}", day[k]] = (linear.name, pytest.approx(p(0.25 + 0.5 * (v or 0) - 2.0)))
    for k in (3, 4):
        want[f"c{k}0.5", day[k]], want[f"c{k}3.0", day[k]] = (trees.name, pytest.approx(p(-4.0))), (trees.name, pytest.approx(p(4.0)))
    assert got == want
    with pytest.raises(KeyError):
        models.score_deployed(store, frame, {}, day)
    assert models.score_deployed(store, frame, {}, day[:1]).collect() == []
