from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import decision, history
from tidemark.rules import PerformanceLimits

DAY = dt.date(2024, 3, 1)


def registry(spark):
    rows = []
    for n in range(12):
        family = "model_lr" if n % 2 else "model_gbt"
        name = f"{family}_2024_{n // 2 + 1:02d}_01"
        rows.append((name, None if n % 5 == 0 else (n * 37 % 100) / 100, (n * 53 % 100) / 100))
    frame = spark.createDataFrame(rows, "model_name string, auc_oot double, auc_test double")
    return frame.withColumns({"family": dates.name_family(F.col("model_name")), "day": dates.name_date(F.col("model_name"))})


def test_best_of_recent_models(spark):
    best = history.best_of_recent(registry(spark), [], ["family"], [F.desc("day")], "auc_oot", "auc_test").collect()
    candidates = [(n, (n * 53 % 100) / 100 if n % 5 == 0 else (n * 37 % 100) / 100) for n in range(6, 12)]
    want = max(candidates, key=lambda c: c[1])
    assert best[0]["selection_value"] == want[1] and best[0]["day"].month == want[0] // 2 + 1


def test_ties_go_to_the_first_family_and_newest_row(spark):
    rows = [("b", 2, 0.7, 0.1), ("a", 1, 0.7, 0.1), ("a", 2, 0.7, 0.1), ("a", 3, None, None)]
    frame = spark.createDataFrame(rows, "family string, day int, m double, f double")
    best = history.best_of_recent(frame, [], ["family"], [F.desc("day")], "m", "f").first()
    assert (best["family"], best["day"]) == ("a", 2)


def test_upsert_keeps_the_last_write(spark):
    schema = "k string, v int, ingest_seq int"
    old = spark.createDataFrame([("a", 1, 0), ("b", 1, 0)], schema)
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("c", 4, 1)], schema)
    kept = {r["k"]: r["v"] for r in history.upsert_keep_last(old, new, ["k"]).collect()}
    assert kept == {"a": 3, "b": 1, "c": 4}


def test_rank_filters_are_cut_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = history.first_rows(frame, ["k"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_carry_forward_across_slices(spark):
    generator = random.Random(5)
    rows = [(u, t, generator.choice("AB")) for u in ("hot", "cold", None) for t in range(60 if u == "hot" else 7)]
    frame = spark.createDataFrame(rows, "u string, t int, s string")
    want = {}
    for u in ("hot", "cold", None):
        carried = last = None
        for _, t, s in sorted(r for r in rows if r[0] == u):
            if last is None or s != last:
                carried = t
            last = s
            want[(u, t)] = (carried, carried == t)
    for width in (1, 4, 1000):
        got = history.carry_forward(frame, "u", ["t"], "s", F.col("t"), F.floor(F.col("t") / width)).collect()
        assert {(r["u"], r["t"]): (r["carried"], r["is_new"]) for r in got} == want


def test_carried_null_value_is_not_replaced(spark):
    rows = [("k", 1, "A", 5), ("k", 2, "B", None), ("k", 3, "B", 7), ("k", 4, "B", 8)]
    frame = spark.createDataFrame(rows, "k string, t int, s string, v int")
    got = history.carry_forward(frame, "k", ["t"], "s", F.col("v"), F.floor(F.col("t") / 2)).orderBy("t").collect()
    assert [r["carried"] for r in got] == [5, None, None, None]


PERF = "model_name string, snapshot_date date, period_tag string, auc double, gini double, accuracy double, logloss double"
STAB = "model_name string, type string, period_month string, feature string, psi double"


def decide(spark, perf, stab, **options):
    runs = spark.createDataFrame([("m", DAY)], "model_name string, snapshot_date date")
    out = decision.retrain_decision(runs, spark.createDataFrame(perf, PERF), spark.createDataFrame(stab, STAB), **options)
    return tuple(out.first())[2:]


GOOD = [("m", DAY, "PROD", 0.7, 0.4, 0.8, 0.5)]


def test_decision(spark):
    nothing = "No thresholds breached or no label yet."
    assert decide(spark, GOOD, []) == (False, nothing)
    assert decide(spark, [], []) == (False, nothing)
    assert decide(spark, [("m", DAY, "PROD", None, None, 0.8, 0.5)], []) == (False, nothing)
    assert decide(spark, [("m", DAY, "OOT", 0.1, -0.8, 0.1, 0.9)], []) == (False, nothing)
    bad = [("m", DAY, "PROD", 0.5, 0.0, 0.8, 0.7)]
    assert decide(spark, bad, []) == (True, "auc 0.500 < 0.62; gini 0.000 < 0.24; logloss 0.700 > 0.6")
    assert decide(spark, bad, [], limits=PerformanceLimits(0.4, -1, 0.1, 0.9)) == (False, nothing)
    drifted = [("m", "CSI", "2024-02", "a", 0.3), ("m", "CSI", "2024-02", "b", 0.1), ("m", "PSI", "2024-01", "s", 0.9)]
    assert decide(spark, GOOD, drifted) == (True, "max CSI 0.300 ≥ 0.25")
    assert decide(spark, GOOD, drifted, policy=["psi_alert"]) == (False, "max CSI 0.300 ≥ 0.25")
    assert decide(spark, GOOD, drifted, policy=["psi_alert"], shared_drift_flag=True)[0] is True
    refused = decide(spark, bad, [], retrain_from=dt.date(2024, 5, 1))
    assert refused[0] is False and refused[1].startswith("Retraining not allowed.")
