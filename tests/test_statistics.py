from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift, metrics, order_stats, profiling


def long_rows(spark, columns: dict[str, list]):
    rows = [(name, None if v is None else float(v)) for name, values in columns.items() for v in values]
    return spark.createDataFrame(rows, "feature string, value double")


def test_exact_quantiles_against_numpy(spark):
    random = np.random.default_rng(7)
    columns = {
        "normal": random.normal(0, 1, 3001).tolist(),
        "heavy": (random.pareto(0.3, 2000) * 1e6).tolist(),
        "ties": [0.1] * 900 + random.random(100).tolist(),
        "signs": [-1e9, -1.0, -1e-12, 0.0, 1e-12, 1.0, 1e9],
        "close": (1.0 + random.integers(0, 50, 400) * 2**-50).tolist(),
        "single": [5.0],
    }
    probabilities = [0.0, 0.05, 0.25, 0.3, 0.5, 0.75, 0.95, 1.0]
    frame = long_rows(spark, {**columns, "with_null": [None, 1.0, 2.0, None, float("nan")]})
    got = order_stats.exact_quantiles(frame, "value", probabilities, ["feature"]).collect()
    got = {r["feature"]: r for r in got}
    for name, values in columns.items():
        assert got[name]["n"] == len(values)
        np.testing.assert_allclose(got[name]["quantiles"], np.quantile(values, probabilities), rtol=1e-12)
    assert got["with_null"]["n"] == 2
    exact = order_stats.exact_quantiles(frame, "value", probabilities, ["feature"], interpolate=False).collect()
    for row in exact:
        if row["feature"] in columns:
            ordered = sorted(columns[row["feature"]])
            want = [ordered[max(math.ceil(round(p * len(ordered), 9)), 1) - 1] for p in probabilities]
            assert row["quantiles"] == want


def test_global_quantiles_and_sketch(spark):
    frame = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    assert order_stats.exact_quantiles(frame, "v", [0.5]).first()["quantiles"] == [500.0]
    sketch = order_stats.approx_quantiles(frame, ["v"], [0.25, 0.75]).first()["quantiles"]
    assert abs(sketch[0] - 250) <= 11 and abs(sketch[1] - 750) <= 11


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_all_pairs(spark):
    random = np.random.default_rng(3)
    groups = {
        "random": [(float(s), int(y)) for s, y in zip(random.random(400), random.integers(0, 2, 400))],
        "ties": [(float(s) / 5, int(y)) for s, y in zip(random.integers(0, 5, 300), random.integers(0, 2, 300))],
        "close": [(0.5 + float(s) * 2**-48, int(y)) for s, y in zip(random.integers(0, 99, 200), random.integers(0, 2, 200))],
        "wide": [(float(s), int(y)) for s, y in zip(random.normal(0, 1e6, 300), random.integers(0, 2, 300))],
        "one_class": [(0.1, 1), (0.9, 1)],
        "perfect": [(0.1, 0), (0.9, 1)],
    }
    rows = [(g, s, y) for g, pairs in groups.items() for s, y in pairs]
    frame = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r["g"]: r for r in metrics.auc_gini(frame, ["g"], "s", "y").collect()}
    for name, pairs in groups.items():
        want = brute_auc(pairs)
        if want is None:
            assert got[name]["auc"] is None and got[name]["gini"] is None
        else:
            assert got[name]["auc"] == pytest.approx(want, abs=1e-12)
            assert got[name]["gini"] == pytest.approx(2 * want - 1, abs=1e-12)
    whole = metrics.auc_gini(frame, (), "s", "y").first()
    assert whole["auc"] == pytest.approx(brute_auc([(s, y) for _, s, y in rows]), abs=1e-12)


def test_nan_scores_count_as_missing(spark):
    rows = [(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1), (math.nan, 1), (None, 0)]
    row = metrics.auc_gini(spark.createDataFrame(rows, "s double, y int"), (), "s", "y").first()
    assert (row["auc"], row["n_pos"], row["n_neg"]) == (1.0, 2, 2)


def test_predictions_meet_their_own_outcome_month(spark):
    scores = spark.createDataFrame(
        [("c", "2024-01-01", 0.9), ("c", "2024-02-01", 0.2), ("c", "2024-03-01", 0.4), ("d", "2024-01-01", 0.3)],
        "Customer_ID string, d string, model_predictions double",
    ).selectExpr("Customer_ID", "cast(d as date) as snapshot_date", "'m' as model_name", "model_predictions")
    labels = spark.createDataFrame(
        [("c", "2024-07-01", 1), ("c", "2024-07-01", 0), ("c", "2024-08-01", 0), ("e", "2024-07-01", 1)],
        "Customer_ID string, d string, label int",
    ).selectExpr("Customer_ID", "cast(d as date) as snapshot_date", "label")
    joined = [(str(r["snapshot_date"]), r["label"]) for r in metrics.join_labels(scores, labels).collect()]
    assert sorted(joined) == [("2024-01-01", 0), ("2024-01-01", 1), ("2024-02-01", 0)]
    rows = {str(r["snapshot_date"]): r for r in metrics.performance_history(scores, labels, "PROD").collect()}
    assert (rows["2024-01-01"]["n_rows"], rows["2024-01-01"]["auc"]) == (2, 0.5)
    late = rows["2024-03-01"]
    assert (late["n_rows"], late["auc"], late["accuracy"], late["n_pos"]) == (1, None, None, None)


def test_reports_keep_models_apart(spark):
    schema = "model_name string, type string, period_month string, feature string, psi double"
    rows = [(m, "CSI", p, f, x) for m, s in (("a", 1.0), ("b", 5.0)) for p in ("2024-01", "2024-02") for f, x in (("u", s), ("v", s / 2))]
    history = spark.createDataFrame(rows, schema)
    assert {(r["model_name"], r["feature"], r["max_psi"]) for r in drift.stability_summary(history).collect()} == {
        ("a", "u", 1.0), ("a", "v", 0.5), ("b", "u", 5.0), ("b", "v", 2.5)}
    top = drift.top_drifting(history, 1)
    assert {(r["model_name"], r["feature"]) for r in top.collect()} == {("a", "u"), ("b", "u")}
    assert "SinglePartition" not in top._jdf.queryExecution().executedPlan().toString()


def test_classification_clip_and_threshold(spark):
    frame = spark.createDataFrame([("m", 1.0, 1), ("m", 0.0, 1), ("m", 0.5, 1), ("m", 0.2, 0)], "g string, model_predictions double, label int")
    row = metrics.classification_metrics(frame, ["g"]).first()
    assert (row["n_rows"], row["n_pos"], row["n_neg"], row["prevalence"], row["accuracy"]) == (4, 3, 1, 0.75, 0.75)
    want = -(math.log(1 - 1e-7) + math.log(1e-7) + math.log(0.5) + math.log(0.8)) / 4
    assert row["logloss"] == pytest.approx(want, rel=1e-9)


def reference_edges(values, n=10):
    found = np.unique(np.quantile(values, np.linspace(0, 1, n + 1)))
    if len(found) < 3:
        low, high = min(values), max(values)
        if low == high:
            low, high = low - 1e-9, high + 1e-9
        found = np.linspace(low, high, n + 1)
    return found


def shares(values, edges):
    bins = [int(np.searchsorted(edges, v, side="right")) - 1 for v in values if v is not None]
    inside = [b for b in bins if 0 <= b < len(edges) - 1]
    return [inside.count(i) / len(inside) if inside else 0.0 for i in range(len(edges) - 1)]


def index(p, q):
    p, q = np.clip(p, 1e-10, 1), np.clip(q, 1e-10, 1)
    return float(np.sum((p - q) * np.log(p / q)))


def test_drift_against_brute_force(spark):
    random = np.random.default_rng(11)
    months = ["2024-01-01", "2024-02-01", "2024-03-01"]
    data = {
        "score": {m: random.beta(2 + i, 5, 200).tolist() for i, m in enumerate(months)},
        "flag": {m: random.integers(0, 2, 150).astype(float).tolist() for m in months},
        "constant": {m: [4.0] * 20 for m in months},
        "codes": {m: random.integers(1, 6, 100).astype(float).tolist() + [None] * 3 for m in months},
        "outside": {months[0]: [1.0, 2.0, 3.0, 4.0], months[1]: [100.0, 200.0], months[2]: [1.5, 9.0]},
    }
    rows = [(f, v, m) for f, by in data.items() for m, values in by.items() for v in values]
    frame = spark.createDataFrame(rows, "feature string, value double, m string").select(
        "feature", "value", F.col("m").cast("date").alias("snapshot_date"))
    reference = frame.where("snapshot_date = '2024-01-01'")
    got = drift.drift_history(frame, reference, "m", "CSI").collect()
    assert len(got) == 15
    for row in got:
        base = [v for v in data[row["feature"]][months[0]] if v is not None]
        values = data[row["feature"]][str(row["snapshot_date"])]
        edges = reference_edges(base)
        assert row["psi"] == pytest.approx(index(shares(values, edges), shares(base, edges)), abs=1e-9), row
        assert row["n"] == len(values)
        if str(row["snapshot_date"]) == months[0]:
            assert row["psi"] == 0
    assert {r["period_month"] for r in got} == {"2023-12", "2024-01", "2024-02"}


def test_bin_options(spark):
    frame = long_rows(spark, {"f": [0.0, 5.0, 10.0, 11.0, -1.0, None]})
    edges = F.array(F.lit(0.0), F.lit(5.0), F.lit(10.0))

    def bins(**options):
        return [r[0] for r in frame.withColumn("edges", edges).select(drift.bin_number(**options)).collect()]

    assert bins() == [0, 1, None, None, None, None]
    assert bins(closed_last=True) == [0, 1, 1, None, None, None]
    assert bins(open_ended=True) == [0, 1, 1, 1, 0, None]


def test_proportions_sum_to_one(spark):
    frame = spark.range(1000).select(F.lit("f").alias("feature"), (F.col("id") % 97).cast("double").alias("value"))
    found = drift.bin_proportions(frame, drift.bin_edges(frame)).first()
    assert sum(found["proportions"]) == pytest.approx(1) and found["n"] == 1000


def test_summary_needs_two_months(spark):
    schema = "model_name string, type string, period_month string, feature string, psi double"
    one = spark.createDataFrame([("m", "CSI", "2024-01", "a", 0.1)], schema)
    assert drift.stability_summary(one).count() == 0
    two = one.union(spark.createDataFrame([("m", "CSI", "2024-02", "a", 0.3), ("m", "CSI", "2024-02", "b", 0.5)], schema))
    rows = drift.stability_summary(two).collect()
    assert [(r["feature"], r["max_psi"], r["n_months"]) for r in rows] == [("b", 0.5, 1), ("a", 0.3, 2)]
    bands = [r["severity"] for r in drift.with_severity(two).orderBy("psi").collect()]
    assert bands == ["WARN", "ALERT", "ALERT"]


def test_profiles(spark):
    frame = spark.createDataFrame([("1",), ("-2",), ("x",), (None,), ("1",)], "c string")
    row = profiling.numeric_profile(frame, ["c"]).first()
    assert (row["total"], row["missing"], row["non_numeric"], row["negative"], row["min_value"], row["max_value"]) == (5, 1, 1, 1, -2.0, 1.0)
    text = profiling.string_profile(frame, ["c"]).first()
    assert (text["distinct_values"], text["repeated_values"], text["duplicate_rows"], text["missing"]) == (4, 1, 2, 1)
    bins = profiling.histogram(frame, ["c"], 2).collect()
    assert {(r["bin"], r["n"]) for r in bins} == {(0, 1), (1, 2)}
    flat = profiling.histogram(spark.createDataFrame([(3.0,), (3.0,)], "c double"), ["c"]).collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(0, 2)]


def test_winsorize_and_correlation(spark):
    frame = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * -2.0).alias("b"))
    capped = profiling.winsorize(frame, ["a"], 0.9).agg(F.max("a")).first()[0]
    assert capped == 89.0
    pairs = {(r["column_a"], r["column_b"]): r["corr"] for r in profiling.correlation_pairs(frame, ["a", "b"]).collect()}
    assert pairs[("a", "a")] == 1.0 and pairs[("a", "b")] == pytest.approx(-1) == pairs[("b", "a")]
