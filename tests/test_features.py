from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import codes
from tidemark.operators import features, labels, lookup, snapshots
from tidemark.rules import LabelRule


def month(m: int, year: int = 2024) -> dt.date:
    return dt.date(year, m, 1)


LOAN = "loan_id string, Customer_ID string, installment_num int, due_amt double, overdue_amt double, snapshot_date date"


def test_loan_delinquency_quirks(spark):
    rows = [
        ("a", "a", 3, 100.0, 150.0, month(6)),  # two instalments
        ("b", "b", 3, 0.0, 150.0, month(6)),  # nothing due: no missed date, dpd unknown
        ("c", "c", None, None, None, month(6)),  # NULL numbers count as zero
        ("d", "d", 6, 100.0, 100.0, month(3)),  # one instalment behind in March: 29 days
    ]
    got = {r["loan_id"]: r for r in labels.delinquency_columns(spark.createDataFrame(rows, LOAN)).collect()}
    assert (got["a"]["installments_missed"], got["a"]["first_missed_date"], got["a"]["dpd"]) == (2, month(4), 61)
    assert (got["b"]["installments_missed"], got["b"]["first_missed_date"], got["b"]["dpd"]) == (0, None, None)
    assert (got["c"]["mob"], got["c"]["dpd"]) == (0, 0)
    assert got["d"]["dpd"] == 29
    frame = labels.delinquency_columns(spark.createDataFrame(rows, LOAN))
    label = labels.primary_label(frame).collect()
    assert [(r["loan_id"], r["label"], r["label_def"], r["rule_version"]) for r in label] == [
        ("d", 0, "30dpd_6mob", "1.0")]


def test_null_scores_label_negative_unless_asked(spark):
    frame = spark.createDataFrame(
        [("a", 0, None, month(1)), ("b", 0, 10.0, month(1)), ("c", 1, 11.0, month(1))],
        "Customer_ID string, mob int, delinquency_score_log double, snapshot_date date",
    )
    assert {r["Customer_ID"]: r["label"] for r in labels.surrogate_label(frame).collect()} == {"a": 0, "b": 1}
    kept = labels.surrogate_label(frame, null_as_negative=False).collect()
    assert {r["Customer_ID"]: r["label"] for r in kept} == {"a": None, "b": 1}
    assert labels.surrogate_label(frame.drop("delinquency_score_log")).count() == 0


def test_risk_restricted_label(spark):
    loans = spark.createDataFrame(
        [("l1", "a", 6, 40, month(1)), ("l2", "b", 6, 40, month(1)), ("l3", "c", 6, 40, month(1))],
        "loan_id string, Customer_ID string, mob int, dpd int, snapshot_date date",
    )
    scores = spark.createDataFrame([("a", month(1), 5), ("b", month(1), 4)], "Customer_ID string, snapshot_date date, crs int")
    rule = LabelRule(crs=5)
    got = labels.primary_label(loans, rule, scores).collect()
    assert [(r["loan_id"], r["label_def"], r["rule_version"]) for r in got] == [("l1", "30dpd_6mob_5crs", "1.0_crs1.0")]
    with pytest.raises(ValueError):
        labels.primary_label(loans, rule)


@pytest.mark.parametrize("unique", [True, False])
def test_rolling_average_respects_gaps_and_missing_months(spark, unique):
    rows = [("a", month(m), float(m)) for m in (1, 2, 3, 5)] + [("b", month(1), 1.0), ("b", month(3), 3.0)]
    frame = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, v double")
    got = {
        (r["Customer_ID"], r["snapshot_date"].month): r["avg"]
        for r in features.rolling_average(frame, "v", "avg", unique=unique, months=frame.select("snapshot_date")).collect()
    }
    assert got[("a", 3)] == 2.0 and got[("b", 3)] == 2.0  # b has no February row
    assert got[("a", 1)] is None and got[("a", 2)] is None  # history too short
    assert got[("a", 5)] is None  # April does not exist at all
    free = {
        (r["Customer_ID"], r["snapshot_date"].month): r["avg"]
        for r in features.rolling_average(frame, "v", "avg", unique=unique).collect()
    }
    assert free[("a", 5)] == 4.0  # March and May


def test_rolling_average_of_repeated_rows_is_row_weighted(spark):
    frame = spark.createDataFrame(
        [("a", month(1), 1.0), ("a", month(2), 2.0), ("a", month(2), 6.0)], "Customer_ID string, snapshot_date date, v double"
    )
    got = features.rolling_average(frame, "v", "avg").where("snapshot_date = '2024-02-01'").collect()
    assert [r["avg"] for r in got] == [3.0]


def sources(spark, extra=()):
    left = spark.createDataFrame([("a", month(1), 1), ("b", month(1), 2), *extra], "Customer_ID string, snapshot_date date, x int")
    right = spark.createDataFrame(
        [("a", month(1), 10.0), ("c", month(2), 30.0), (None, month(1), 5.0)], "Customer_ID string, snapshot_date date, y double"
    )
    return {"left": left, "right": right}


def test_merge_matches_full_outer_joins(spark):
    def rows(frame):
        return sorted((tuple(r) for r in frame.select("Customer_ID", "snapshot_date", "x", "y").collect()), key=str)

    one_pass = rows(features.merge_sources(sources(spark), unique=True))
    assert one_pass == rows(features.merge_sources(sources(spark)))
    assert one_pass == rows(features.merge_sources(sources(spark), unique=False))
    assert len(one_pass) == 4


def test_merge_refuses_to_lose_rows(spark):
    repeated = sources(spark, extra=[("a", month(1), 7)])
    with pytest.raises(PySparkException, match="several rows"):
        features.merge_sources(repeated, unique=True).collect()
    assert features.merge_sources(repeated).count() == 5
    assert features.merge_sources(repeated, unique=False).count() == 5


def test_encodings(spark):
    frame = spark.createDataFrame([("a", "Auto Loan, Auto Loan, and Student Loan", 6), ("b", None, None)], "id string, t string, g int")
    counts = features.count_encode(frame, "t", list(codes.LOAN_TYPE.values()), ["id"]).collect()
    got = {r["id"]: r for r in counts}
    assert (got["a"]["Auto_Loan"], got["a"]["Student_Loan"], got["a"]["Payday_Loan"]) == (2, 1, 0)
    assert sum(got["b"][c] for c in got["b"].asDict() if c != "id") == 0
    hot = {r["id"]: list(r)[1:] for r in features.one_hot(frame, "g", range(1, 7), ["id"]).collect()}
    assert hot == {"a": [0, 0, 0, 0, 0, 1], "b": [0] * 6}


def test_lookup_ignores_case_on_request(spark):
    table = lookup.code_table(spark, codes.PAYMENT_OF_MIN_AMOUNT, "id", "label")
    frame = spark.createDataFrame([("yes",), ("No",), ("?",)], "c string")
    exact = {r["c"]: r["id"] for r in lookup.lookup(frame, table, "c", "label").collect()}
    loose = {r["c"]: r["id"] for r in lookup.lookup(frame, table, "c", "label", ignore_case=True).collect()}
    assert exact == {"yes": None, "No": 2, "?": None} and loose["yes"] == 1
    edges = lookup.ceiling_table(spark, codes.AGE_CEILINGS, "g", "ceiling").collect()
    assert len(edges) == 7 and edges[-1]["ceiling"] == float("inf")


def test_calendars(spark):
    frame = spark.createDataFrame([("2024-01-15",), ("2024-04-02",), ("nope",), (None,)], "snapshot_date string")
    bounds = snapshots.date_range(frame)
    assert tuple(bounds.first()) == (dt.date(2024, 1, 15), dt.date(2024, 4, 2))
    assert [r[0] for r in snapshots.month_spine(bounds).collect()] == [month(m) for m in (1, 2, 3, 4)]
    assert snapshots.month_spine(snapshots.date_range(frame.where("false"))).count() == 0


def test_completeness_per_dataset_and_key(spark):
    schema = "Customer_ID string, snapshot_date date"
    feats = spark.createDataFrame([("a", month(m)) for m in (1, 2, 3, 4)] + [("b", month(2))], schema)
    labs = spark.createDataFrame([("a", month(m)) for m in (7, 8, 9)] + [("b", month(8))], schema)
    ready = snapshots.completeness({"f": feats, "l": labs}, month(4), 3, n_recent=2, key="Customer_ID", label_shift={"l": 6})
    got = {r["Customer_ID"]: (r["months_complete"], r["is_ready"], r["is_recent_ready"], r["has_current"]) for r in ready.collect()}
    assert got == {"a": (3, True, True, True), "b": (1, False, False, False)}
    whole = snapshots.completeness({"f": feats, "l": labs}, month(4), 3, label_shift={"l": 6})
    run = snapshots.run_conditions(whole, month(4), month(4), month(5), month(4), month(5)).first()
    assert (run["can_train"], run["can_retrain"], run["can_infer"], run["can_monitor"]) == (True, False, True, False)
    # With no data at all the answer is "not ready", not an empty result.
    none = snapshots.completeness({"f": feats.where("false")}, month(4), 3).first()
    assert (none["months_complete"], none["is_ready"], none["has_current"]) == (0, False, False)
