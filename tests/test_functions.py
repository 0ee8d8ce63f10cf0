from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import codes
from tidemark.functions import cleaning, dates, numeric
from tidemark.rules import RiskRule


def value(spark, row: dict, schema: str, expr):
    return spark.createDataFrame([tuple(row.values())], schema).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, want", [("34_", "34"), ("34__", "34_"), ("_34", "_34"), (None, None)]
)
def test_trailing_underscore(spark, raw, want):
    assert value(spark, {"c": raw}, "c string", cleaning.strip_trailing_underscore(F.col("c"))) == want


@pytest.mark.parametrize("raw, want", [("__10000__", "10000"), ("1_0", "1_0"), ("_", ""), (None, None)])
def test_outer_underscores(spark, raw, want):
    assert value(spark, {"c": raw}, "c string", cleaning.strip_outer_underscores(F.col("c"))) == want


@pytest.mark.parametrize(
    "raw, want",
    [("123-45-6789", "*****6789"), ("123456789", "Unidentified"), (None, "Unidentified")],
)
def test_ssn(spark, raw, want):
    kept = cleaning.keep_if_match(F.col("c"), codes.SSN_PATTERN, codes.SSN_UNKNOWN)
    assert value(spark, {"c": raw}, "c string", cleaning.mask_ssn(kept)) == want


@pytest.mark.parametrize("raw, want", [("____", "Missing"), ("Doctor", "Doctor"), (None, None)])
def test_occupation(spark, raw, want):
    expr = cleaning.default_if_no_match(F.col("c"), codes.HAS_LETTER_PATTERN, "Missing")
    assert value(spark, {"c": raw}, "c string", expr) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("A, B, and C", ["A", "B", "C"]),
        ("A and B", ["A", "B"]),
        ("Auto Loan", ["Auto Loan"]),
        ("", [""]),
        (None, None),
    ],
)
def test_split_list(spark, raw, want):
    assert value(spark, {"c": raw}, "c string", cleaning.split_list(F.col("c"))) == want


@pytest.mark.parametrize(
    "count, listed, want",
    [("3", "A, B", "2"), ("3_", "A, B", "2"), ("2", "A, B", "2"), ("1", None, "0"), ("x", "A", "x")],
)
def test_reconciled_count(spark, count, listed, want):
    expr = cleaning.reconciled_count(F.col("n"), F.col("l"))
    assert value(spark, {"n": count, "l": listed}, "n string, l string", expr) == want


@pytest.mark.parametrize(
    "raw, want",
    [("12 Years and 3 Months", 147), ("5 Years", 60), ("7 Months", 7), ("NA", 0), (None, None)],
)
def test_duration(spark, raw, want):
    assert value(spark, {"c": raw}, "c string", cleaning.duration_months(F.col("c"))) == want


@pytest.mark.parametrize("age, group", [(17, 1), (18, 2), (24, 2), (64, 6), (65, 7), (None, None)])
def test_bins_are_left_closed_and_null_stays_null(spark, age, group):
    assert value(spark, {"c": age}, "c int", numeric.fixed_bin(F.col("c"), codes.AGE_CEILINGS)) == group


def test_risk_score_bounds(spark):
    schema = (
        "dti double, Credit_Utilization_Ratio double, Credit_Mix_ID bigint, Credit_History_Months int, "
        "Changed_Credit_Limit double, Num_Credit_Inquiries double"
    )
    worst = (0.41, 0.51, 3, 23, 15.1, 10.1)
    edge = (0.4, 0.5, 4, 24, 15.0, 10.0)
    nothing = (None,) * 6
    rows = spark.createDataFrame([worst, edge, nothing], schema).select(numeric.risk_score(RiskRule()))
    assert [r[0] for r in rows.collect()] == [10, 0, 0]


def test_dates(spark):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), "model_x_2024_07_01.bin")], "d date, n string")
    row = frame.select(
        dates.period_month(F.col("d")).alias("p"),
        dates.performance_period(F.col("d")).alias("q"),
        dates.reference_months(F.col("d")).alias("r"),
        dates.name_date(F.col("n")).alias("nd"),
        dates.name_family(F.col("n")).alias("nf"),
    ).first()
    assert (row["p"], row["q"]) == ("2023-12", "2024-06")
    assert row["r"] == [dt.date(2023, 11, 1), dt.date(2023, 12, 1)]
    assert (row["nd"], row["nf"]) == (dt.date(2024, 7, 1), "model_x")


def test_split_dates():
    days = dates.split_dates(dt.date(2024, 3, 1))
    assert (days.train_start, days.train_end) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))
    assert (days.oot_start, days.oot_end) == (dt.date(2024, 1, 1), dt.date(2024, 2, 29))
    assert dates.shift_months(dt.date(2024, 1, 31), 1) == dt.date(2024, 2, 29)
    assert dates.shift_months(dt.date(2024, 12, 1), 1) == dt.date(2025, 1, 1)
    assert dates.shift_months(dt.date(2024, 1, 15), -1) == dt.date(2023, 12, 15)
