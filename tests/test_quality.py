from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import quality, typing
from tidemark.plans import fixtures, silver

DAY = dt.date(2024, 1, 1)
ATTRIBUTES = "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date date"


def validated(spark, rows):
    frame = silver.validated_attributes(spark.createDataFrame(rows, ATTRIBUTES))
    return {r["Customer_ID"]: r for r in frame.collect()}


def test_attribute_rules(spark):
    rows = [
        ("ok", "n", "30_", "111-11-1111", "Doctor", DAY),
        ("cast", "n", "abc", "222-22-2222", "Doctor", DAY),
        ("neg", "n", "-5", "333-33-3333", "Doctor", DAY),
        ("young", "n", "17", "444-44-4444", "Doctor", DAY),
        ("old", "n", "151", "555-55-5555", "Doctor", DAY),
        ("noname", None, "30", "666-66-6666", None, DAY),
        ("same1", "n", "30", "777-77-7777", "Doctor", DAY),
        ("same2", "n", "30", "777-77-7777", "Doctor", DAY),
        ("bad1", "n", "30", "x", "____", DAY),
        ("bad2", "n", "30", None, "Doctor", DAY),
    ]
    got = validated(spark, rows)
    errors = {k: r["errors"] for k, r in got.items()}
    assert errors["ok"] == [] and got["ok"]["Age"] == 30
    assert errors["cast"] == ["TYPE_CAST_ERROR:Age:abc"]
    assert errors["neg"] == ["NEGATIVE_VALUE:Age"]
    assert errors["young"] == ["AGE_OUT_OF_RANGE:17"]
    assert errors["old"] == ["AGE_OUT_OF_RANGE:151"]
    assert errors["noname"] == ["MISSING:Name", "MISSING:Occupation"]
    # Duplicates are reported with the masked number; the unknown marker never counts.
    assert errors["same1"] == errors["same2"] == ["DUPLICATE_SSN:*****7777"]
    assert errors["bad1"] == errors["bad2"] == []
    assert got["bad1"]["Occupation"] == "Missing" and got["bad1"]["SSN"] == "Unidentified"


def test_duplicate_ids_count_within_a_snapshot_and_null_is_a_value(spark):
    later = dt.date(2024, 2, 1)
    rows = [("a", DAY, 1), ("a", DAY, 2), ("a", later, 3), (None, DAY, 4), (None, DAY, 5), ("b", DAY, 6)]
    frame = spark.createDataFrame(rows, "id string, day date, n int")
    flagged = quality.flag_repeated(frame, ["day", "id"], "dup")
    assert {r["n"] for r in flagged.collect() if r["dup"]} == {1, 2, 4, 5}
    assert flagged.count() == len(rows)


def test_hot_sentinel_and_hot_key_keep_every_row(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("none")).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(
            F.col("id").cast("string")
        ).alias("key"),
        "id",
    )
    flagged = quality.flag_repeated(frame, ["key"], "dup", ignore=F.col("key") == "none")
    counts = {(r["key"] if r["key"] in ("none", "hot") else "rest", r["dup"]): r["n"] for r in (
        flagged.withColumn("key", F.when(F.col("key").isin("none", "hot"), F.col("key")).otherwise("rest"))
        .groupBy("key", "dup").agg(F.count("*").alias("n")).collect())}
    assert counts == {("none", False): 10_000, ("hot", True): 10_000, ("rest", False): 10_000}


def test_clean_and_quarantine_are_a_partition(spark, data):
    raw = fixtures.raw_financials(spark, data)
    checked = silver.validated_financials(raw)
    clean, bad = quality.clean_rows(checked).count(), quality.quarantined_rows(checked).count()
    assert clean + bad == raw.count() and bad > 0


def test_missing_source_column_is_reported_and_typed(spark):
    frame = spark.createDataFrame([("a", "1")], "Customer_ID string, Age string")
    parsed = quality.parse(frame, schemas.ATTRIBUTES).first()
    assert parsed["_parse_errors"] == [
        "MISSING:Name", "MISSING:SSN", "MISSING:Occupation", "MISSING:snapshot_date"]
    assert parsed["Age"] == 1 and parsed["snapshot_date"] is None


def test_error_counts_take_the_type_only(spark):
    frame = spark.createDataFrame([(["A:x, y", "B:z"],), (["A:q"],), ([],)], "errors array<string>")
    assert {r["error_type"]: r["n_errors"] for r in quality.error_counts(frame).collect()} == {"A": 2, "B": 1}


def test_null_helpers(spark):
    frame = spark.createDataFrame([(None, None, 1), (None, 2, None), (3, 4, 5)], "a int, b int, c int")
    assert frame.where(quality.any_null(["a", "b"])).count() == 2
    assert typing.drop_if_all_null(frame, ["a", "b"]).count() == 2
    assert typing.fill_nulls(frame, ["a"]).first()["a"] == 0
    assert typing.pick_features(frame, ["c", "a", "zz"]) == ["a", "c"]
