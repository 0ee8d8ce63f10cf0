"""Stored states that are added up (sketches, bin counts) and deliveries with differing headers."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import drift, order_stats, sketches
from tidemark.sources import files

MONTHS = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def measured(spark):
    """Values of four months: NULL, NaN and both zeros among them; April holds nothing usable."""
    rows = spark.range(20_000).selectExpr(
        "add_months(date'2024-01-01', cast(id % 4 as int)) as snapshot_date",
        """case when id % 4 = 3 or id % 17 = 0 then null when id % 19 = 0 then double('nan')
             when id % 23 = 0 then if(id % 2 = 0, 0.0D, -0.0D) else pow(cast(id % 5003 as double), 2) end as x""",
        "if(id % 5 = 0, null, concat('t', id % 700)) as t",
    )
    return rows


def test_merged_months_against_all_rows(spark, measured, tmp_path):
    folder, shares = str(tmp_path / "sketches"), [0.0, 0.05, 0.5, 0.95, 1.0]
    for month in (MONTHS[:2], MONTHS[2:]):
        part = measured.where(F.col("snapshot_date").isin(*[F.lit(m) for m in month]))
        files.write_snapshots(sketches.sketch_months(part, ["x"], ["t"]), folder, month)
    for last in MONTHS:
        merged = sketches.merged_profile(files.read_snapshots(spark, folder, MONTHS[0], last), shares)
        found = {r["feature"]: r for r in merged.collect()}
        rows = measured.where(F.col("snapshot_date") <= F.lit(last)).toPandas()
        x = np.sort(rows["x"].dropna().to_numpy() + 0.0)
        assert (found["x"]["n"], found["x"]["missing"]) == (len(rows), len(rows) - len(x))
        assert abs(found["x"]["distinct_values"] - len(np.unique(x))) <= 0.03 * len(np.unique(x))
        for share, value in zip(shares, found["x"]["quantiles"], strict=True):
            low, high = np.searchsorted(x, value, "left") / len(x), np.searchsorted(x, value, "right") / len(x)
            assert low - 0.01 <= share <= high + 0.01
        text = rows["t"].dropna()
        assert found["t"]["quantiles"] is None and found["t"]["missing"] == len(rows) - len(text)
        assert abs(found["t"]["distinct_values"] - text.nunique()) <= 0.03 * text.nunique()


def test_sketches_of_nothing(spark, measured):
    april = sketches.sketch_months(measured.where("snapshot_date = '2024-04-01'"), ["x"])
    assert april.first()["ranks"] is None
    row = sketches.merged_profile(april, [0.5]).first()
    assert (row["n"], row["missing"], row["distinct_values"], row["quantiles"]) == (5000, 5000, 0, None)
    assert sketches.merged_profile(sketches.sketch_months(measured.limit(0), ["x"], ["t"]), [0.5]).count() == 0


def test_drift_of_counts_equals_drift_of_rows(spark, measured, tmp_path):
    rows = order_stats.unpivot(
        measured.withColumn("constant", F.lit(3.0)).withColumn("empty", F.lit(None).cast("double")),
        ["x", "constant", "empty"], ["snapshot_date"],
    )
    reference = rows.where("snapshot_date <= '2024-02-01'")
    edges = drift.bin_edges(reference)
    folder = str(tmp_path / "bins")
    for month in MONTHS:
        part = rows.where(F.col("snapshot_date") == F.lit(month))
        files.write_snapshots(drift.bin_counts(part, edges, ["snapshot_date"]), folder)
    base = files.read_snapshots(spark, folder, MONTHS[0], MONTHS[1])
    got = drift.drift_of_counts(files.read_snapshots(spark, folder), base, "m", "CSI")
    want = drift.drift_history(rows, reference, "m", "CSI")

    def table(frame):
        return {
            (r["feature"], r["snapshot_date"]): (r["n"], None if r["psi"] is None else round(r["psi"], 9), r["period_month"])
            for r in frame.collect()
        }

    assert table(got) == table(want) and got.columns == want.columns and len(table(got)) == 12


def test_a_month_reads_only_its_counts(spark, measured, tmp_path):
    rows = order_stats.unpivot(measured, ["x"], ["snapshot_date"])
    edges, folder = drift.bin_edges(rows), str(tmp_path / "bins")
    files.write_snapshots(drift.bin_counts(rows, edges, ["snapshot_date"]), folder)
    now = files.read_snapshots(spark, folder, MONTHS[2], MONTHS[2])
    base = files.read_snapshots(spark, folder, MONTHS[0], MONTHS[1])
    read = drift.drift_of_counts(now, base, "m", "CSI").inputFiles()
    assert {p.split("snapshot_date=")[1][:10] for p in read} == {"2024-01-01", "2024-02-01", "2024-03-01"}


def test_headers_of_one_folder_differ(spark, tmp_path):
    folder = tmp_path / "in [1] of%20two.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name,day\n1,x,2024-01-01\n")
    (folder / "b.csv").write_text('day,id,more,name\n2024-02-01,2,?,"y, z"\n')
    (folder / "c.csv").write_text("id,day\n3,2024-03-01\n")
    (folder / "d.csv").write_text("id,name,day\n4,w,2024-04-01\n")
    (folder / "e.csv").write_text("")
    schema = T.StructType.fromDDL("id int, name string, day date")
    path = str(folder).replace("[", "\\[").replace("]", "\\]")
    got = files.read_table(spark, path, schema)
    assert sorted(map(tuple, got.collect())) == [
        ("1", "x", "2024-01-01"), ("2", "y, z", "2024-02-01"), ("3", None, "2024-03-01"), ("4", "w", "2024-04-01")]
    with pytest.raises(ValueError, match="gone"):
        files.read_table(spark, path, T.StructType.fromDDL("id int, gone int"))
