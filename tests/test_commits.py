"""Tables changed in one commit: failures midway, side-by-side writers, repeated batches, old versions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sources import commits, files

MONTHS = [dt.date(2024, m, 1) for m in (1, 2, 3)]
SCHEMA = "v int, snapshot_date date"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, folder):
    return sorted((r["v"], r["snapshot_date"].month) for r in files.read_snapshots(spark, folder).collect())


@pytest.fixture
def table(spark, tmp_path):
    folder = str(tmp_path / "table")
    files.write_snapshots(frame(spark, [(1, MONTHS[0]), (2, MONTHS[1])]), folder)
    return folder


def test_months_change_together(spark, table):
    files.write_snapshots(frame(spark, [(7, MONTHS[0]), (8, MONTHS[2])]), table, MONTHS)
    assert content(spark, table) == [(7, 1), (8, 3)]


def test_a_write_that_dies_leaves_the_table(spark, table):
    """One month's rows reach storage, the other's fail; then the commit file is cut short."""
    rows = frame(spark, [(10, MONTHS[0]), (0, MONTHS[1])]).repartition(2)
    broken = rows.withColumn("v", F.when(F.col("v") > 0, F.col("v")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        files.write_snapshots(broken, table, MONTHS)
    assert content(spark, table) == [(1, 1), (2, 2)]
    number = commits.latest(spark, table).number
    with open(commits._file(table, number + 1), "w") as cut:
        cut.write('{"folders": ["version=')
    assert content(spark, table) == [(1, 1), (2, 2)]
    files.write_snapshots(frame(spark, [(5, MONTHS[2])]), table)
    assert content(spark, table) == [(1, 1), (2, 2), (5, 3)]
    assert commits.latest(spark, table).number == number + 2


def test_a_frame_may_replace_the_table_it_reads(spark, table):
    before = files.read_snapshots(spark, table)
    files.write_snapshots(before.withColumn("v", F.col("v") + 10), table)
    assert content(spark, table) == [(11, 1), (12, 2)]
    assert sorted(r["v"] for r in before.collect()) == [1, 2]  # the earlier version is still there


def test_the_frame_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = frame(spark, [(i, MONTHS[i % 2]) for i in range(50)]).mapInPandas(count, SCHEMA)
    files.write_snapshots(rows, str(tmp_path / "t"), MONTHS)
    assert seen.value == 50


def test_only_wanted_months_are_listed(spark, table):
    plan = files.read_snapshots(spark, table, MONTHS[0], MONTHS[0])
    assert len(plan.inputFiles()) == 1 and plan.collect()[0]["v"] == 1


def test_side_by_side_writers(spark, table, monkeypatch):
    publish, turn = commits._publish, []

    def overtaken(spark, folder, commit):
        if not turn:
            turn.append(1)
            files.write_snapshots(frame(spark, [(9, MONTHS[2])]), folder)
        return publish(spark, folder, commit)

    monkeypatch.setattr(commits, "_publish", overtaken)
    files.write_snapshots(frame(spark, [(4, MONTHS[0])]), table)
    assert content(spark, table) == [(2, 2), (4, 1), (9, 3)]
    turn.clear()
    with pytest.raises(commits.ConflictError):  # a merge must not overtake rows that it has not read
        files.upsert_history(frame(spark, [(6, MONTHS[1])]), table, ["v"], "snapshot_date")
    assert content(spark, table) == [(2, 2), (4, 1), (9, 3)]
    files.upsert_history(frame(spark, [(6, MONTHS[1])]), table, ["v"], "snapshot_date")
    assert content(spark, table) == [(2, 2), (4, 1), (6, 2), (9, 3)]


def test_a_repeated_batch_adds_nothing(spark, table):
    for number in (0, 0, 1, 0, 1):
        commits.write(frame(spark, [(20 + number, MONTHS[0])]), table, "snapshot_date", append=True, batch=("s", number))
    assert content(spark, table) == [(1, 1), (2, 2), (20, 1), (21, 1)]


def test_empty_tables_and_new_columns(spark, tmp_path):
    folder = str(tmp_path / "t")
    files.write_snapshots(frame(spark, []), folder, MONTHS)
    assert files.read_snapshots(spark, folder).columns == ["v", "snapshot_date"] and content(spark, folder) == []
    files.write_snapshots(frame(spark, [(1, MONTHS[0]), (2, None)]), folder)
    wider = spark.createDataFrame([(3, "x", MONTHS[1])], "v int, w string, snapshot_date date")
    files.write_snapshots(wider, folder)
    got = {(r["v"], r["w"], r["snapshot_date"]) for r in files.read_snapshots(spark, folder).collect()}
    assert got == {(1, None, MONTHS[0]), (2, None, None), (3, "x", MONTHS[1])}


def test_a_folder_of_another_kind_is_not_taken_over(spark, tmp_path):
    folder = str(tmp_path / "plain")
    frame(spark, [(1, MONTHS[0])]).write.partitionBy("snapshot_date").parquet(folder)
    assert content(spark, folder) == [(1, 1)]
    with pytest.raises(ValueError, match="no commit"):
        files.write_snapshots(frame(spark, [(2, MONTHS[0])]), folder)
    assert content(spark, folder) == [(1, 1)]


def test_expired_versions_go(spark, table):
    for v in range(5):
        files.write_snapshots(frame(spark, [(v, MONTHS[0])]), table)
    assert commits.expire(spark, table, keep=2) == 4
    assert content(spark, table) == [(2, 2), (4, 1)]
    assert commits.expire(spark, table, keep=2) == 0
