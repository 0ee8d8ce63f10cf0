"""Files to decisions: sources, layers month by month and at once, models, monitoring, streaming."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import dataset, models
from tidemark.plans import fixtures, medallion, monitoring
from tidemark.session import checkpointed
from tidemark.sources import files
from tidemark.streaming import ingest

MONTHS = [dt.date(2023, m, 1) for m in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def deliveries(spark, data, tmp_path_factory):
    """CSV files of all four sources, months 2023-01 to 2023-04, plus a row without a date."""
    root = tmp_path_factory.mktemp("raw")
    makers = {
        "fe_attributes": fixtures.raw_attributes,
        "fe_financials": fixtures.raw_financials,
        "fe_clickstream": fixtures.raw_clickstream,
        "lms": fixtures.raw_loans,
    }
    paths = {}
    for source, make in makers.items():
        frame = make(spark, data).where(F.col("snapshot_date") <= F.lit(MONTHS[-1]))
        frame = frame.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
        broken = frame.limit(1).withColumn("snapshot_date", F.lit("no date"))
        paths[source] = str(root / f"{source}.csv")
        files.write_csv(frame.unionByName(broken), paths[source])
    return paths


@pytest.fixture(scope="module")
def backfill(spark, deliveries, tmp_path_factory):
    layout = medallion.Layout(str(tmp_path_factory.mktemp("all")))
    medallion.run(spark, deliveries, layout)
    return layout


def rows(frame):
    return sorted(str(sorted(r.asDict().items())) for r in frame.collect())


def test_monthly_batches_equal_the_backfill(spark, deliveries, backfill, tmp_path):
    monthly = medallion.Layout(str(tmp_path))
    for day in MONTHS:
        medallion.run(spark, deliveries, monthly, day)
    for name in ("feature_store", "label_surrogate", "loan_type_counts", "income_one_hot"):
        once = files.read_snapshots(spark, backfill.gold(name))
        step = files.read_snapshots(spark, monthly.gold(name))
        assert once.count() > 0 and rows(once) == rows(step), name
    assert rows(medallion.quarantine_report(spark, backfill)) == rows(medallion.quarantine_report(spark, monthly))


def test_backfill_loses_nothing(spark, deliveries, backfill):
    for source in ("fe_attributes", "fe_financials"):
        raw = files.read_table(spark, deliveries[source], schemas.SOURCES[source])
        clean = files.read_snapshots(spark, backfill.silver(source)).count()
        bad = files.read_snapshots(spark, backfill.quarantine(source)).count()
        assert clean + bad == raw.count() - 1
    store = files.read_snapshots(spark, backfill.gold("feature_store"))
    assert store.groupBy("Customer_ID", "snapshot_date").count().where("count > 1").count() == 0
    assert "SSN" not in files.read_snapshots(spark, backfill.silver("fe_attributes")).columns
    assert spark.read.parquet(backfill.code_table("loan_type")).count() == 9


def test_rerun_replaces_only_its_month(spark, deliveries, backfill):
    before = rows(files.read_snapshots(spark, backfill.gold("feature_store")))
    medallion.run(spark, deliveries, backfill, MONTHS[2])
    assert rows(files.read_snapshots(spark, backfill.gold("feature_store"))) == before


def test_missing_deliveries_give_null_features(spark, deliveries, tmp_path):
    layout = medallion.Layout(str(tmp_path))
    only = {"fe_clickstream": str(tmp_path / "none.csv"), "lms": deliveries["lms"]}
    medallion.run(spark, only, layout, MONTHS[0])
    store = files.read_snapshots(spark, layout.gold("feature_store"))
    assert store.count() > 0 and store.where("crs is not null or fe_1 is not null").count() == 0
    assert {"crs", "fe_20", "Age_Group", "savings_rate_avg_3m"} <= set(store.columns)
    assert medallion.quarantine_report(spark, layout).count() == 0


def test_partition_pruning_and_pushdown(spark, backfill, data):
    one = files.read_snapshots(spark, backfill.gold("feature_store"), MONTHS[1], MONTHS[1]).select("crs")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<crs:int>" in plan
    orders = fixtures.table(spark, data, "orders")
    from tidemark.operators import snapshots

    ranged = snapshots.in_month(orders, dt.date(1997, 3, 1), "o_orderdate").select("o_orderkey")
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_readers(spark, deliveries, backfill, tmp_path):
    with pytest.raises(ValueError):
        files.read_table(spark, "table.xlsx")
    gone = files.read_or_empty(spark, str(tmp_path / "none.parquet"), schemas.LOANS)
    assert gone.count() == 0 and gone.columns == schemas.LOANS.fieldNames()
    text = files.read_table(spark, deliveries["lms"], schemas.LOANS)
    assert {kind for _, kind in text.dtypes} == {"string"}
    folder = backfill.silver("fe_financials")
    assert files.read_last_months(spark, folder, MONTHS[2]).select("snapshot_date").distinct().count() == 3
    assert files.read_last_months(spark, folder, MONTHS[1]).count() == 0


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("snapshot_date,Customer_ID\n2024-01-01,a\n")
    small = schemas.T.StructType([schemas.ATTRIBUTES["Customer_ID"], schemas.ATTRIBUTES["snapshot_date"]])
    got = files.read_table(spark, str(path), small)
    assert got.columns == ["Customer_ID", "snapshot_date"] and got.first() == ("a", "2024-01-01")
    with pytest.raises(ValueError, match="loan_id"):
        files.read_table(spark, str(path), schemas.LOANS)


def test_history_upsert_rewrites_touched_periods(spark, tmp_path):
    schema = "model_name string, feature string, psi double, period_month string"
    folder, keys = str(tmp_path / "history"), ["model_name", "feature", "period_month"]
    first = spark.createDataFrame([("m", "a", 0.1, "2024-01"), ("m", "b", 0.2, "2024-01"), ("m", "a", 0.3, "2024-02")], schema)
    assert files.upsert_history(first, folder, keys).count() == 3
    again = spark.createDataFrame([("m", "a", 0.9, "2024-01"), ("m", "a", 0.5, "2024-03")], schema)
    got = {(r["feature"], r["period_month"]): r["psi"] for r in files.upsert_history(again, folder, keys).collect()}
    assert got == {("a", "2024-01"): 0.9, ("b", "2024-01"): 0.2, ("a", "2024-02"): 0.3, ("a", "2024-03"): 0.5}


def test_first_history_write_keeps_the_last_of_each_key(spark, tmp_path):
    rows = [("m", "a", 0.1, "2024-01"), ("m", "a", 0.2, "2024-01"), ("m", "b", 0.3, "2024-01")]
    first = spark.createDataFrame(rows, "model_name string, feature string, psi double, period_month string").coalesce(1)
    got = files.upsert_history(first, str(tmp_path / "h"), ["model_name", "feature", "period_month"])
    assert {(r["feature"], r["psi"]) for r in got.collect()} == {("a", 0.2), ("b", 0.3)}


def test_a_month_that_comes_out_empty_loses_its_rows(spark, tmp_path):
    folder = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, MONTHS[0]), (2, MONTHS[1])], "v int, snapshot_date date")
    files.write_snapshots(rows, folder)
    files.write_snapshots(rows.where("v > 5"), folder, [MONTHS[1], MONTHS[2]])
    assert [r["v"] for r in files.read_snapshots(spark, folder).collect()] == [1]


def test_rerun_without_clean_rows_empties_all_layers(spark, deliveries, tmp_path):
    layout = medallion.Layout(str(tmp_path / "lake"))
    medallion.run(spark, deliveries, layout, MONTHS[0])
    again = {}
    for source, path in deliveries.items():
        again[source] = str(tmp_path / f"{source}.csv")
        frame = spark.read.option("header", True).csv(path).where("snapshot_date = '2023-01-01'")
        if source == "fe_attributes":
            frame = frame.withColumn("Customer_ID", F.lit(None).cast("string"))
        if source == "lms":
            frame = frame.withColumn("installment_num", F.lit("3"))
        files.write_csv(frame, again[source])
    quarantined = files.read_snapshots(spark, layout.quarantine("fe_attributes")).count()
    medallion.run(spark, again, layout, MONTHS[0])
    assert files.read_snapshots(spark, layout.quarantine("fe_attributes")).count() > quarantined
    empty = spark.createDataFrame([], "Customer_ID string, snapshot_date date")
    assert files.read_snapshots(spark, layout.silver("fe_attributes"), schema=empty.schema).count() == 0
    assert files.read_snapshots(spark, layout.gold("label_surrogate"), schema=empty.schema).count() == 0


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    spark.range(5).selectExpr(*[f"cast(id as string) as {c}" for c in schemas.LOANS.fieldNames()[:-1]], "'2024-01-01' as snapshot_date").write.option("header", True).csv(landing)

    def catch_up():
        query = ingest.ingest_available(ingest.incoming_rows(spark, landing, schemas.LOANS), table, state)
        assert query.awaitTermination(60)
        return files.read_snapshots(spark, table)

    assert catch_up().count() == 5
    assert catch_up().count() == 5
    spark.range(3).selectExpr(*[f"cast(id as string) as {c}" for c in schemas.LOANS.fieldNames()[:-1]], "if(id = 0, 'bad', '2024-02-01') as snapshot_date").write.mode("append").option("header", True).csv(landing)
    after = catch_up()
    assert {(str(r["snapshot_date"]), r["count"]) for r in after.groupBy("snapshot_date").count().collect()} == {
        ("2024-01-01", 5), ("2024-02-01", 2)}


@pytest.fixture(scope="module")
def split_frame(spark):
    """A store of two informative features over 15 months with its split."""
    store = spark.range(3000).selectExpr(
        "concat('C', id) as Customer_ID",
        "add_months(date'2023-01-01', cast(id % 15 as int)) as snapshot_date",
        "0 as mob",
        "cast((id * 7919) % 1000 as double) as x",
        "if(id % 10 = 0, null, cast((id * 104729) % 777 as double)) as y",
    )
    primary = store.selectExpr(
        "Customer_ID", "add_months(snapshot_date, 6) as snapshot_date", "cast(x + coalesce(y, 0) / 2 + (xxhash64(Customer_ID) % 200) > 800 as int) as label")
    surrogate = store.selectExpr("Customer_ID", "snapshot_date", "1 as label")
    data = checkpointed(dataset.training_set(store, primary, surrogate, ["x", "y"]))
    return store, primary, checkpointed(dataset.split_train_test_oot(data, dt.date(2024, 3, 1)))


def test_split_is_exact_per_label(split_frame):
    _, _, split = split_frame
    counts = {(r["split"], r["label"]): r["count"] for r in split.groupBy("split", "label").count().collect()}
    for label in (0, 1):
        test, train = counts[("test", label)], counts[("train", label)]
        assert test == -(-(test + train) // 5)
    assert {str(r[0])[:7] for r in split.where("split = 'oot'").select("snapshot_date").distinct().collect()} == {"2024-01", "2024-02"}


def test_unlabelled_rows_are_marked_and_leave_before_the_split(spark, split_frame):
    store, primary, _ = split_frame
    data = dataset.training_set(store, primary.where("label = 1"), primary.limit(0), ["x", "y"])
    assert data.where("label is null and label_missing = 1").count() == data.where("label is null").count() > 0
    split = dataset.split_train_test_oot(data, dt.date(2024, 3, 1))
    assert split.where("label is null").count() == 0


def test_scaling_is_fitted_on_train_rows(spark, split_frame):
    _, _, split = split_frame
    with_constant = split.withColumn("one", F.lit(1.0))
    scaled = dataset.standard_scale(with_constant, ["x", "one"], F.col("split") == "train", ["split"])
    row = scaled.where("split = 'train'").agg(F.avg("x"), F.stddev_pop("x"), F.max("one")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0


def test_parameter_draws_do_not_repeat():
    draws = models.draw_params(models.LR_SPACE, models.LR_DRAWS)
    assert len({str(d) for d in draws}) == 40 and draws == models.draw_params(models.LR_SPACE, 40)
    assert len(models.draw_params(models.GBT_SPACE, 10_000)) == 1728


def test_model_loop(spark, split_frame, tmp_path):
    store, primary, split = split_frame
    day = dt.date(2024, 3, 1)
    model = models.train("model_lr", split, ["x", "y"], day, n_draws=2)
    again = models.train("model_lr", split, ["x", "y"], day, n_draws=2)
    assert model.cv_auc == again.cv_auc > 0.9
    results = models.evaluate(model, split)
    got = {r["split"]: r["auc"] for r in results.collect()}
    assert min(got.values()) > 0.9
    assert got == {r["split"]: r["auc"] for r in models.evaluate(again, split).collect()}

    row = models.registry_row(model, results, dataset.split_stats(split)).first()
    assert row["model_name"] == "model_lr_2024_03_01" and row["auc_oot"] == got["oot"]
    loaded = models.load(spark, models.save(spark, model, str(tmp_path / "bank")))
    assert loaded == model

    reference, current = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)], dt.date(2024, 3, 1)
    run = monitoring.monitor(loaded, store, primary, current, reference, str(tmp_path / "monitor"))
    assert run.predictions.count() == 600
    assert {(r["type"], r["feature"]) for r in run.stability.collect()} == {
        ("PSI", "model_predictions"), ("CSI", "x"), ("CSI", "y")}
    assert run.performance.first()["n_rows"] == 200 and run.performance.first()["auc"] > 0.9
    assert run.decision.count() == 1
    rerun = monitoring.monitor(loaded, store, primary, current, reference, str(tmp_path / "monitor"))
    assert rerun.stability.count() == 3 and rerun.performance.count() == 1 and rerun.scores.count() == 1
    early = monitoring.monitor(loaded, store, primary.limit(0), current, reference, str(tmp_path / "early"))
    row = early.performance.first()
    assert row["n_rows"] == 200 and row["auc"] is None and row["n_pos"] is None
    assert early.scores.first()["score_mean"] > 0


def test_boosted_trees_take_missing_values(spark, split_frame, tmp_path):
    _, _, split = split_frame
    model = models.train("model_gbt", split, ["x", "y"], dt.date(2024, 3, 1), n_draws=2)
    assert set(model.params) == set(models.GBT_SPACE) and model.cv_auc > 0.8
    assert models.evaluate(model, split).where("split = 'test'").first()["auc"] > 0.8
    assert models.load(spark, models.save(spark, model, str(tmp_path))) == model
