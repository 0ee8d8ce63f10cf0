"""Point-in-time training sets, stratified splits and scaling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import shift_months, split_dates
from tidemark.operators.lookup import join_one_row
from tidemark.operators.order_stats import exact_quantiles
from tidemark.operators.typing import drop_if_all_null, pick_features
from tidemark.rules import TrainingWindow


def training_set(
    features: DataFrame,
    primary: DataFrame,
    surrogate: DataFrame,
    wanted: Sequence[str],
    label_shift: int = 6,
) -> DataFrame:
    """Month-0 features, the primary label `label_shift` months later, the surrogate label now.

    Missing labels stay NULL and are marked. Rows without any wanted feature are dropped.
    """
    at_start = features.where(F.col("mob") == 0).withColumn(
        "label_snapshot_date", F.add_months("snapshot_date", label_shift)
    )
    later = primary.select(
        "Customer_ID", F.to_date("snapshot_date").alias("label_snapshot_date"), "label"
    )
    now = surrogate.select(
        "Customer_ID",
        F.to_date("snapshot_date").alias("snapshot_date"),
        F.col("label").alias("delinquency_flag"),
    )
    joined = at_start.join(later, ["Customer_ID", "label_snapshot_date"], "left").join(
        now, ["Customer_ID", "snapshot_date"], "left"
    )
    marked = joined.withColumns(
        {
            "label_missing": F.col("label").isNull().cast("int"),
            "delinquency_missing": F.col("delinquency_flag").isNull().cast("int"),
        }
    )
    return drop_if_all_null(marked, pick_features(marked, wanted))


def hash_fraction(columns: Sequence[str], seed: int) -> Column:
    """A reproducible number in [0, 1) per key: 52 bits of an md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def split_train_test_oot(
    data: DataFrame,
    train_date: dt.date,
    window: TrainingWindow = TrainingWindow(),
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
) -> DataFrame:
    """Add `split`: oot by date, train or test by an exact per-label share.

    Rows outside the windows or without a label leave. Test rows are those with the smallest
    key hashes, ceil(share * rows) of each label. The cut-off hash per label comes from exact
    order statistics, so no label is ranked in one task; the join side has a row per label.
    `data` is read four times: pass a stored training set.
    """
    days = split_dates(train_date, window)
    day = F.col("snapshot_date")
    part = F.when(day.between(F.lit(days.oot_start), F.lit(days.oot_end)), F.lit("oot")).when(
        day.between(F.lit(days.train_start), F.lit(days.train_end)), F.lit("fit")
    )
    rows = (
        data.where(F.col("label").isNotNull())
        .withColumns({"_part": part, "_hash": hash_fraction(keys, window.seed)})
        .where(F.col("_part").isNotNull())
    )
    cut = exact_quantiles(
        rows.where(F.col("_part") == "fit"),
        "_hash",
        [round(1 - window.train_ratio, 9)],
        by=["label"],
        interpolate=False,
        name="_cut",
    ).select("label", F.get("_cut", F.lit(0)).alias("_cut"))
    split = (
        F.when(F.col("_part") == "oot", F.lit("oot"))
        .when(F.col("_hash") <= F.col("_cut"), F.lit("test"))
        .otherwise(F.lit("train"))
    )
    return rows.join(F.broadcast(cut), "label", "left").select(*data.columns, split.alias("split"))


def month_windows(train_dates: Sequence[dt.date], window: TrainingWindow = TrainingWindow()) -> list[tuple]:
    """(month, train_date, part) for every month and every train date whose windows hold it."""
    rows = []
    for day in sorted(set(train_dates)):
        days = split_dates(day, window)
        for part, start, end in (("fit", days.train_start, days.train_end), ("oot", days.oot_start, days.oot_end)):
            month = start.replace(day=1)
            while month <= end:
                rows.append((month, day, part))
                month = shift_months(month, 1)
    return rows


def split_many(
    data: DataFrame,
    train_dates: Sequence[dt.date],
    window: TrainingWindow = TrainingWindow(),
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
) -> tuple[DataFrame, DataFrame]:
    """The splits of `split_train_test_oot` for many train dates from one reading of the training set.

    Gives the rows with train_date and split, one per date whose windows hold the row's month, and
    (train_date, label, n_fit, cut): the labelled rows a date may train or test on and the largest
    hash of a test row. A month lies in the windows of a bounded number of dates, told by a table of
    months that is broadcast: dates times the months of a window. Snapshots lie on the first of
    their month, as windows begin there. Pass a stored training set.
    """
    spark = data.sparkSession
    if clash := {"train_date", "split"} & set(data.columns):
        raise ValueError(f"the table has columns {sorted(clash)} already")
    months = spark.createDataFrame(month_windows(train_dates, window), "_month date, train_date date, _part string")
    rows = (
        data.where(F.col("label").isNotNull())
        .withColumns({"_month": F.trunc("snapshot_date", "month"), "_hash": hash_fraction(keys, window.seed)})
        .join(F.broadcast(months), "_month")
    )
    cuts = exact_quantiles(
        rows.where(F.col("_part") == "fit"),
        "_hash",
        [round(1 - window.train_ratio, 9)],
        by=["train_date", "label"],
        interpolate=False,
        name="_cut",
    ).select("train_date", "label", F.col("n").alias("n_fit"), F.get("_cut", F.lit(0)).alias("cut"))
    split = (
        F.when(F.col("_part") == "oot", F.lit("oot"))
        .when(F.col("_hash") <= F.col("cut"), F.lit("test"))
        .otherwise(F.lit("train"))
    )
    # a row per date and label
    placed = rows.join(F.broadcast(cuts.drop("n_fit")), ["train_date", "label"], "left")
    return placed.select("train_date", *data.columns, split.alias("split")), cuts


def split_stats(split: DataFrame) -> DataFrame:
    """Rows and positive rate per split."""
    return split.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.round(F.avg("label"), 2).alias("label_rate")
    )


def standard_scale(
    data: DataFrame, columns: Sequence[str], fit_on: Column, keep: Sequence[str]
) -> DataFrame:
    """(x - mean) / population deviation, fitted on the rows under `fit_on` only.

    The fitted numbers are one row, which is joined to all others once. A constant column is centred
    only. `data` is read twice: pass a stored table.
    """
    moments = [
        F.struct(
            F.avg(F.when(fit_on, F.col(c))).alias("mean"),
            F.stddev_pop(F.when(fit_on, F.col(c))).alias("std"),
        ).alias(c)
        for c in columns
    ]
    joined = join_one_row(data, data.agg(F.struct(*moments).alias("_fitted")))
    scaled = []
    for c in columns:
        spread = F.col(f"_fitted.{c}.std")
        spread = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        scaled.append(((F.col(c) - F.col(f"_fitted.{c}.mean")) / spread).alias(c))
    return joined.select(*keep, *scaled)
