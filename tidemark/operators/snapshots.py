"""Snapshot calendars: ranges, spines, filters, completeness and run conditions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.functions.dates import month_start, shift_months


def at_snapshot(df: DataFrame, day: dt.date, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot: prunes partitions when `column` is the partition column."""
    return df.where(F.col(column) == F.lit(day))


def in_range(df: DataFrame, start: dt.date, end: dt.date, column: str = "snapshot_date") -> DataFrame:
    """Rows between two dates, both included, the last day to its end."""
    inside = F.col(column) >= F.lit(start)
    if end < dt.date.max:
        inside = inside & (F.col(column) < F.lit(end + dt.timedelta(days=1)))
    return df.where(inside)


def in_month(df: DataFrame, month: dt.date, column: str) -> DataFrame:
    """Rows whose timestamp lies in a month, as a half-open range that reaches the scan."""
    upper = shift_months(month, 1)
    return df.where((F.col(column) >= F.lit(month)) & (F.col(column) < F.lit(upper)))


def date_range(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """One row (min_date, max_date); text that is no date is ignored."""
    day = F.col(column).try_cast("date")
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def month_spine(bounds: DataFrame) -> DataFrame:
    """First-of-month dates that cover [min_date, max_date]."""
    months = F.sequence(month_start(F.col("min_date")), F.col("max_date"), F.expr("interval 1 month"))
    return bounds.where("min_date is not null").select(F.explode(months).alias("snapshot_date"))


def distinct_months(df: DataFrame, column: str) -> DataFrame:
    return df.select(month_start(F.col(column).cast("date")).alias("snapshot_date")).distinct()


def union_months(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct months of all sources in calendar order. Each source is reduced to its own
    months before the union, so only a calendar's worth of rows is exchanged."""
    months = frames[0]
    for frame in frames[1:]:
        months = months.unionByName(frame)
    return months.distinct().orderBy("snapshot_date")


def complete_months(df: DataFrame, snapshot: str, n_months: int) -> DataFrame:
    """Per month of the table: how many of the last n months exist, and whether all do."""
    present = df.select(
        F.col(snapshot), dates.month_index(F.col(snapshot)).alias("_source")
    ).distinct()
    reach = present.select(
        snapshot, "_source", F.explode(F.sequence("_source", F.col("_source") + (n_months - 1))).alias("_month")
    )
    return (
        reach.groupBy("_month")
        .agg(
            F.max(F.when(F.col("_month") == F.col("_source"), F.col(snapshot))).alias(snapshot),
            F.count_distinct("_source").cast("int").alias("months_present"),
        )
        .where(F.col(snapshot).isNotNull())
        .select(snapshot, "months_present", (F.col("months_present") == n_months).alias("is_complete"))
    )


def completeness(
    datasets: Mapping[str, DataFrame],
    run_date: dt.date,
    n_months: int,
    n_recent: int = 1,
    features: str | None = None,
    key: str | None = None,
    snapshot: str = "snapshot_date",
    label_shift: Mapping[str, int] | None = None,
) -> DataFrame:
    """Are the n months before `run_date` present in every dataset?

    Without `key` one row for the datasets as a whole; with it one row per key seen in the
    window. Gives months_complete, is_ready (all n months), is_recent_ready (the last n_recent
    months) and has_current (the `features` dataset has the run month itself). `label_shift`
    moves a dataset's months back, for labels that appear k months after their features.
    Two partially aggregated group-bys: a hot key costs no more than any other.
    """
    this_month = run_date.replace(day=1)
    low, high = shift_months(this_month, -n_months), shift_months(this_month, 1)
    recent = shift_months(this_month, -n_recent)
    gate = features or next(iter(datasets))
    by = [] if key is None else [key]
    stacked = None
    for name, frame in datasets.items():
        shift = (label_shift or {}).get(name, 0)
        day = F.col(snapshot).cast("date")
        part = frame.where(
            (day >= F.lit(shift_months(low, shift))) & (day < F.lit(shift_months(high, shift)))
        ).select(
            *by,
            F.add_months(month_start(day), -shift).alias("_month"),
            F.lit(name).alias("_dataset"),
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    monthly = stacked.groupBy(*by, "_month", "_dataset").agg(F.lit(1).alias("_seen"))
    per_month = monthly.groupBy(*by, "_month").agg(
        F.sum("_seen").alias("_sets"),
        F.max(F.col("_dataset") == F.lit(gate)).alias("_has_features"),
    )
    past, full = F.col("_month") < F.lit(this_month), F.col("_sets") == len(datasets)
    return per_month.groupBy(*by).agg(
        F.count_if(past & full).cast("int").alias("months_complete"),
        (F.count_if(past & full) == n_months).alias("is_ready"),
        (F.count_if(past & full & (F.col("_month") >= F.lit(recent))) == n_recent).alias(
            "is_recent_ready"
        ),
        F.coalesce(F.max(~past & F.col("_has_features")), F.lit(False)).alias("has_current"),
    )


def run_conditions(
    ready: DataFrame,
    run_date: dt.date,
    train_on: dt.date,
    retrain_from: dt.date,
    infer_from: dt.date,
    monitor_from: dt.date,
) -> DataFrame:
    """Which stages may run at `run_date`, given a completeness result.

    Training has one exact date; the other stages have an earliest date.
    """
    return ready.withColumns(
        {
            "can_train": F.col("is_ready") & F.lit(run_date == train_on),
            "can_retrain": F.col("is_recent_ready") & F.lit(run_date >= retrain_from),
            "can_infer": F.col("has_current") & F.lit(run_date >= infer_from),
            "can_monitor": F.lit(run_date >= monitor_from),
        }
    )
