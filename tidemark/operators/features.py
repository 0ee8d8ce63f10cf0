"""Feature engineering: encodings, scores, rolling averages and the wide merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import cleaning, dates
from tidemark.operators.snapshots import complete_months


def occurrences(items: Column, value: str) -> Column:
    """How often a value occurs in an array; zero for a NULL array."""
    return F.when(items.isNull(), F.lit(0)).otherwise(
        F.size(items) - F.size(F.array_remove(items, F.lit(value)))
    )


def count_encode(
    df: DataFrame, list_column: str, values: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """One integer column per known value of a textual list."""
    items = cleaning.split_list(F.col(list_column))
    counts = [occurrences(F.col("_items"), v).alias(v.replace(" ", "_")) for v in values]
    return df.select(*keep, items.alias("_items")).select(*keep, *counts)


def normalize_list(
    df: DataFrame, list_column: str, codes: DataFrame, label_name: str, keys: Sequence[str]
) -> DataFrame:
    """Long form of a textual list: one row per key and entry with its count and code id."""
    entries = df.select(*keys, F.explode(cleaning.split_list(F.col(list_column))).alias(label_name))
    counted = entries.groupBy(*keys, label_name).agg(F.count("*").alias("Loan_Type_Count"))
    return counted.join(F.broadcast(codes), label_name, "left").drop(label_name)


def one_hot(df: DataFrame, column: str, levels: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """0/1 column per level; NULL and unknown levels give all zeros."""
    hits = [
        F.when(F.col(column) == F.lit(level), F.lit(1)).otherwise(F.lit(0)).alias(f"{column}_{level}")
        for level in levels
    ]
    return df.select(*keep, *hits)


def rolling_average(
    df: DataFrame,
    value: str,
    target: str,
    key: str = "Customer_ID",
    snapshot: str = "snapshot_date",
    n_months: int = 3,
    unique: bool = False,
    months: DataFrame | None = None,
) -> DataFrame:
    """Average of `value` over the key's rows of the last n calendar months.

    The frame is a range over a month index: a month the key has no row for is not replaced by
    an older one. The window sees at most one row per month of history and key: either because
    rows are `unique` per key and snapshot (then the average is added in place), or because
    rows are first summed per key and month with map-side partials (then the result has one row
    per key and snapshot).

    `months` lists the snapshots the table has; with it the average is NULL unless all n months
    exist in the table at all.
    """
    if unique:
        rows, total, count = df, F.col(value), F.when(F.col(value).isNotNull(), F.lit(1))
    else:
        rows = df.groupBy(key, snapshot).agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
        total, count = F.col("_sum"), F.col("_n")
    frame = (
        Window.partitionBy(key)
        .orderBy(dates.month_index(F.col(snapshot)))
        .rangeBetween(-(n_months - 1), 0)
    )
    average = F.try_divide(F.sum(total).over(frame), F.sum(count).over(frame)).cast("double")
    kept = df.columns if unique else [key, snapshot]
    rolled = rows.select(*kept, average.alias(target))
    if months is None:
        return rolled
    # One row per calendar month: bounded by the length of history, not by data volume.
    guard = complete_months(months, snapshot, n_months).select(snapshot, "is_complete")
    return rolled.join(F.broadcast(guard), snapshot, "left").select(
        *kept, F.when(F.col("is_complete"), F.col(target)).alias(target)
    )


def _joined(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.join(frame, list(keys), "full")
    return merged


def merge_sources(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
    unique: bool | None = None,
) -> DataFrame:
    """Full outer merge of feature sources into one wide row per key.

    `unique=True` is for sources with at most one row per key (quarantined layers): the sources
    are stacked and grouped, one shuffle in total. A source that breaks this promise fails the
    query instead of losing rows. `unique=False` chains full outer joins, which also keeps the
    fan-out of repeated keys, such as several loans of a customer. By default the grouped form
    counts the rows per key and only repeated keys go through the joins, all in one plan. Keys with
    a NULL part match nothing in any form.
    """
    if unique is False:
        return _joined(list(sources.values()), keys)

    features = {
        name: [c for c in frame.columns if c not in keys] for name, frame in sources.items()
    }
    every = [c for columns in features.values() for c in columns]
    if len(set(every)) != len(every):
        raise ValueError("feature names must differ between sources")

    stacked = None
    for name, frame in sources.items():
        marks = [F.lit(1 if name == other else 0).alias(f"_n_{other}") for other in sources]
        part = frame.select(*keys, *features[name], *marks)
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)

    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    grouped = (
        stacked.where(~no_key)
        .groupBy(*keys)
        .agg(
            *[F.max(c).alias(c) for c in every],
            F.greatest(*[F.sum(f"_n_{s}") for s in sources]).alias("_most"),
        )
    )
    if unique is None:
        repeated = grouped.where(F.col("_most") > 1).select(*keys)
        fanned = _joined([f.join(repeated, list(keys), "left_semi") for f in sources.values()], keys)
        single = grouped.where(F.col("_most") <= 1).select(*keys, *every)
        return single.unionByName(fanned.select(*keys, *every)).unionByName(
            stacked.where(no_key).select(*keys, *every)
        )
    message = F.lit("merge_sources: a source has several rows for one key; use unique=False")
    checked = grouped.where(
        F.when(F.col("_most") <= 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )
    return checked.select(*keys, *every).unionByName(stacked.where(no_key).select(*keys, *every))
