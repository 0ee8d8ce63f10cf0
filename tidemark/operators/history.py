"""Append-only histories: upsert, latest rows, recent top-k, carry-forward.

Rank filters of the form row_number() <= k are cut per map task before the shuffle (Spark's
window group limit), so a hot key sends at most k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None
) -> DataFrame:
    """The first k rows per key in a total order; optionally with their rank."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def upsert_keep_last(
    history: DataFrame, new: DataFrame, keys: Sequence[str], sequence: str = "ingest_seq"
) -> DataFrame:
    """History plus new rows, last per key by the explicit ingest sequence."""
    both = history.unionByName(new, allowMissingColumns=True)
    return first_rows(both, keys, [F.desc(sequence)])


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    return first_rows(df, keys, newest_first)


def best_of_recent(
    df: DataFrame,
    by: Sequence[str],
    family: Sequence[str],
    newest_first: Sequence[Column],
    metric: str,
    fallback: str,
    k: int = 3,
) -> DataFrame:
    """Among the k newest rows of each family, the best one per `by` group.

    The metric falls back to a second one when NULL; rows with neither do not compete. A tie
    goes to the family that sorts first, then to its newer row.
    """
    recent = first_rows(df, [*by, *family], newest_first, k, rank="recency")
    scored = recent.withColumn("selection_value", F.coalesce(metric, fallback)).where(
        F.col("selection_value").isNotNull()
    )
    order = [F.desc("selection_value"), *[F.asc(f) for f in family], F.asc("recency")]
    return first_rows(scored, by, order) if by else scored.orderBy(*order).limit(1)


def carry_forward(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    source: str,
    value: Column,
    slice_by: Column,
    target: str = "carried",
) -> DataFrame:
    """Keep `value` of the first row of each run of an unchanged `source` per key.

    Adds `is_new` (the run starts here) and `target`. `slice_by` must not decrease along
    `order` (a truncated timestamp, say): rows are ordered only within (key, slice), and a
    summary of one row per slice carries runs across slice borders. So a key with a large
    share of all rows is spread over as many tasks as it has slices.
    """
    # Structs are never NULL, so NULL keys join by plain equality and the window's partitioning
    # serves the join as well.
    rows = df.withColumns(
        {"_key": F.struct(key), "_slice": F.struct(slice_by.alias("s")), "_value": F.struct(value.alias("v"))}
    )
    in_slice = Window.partitionBy("_key", "_slice").orderBy(*order)
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, 0)
    first = F.row_number().over(in_slice) == 1
    changed = ~F.col(source).eqNullSafe(F.lag(source).over(in_slice))
    rows = rows.withColumns({"_first": first, "_changed": ~first & changed})
    start = F.when(F.col("_changed"), F.col("_value"))
    rows = rows.withColumn("_local", F.last(start, ignorenulls=True).over(so_far))

    # One row per (key, slice): how it begins, how it ends, and its last run start, if any.
    position = F.struct(*order)
    ends = rows.groupBy("_key", "_slice").agg(
        F.max(F.when(F.col("_first"), F.struct(source, "_value"))).alias("_head"),
        F.max_by(F.struct(F.col(source).alias("s"), F.col("_local").alias("l")), position).alias("_tail"),
    )
    along = Window.partitionBy("_key").orderBy("_slice")
    head_source, head_value = F.col(f"_head.{source}"), F.col("_head._value")
    continues = (F.row_number().over(along) > 1) & head_source.eqNullSafe(F.lag("_tail.s").over(along))
    ends = ends.withColumn("_continues", continues)
    emitted = F.coalesce(F.col("_tail.l"), F.when(~F.col("_continues"), head_value))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    entry = F.when(F.col("_continues"), F.last(emitted, ignorenulls=True).over(before)).otherwise(head_value)
    borders = ends.select("_key", "_slice", "_continues", entry.alias("_entry"))
    matched = rows.join(borders, ["_key", "_slice"])
    return matched.select(
        *df.columns,
        (F.col("_changed") | (F.col("_first") & ~F.col("_continues"))).alias("is_new"),
        F.coalesce("_local", "_entry")["v"].alias(target),
    )
