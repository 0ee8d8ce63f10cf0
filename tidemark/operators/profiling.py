"""Data profiles. Each profile of several columns is one aggregate, reshaped to a row per column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import join_one_row
from tidemark.operators.order_stats import exact_quantiles, unpivot


def _per_column(
    df: DataFrame, columns: Sequence[str], measures: Callable[[str], dict[str, Column]]
) -> DataFrame:
    """Aggregate every measure of every column in one pass; one output row per column."""
    names = {c: [f"_{i}_{m}" for m in measures(c)] for i, c in enumerate(columns)}
    aggregates = [
        expr.alias(alias) for c in columns for alias, expr in zip(names[c], measures(c).values())
    ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(alias).alias(m) for alias, m in zip(names[c], measures(c))],
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def measures(c: str) -> dict[str, Column]:
        return {"total": F.count("*"), "missing": F.count_if(F.col(c).isNull())}

    counted = _per_column(df, columns, measures)
    return counted.select(
        "*",
        (F.col("total") - F.col("missing")).alias("non_missing"),
        _percent(F.col("missing"), F.col("total")).alias("missing_pct"),
        _percent(F.col("total") - F.col("missing"), F.col("total")).alias("non_missing_pct"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(
        df, columns or df.columns, lambda c: {"n_null": F.count_if(F.col(c).isNull())}
    )


def string_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and duplicates per text column; NULL counts as a value.

    Counts per value first (partial aggregation absorbs hot values), then one row per column.
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    per_value = (
        text.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    repeated = F.col("n") > 1
    return (
        per_value.groupBy("column_name")
        .agg(
            F.sum("n").alias("total"),
            F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
            F.count("*").alias("distinct_values"),
            F.count_if(repeated).alias("repeated_values"),
            F.sum(F.col("n") - 1).alias("rows_beyond_first"),
        )
        .withColumn("duplicate_rows", F.col("repeated_values") + F.col("rows_beyond_first"))
        .withColumn("distinct_pct", _percent(F.col("distinct_values"), F.col("total")))
        .withColumn("duplicate_pct", _percent(F.col("duplicate_rows"), F.col("total")))
    )


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count, in value order."""
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return counted.where("n > 1").orderBy(F.col(column).asc())


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unparseable and negative values, range and shape per column, all in one pass."""

    def measures(c: str) -> dict[str, Column]:
        raw, number = F.col(c), F.col(c).try_cast("double")
        return {
            "total": F.count("*"),
            "missing": F.count_if(raw.isNull()),
            "non_numeric": F.count_if(raw.isNotNull() & number.isNull()),
            "negative": F.count_if(number < 0),
            "min_value": F.min(number),
            "max_value": F.max(number),
            "skewness": F.skewness(number),
            "kurtosis": F.kurtosis(number),
        }

    return _per_column(df, columns, measures)


def _numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return unpivot(df.select(*keep, *[F.col(c).try_cast("double").alias(c) for c in columns]), columns, keep)


def quantile_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """p5, p25, p75 and p95 as exact order statistics (values that occur in the data)."""
    found = exact_quantiles(
        _numbers(df, columns), "value", [0.05, 0.25, 0.75, 0.95], ["feature"], interpolate=False
    )
    return found.select(
        F.col("feature").alias("column_name"),
        *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(["p5", "p25", "p75", "p95"])],
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bounds at 1.5 interquartile ranges and the rows outside, per column."""
    found = quantile_profile(df, columns)
    reach = (F.col("p75") - F.col("p25")) * 1.5
    bounds = found.select(
        F.col("column_name").alias("feature"),
        (F.col("p25") - reach).alias("lower_bound"),
        (F.col("p75") + reach).alias("upper_bound"),
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    # One row of bounds per column.
    return (
        _numbers(df, columns)
        .join(F.broadcast(bounds), "feature")
        .groupBy(F.col("feature").alias("column_name"), "lower_bound", "upper_bound")
        .agg(F.count_if(outside).alias("outliers"), F.count("*").alias("total"))
        .withColumn("outlier_pct", _percent(F.col("outliers"), F.col("total")))
    )


def histogram(
    df: DataFrame, columns: Sequence[str], n_bins: int = 20, upper_quantile: float | None = None
) -> DataFrame:
    """Equal-width histogram between min and max, the last bin closed.

    With `upper_quantile` the range ends at that quantile and larger values are left out.
    """
    numbers = _numbers(df, columns).where("value is not null")
    limits = numbers.groupBy("feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )
    if upper_quantile is not None:
        cut = exact_quantiles(numbers, "value", [upper_quantile], ["feature"])
        limits = limits.join(F.broadcast(cut), "feature").select(
            "feature", "low", F.get("quantiles", F.lit(0)).alias("high")
        )
    # One row of limits per column.
    placed = numbers.join(F.broadcast(limits), "feature").where("value <= high")
    step = (F.col("high") - F.col("low")) / n_bins
    position = F.floor(F.try_divide(F.col("value") - F.col("low"), step)).cast("int")
    bin_id = F.least(F.coalesce(position, F.lit(0)), F.lit(n_bins - 1))
    return (
        placed.groupBy(F.col("feature").alias("column_name"), bin_id.alias("bin"), "low", "high")
        .agg(F.count("*").alias("n"))
        .select(
            "column_name",
            "bin",
            (F.col("low") + F.col("bin") * (F.col("high") - F.col("low")) / n_bins).alias("bin_start"),
            "n",
        )
    )


def winsorize(df: DataFrame, columns: Sequence[str], probability: float = 0.995) -> DataFrame:
    """Cap columns at an exact upper quantile; the caps are one row, which is joined once. `df` is read
    several times: pass a stored table."""
    found = exact_quantiles(
        _numbers(df, columns), "value", [probability], ["feature"], interpolate=False
    )
    caps = found.agg(
        F.struct(
            *[
                F.max(F.when(F.col("feature") == c, F.get("quantiles", F.lit(0)))).alias(c)
                for c in columns
            ]
        ).alias("_caps")
    )
    capped = {
        c: F.when(F.col(c).isNotNull(), F.least(F.col(c).cast("double"), F.col(f"_caps.{c}"))) for c in columns
    }
    return join_one_row(df, caps).withColumns(capped).drop("_caps")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form over rows without any NULL, one aggregate for all pairs."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop("any")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = numbers.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)], F.count("*").alias("_n"))
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in ((a, b), (b, a)):
            cells.append((left, right, F.col(f"_{i}")))
    cells += [(c, c, F.lit(1.0)) for c in columns]
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), r.alias("corr"))
                    for a, b, r in cells
                ]
            )
        )
    )
