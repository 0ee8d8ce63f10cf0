"""Exact order statistics without collecting or globally sorting a column.

Values are addressed by a monotone key, sign(v) * log1p(|v| * 2**60), cut into ever finer buckets:
even over magnitudes down to 1e-18, linear below.
Quantiles walk down: a bucket histogram (tiny after map-side aggregation) tells which buckets
hold the wanted ranks, and only those are looked at more closely. AUC walks up: pairs are
counted inside fine buckets, then between the children of each coarser bucket. No step
sorts more than one bucket's children in a task, and equal values are merged beforehand.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bucket widths as bits after the binary point of the monotone key, coarse to fine.
RESOLUTIONS = (8, 22)
# Magnitude from which on buckets follow the logarithm.
SCALE = float(2**60)


def _order_key(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v) * F.lit(SCALE))


def _bucket(key: Column, bits: int) -> Column:
    return F.floor(key * F.lit(float(2**bits)))


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value) with one row per listed column, values as double."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "feature", "value")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    interpolate: bool = True,
    name: str = "quantiles",
) -> DataFrame:
    """One row per group: array of exact quantiles plus `n`, the count of usable values.

    `interpolate` gives the linear definition, otherwise the value at rank ceil(p * n).
    NULL and NaN values and NULL groups are ignored; a group without usable values has no row.
    The broadcast sides hold at most two buckets per group and probability, so `by` must be a bounded set such as
    feature names or labels.
    """
    if not by:
        one = exact_quantiles(
            df.withColumn("_all", F.lit(0)), value, probabilities, ["_all"], interpolate, name
        )
        return one.drop("_all")
    by = list(by)
    v = F.col(value).cast("double")
    usable = df.select(*by, v.alias("_v")).where("_v is not null and not isnan(_v)")
    usable = usable.withColumn("_k", _order_key(F.col("_v")))

    # Zero-based ranks to look up: two slots per probability, equal without interpolation.
    # Written as SQL text because there are many of them.
    targets = []
    for i, p in enumerate(probabilities):
        if interpolate:
            position = f"{float(p)!r}D * (_total - 1)"
            ranks = [f"floor({position})", f"ceil({position})"]
        else:
            ranks = [f"greatest(ceil(round({float(p)!r}D * _total, 9)), 1) - 1"] * 2
        for side, rank in enumerate(ranks):
            targets.append(f"named_struct('slot', {2 * i + side}, 'rank', cast({rank} as bigint))")
    wanted = F.expr(f"array({', '.join(targets)})")

    def narrow(histogram: DataFrame, parent: list[str], order: str) -> DataFrame:
        """Keep the buckets that hold a wanted rank; ranks become relative to the bucket."""
        ahead = Window.partitionBy(*parent).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        placed = histogram.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
        inside = F.filter(
            "_targets",
            lambda t: (t["rank"] >= F.col("_before")) & (t["rank"] < F.col("_before") + F.col("_n")),
        )
        relative = F.transform(
            inside,
            lambda t: F.struct(t["slot"].alias("slot"), (t["rank"] - F.col("_before")).alias("rank")),
        )
        keep = [c for c in (*by, "_total", order) if c in placed.columns]
        return placed.withColumn("_targets", relative).where(F.size("_targets") > 0).select(
            *dict.fromkeys(keep), "_targets"
        )

    coarse = usable.groupBy(*by, _bucket(F.col("_k"), RESOLUTIONS[0]).alias("_b0")).agg(
        F.count("*").alias("_n")
    )
    coarse = coarse.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by)))
    found = narrow(coarse.withColumn("_targets", wanted), by, "_b0")

    for level in range(1, len(RESOLUTIONS) + 1):
        parent = f"_b{level - 1}"
        rows = usable.withColumn(parent, _bucket(F.col("_k"), RESOLUTIONS[level - 1]))
        last = level == len(RESOLUTIONS)
        child = "_v" if last else f"_b{level}"
        if not last:
            rows = rows.withColumn(child, _bucket(F.col("_k"), RESOLUTIONS[level]))
        # The ranks travel as a grouping key, so each level refers to the previous one once.
        histogram = (
            rows.select(*by, parent, child)
            .join(F.broadcast(found), [*by, parent])
            .groupBy(*by, parent, child, "_total", "_targets")
            .agg(F.count("*").alias("_n"))
        )
        found = narrow(histogram, [*by, parent], child)

    picked = found.select(*by, "_total", "_v", F.explode("_targets").alias("_t"))
    slots = picked.groupBy(*by).agg(
        F.max("_total").alias("n"),
        *[F.expr(f"max(if(_t.slot = {s}, _v, null)) as _s{s}") for s in range(2 * len(probabilities))],
    )
    values = []
    for i, p in enumerate(probabilities):
        low, high, position = f"_s{2 * i}", f"_s{2 * i + 1}", f"{float(p)!r}D * (n - 1)"
        between = f"{low} + ({high} - {low}) * ({position} - floor({position}))"
        values.append(between if interpolate else low)
    return slots.select(*by, "n", F.expr(f"array({', '.join(values)}) as `{name}`"))


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 100
) -> DataFrame:
    """One-pass sketch of many columns at rank error 1/accuracy, for quick wide profiles."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    sketches = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), wanted, F.lit(accuracy)).alias(c) for c in columns]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("quantiles")) for c in columns])
    return sketches.select(F.inline(rows))


def auc(
    df: DataFrame,
    score: str,
    label: str,
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exact area under the ROC curve per group, ties counted half; NULL for a single class.

    Gives by..., n_rows, n_pos, n_neg, auc, sums.... Rows without score (NULL or NaN) or label count
    in n_rows only. `sums` are further totals, written over _v (the score), _pos and _neg (rows of
    each class with that score); they ride along in the same pass. Pair counts are doubles:
    exact up to 2**53 and relative to that precision beyond.
    """
    by, sums = list(by), dict(sums or {})
    v, y = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")), F.col(label).cast("int")
    level = (
        df.select(*by, v.alias("_v"), y.alias("_y"))
        .groupBy(*by, "_v")
        .agg(
            F.count("*").alias("_n"),
            F.count_if((F.col("_y") == 1) & F.col("_v").isNotNull()).cast("double").alias("_pos"),
            F.count_if((F.col("_y") == 0) & F.col("_v").isNotNull()).cast("double").alias("_neg"),
        )
    )
    # Equal scores pair with each other for one half.
    level = level.withColumns(
        {
            "_pairs": F.col("_pos") * F.col("_neg") / 2,
            "_k": _order_key(F.col("_v")),
            **{f"_sum_{name}": expr for name, expr in sums.items()},
        }
    )
    totals = ["_n", "_pos", "_neg", "_pairs", *[f"_sum_{name}" for name in sums]]
    order = "_v"
    for bits in (*reversed(RESOLUTIONS), 0):
        level = level.withColumn("_parent", _bucket(F.col("_k"), bits))
        level = _count_pairs(level, [*by, "_parent"], order, totals)
        level = level.withColumn("_k", F.col("_parent") / F.lit(float(2**bits)))
        order = "_k"
    top = by or ["_all"]
    level = level if by else level.withColumn("_all", F.lit(0))
    total = _count_pairs(level, top, "_k", totals)
    both = F.col("_pos") * F.col("_neg")
    return total.select(
        *by,
        F.col("_n").alias("n_rows"),
        F.col("_pos").cast("bigint").alias("n_pos"),
        F.col("_neg").cast("bigint").alias("n_neg"),
        F.when(both > 0, F.col("_pairs") / both).alias("auc"),
        *[F.col(f"_sum_{name}").alias(name) for name in sums],
    )


def _count_pairs(
    level: DataFrame, parent: list[str], order: str, totals: list[str]
) -> DataFrame:
    """Merge children into their parent, adding the pairs between different children."""
    below = Window.partitionBy(*parent).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    between = F.col("_pos") * F.coalesce(F.sum("_neg").over(below), F.lit(0.0))
    return (
        level.withColumn("_pairs", F.col("_pairs") + between)
        .groupBy(*parent)
        .agg(*[F.sum(c).alias(c) for c in totals])
    )
