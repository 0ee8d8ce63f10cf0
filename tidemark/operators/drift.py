"""Population and characteristic stability (PSI / CSI) for all months and features at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators.order_stats import exact_quantiles
from tidemark.rules import DriftLimits

N_BINS = 10
# Proportion floor, widening of a constant column, fewest usable edges.
EPSILON = 1e-10
CONSTANT_PAD = 1e-9
FEWEST_EDGES = 3


def bin_edges(reference: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """(feature, edges) from long reference rows (feature, value).

    Edges are the distinct quantiles in equal steps; with fewer than three distinct ones the
    value range is cut evenly, after widening a constant column a little.
    """
    steps = [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]
    found = exact_quantiles(reference, "value", steps, by=["feature"], name="q")
    pad = f"if(q[0] = q[{n_bins}], {CONSTANT_PAD!r}D, 0D)"
    start, stop = f"(q[0] - {pad})", f"(q[{n_bins}] + {pad})"
    even = [f"{start} + {i} * (({stop} - {start}) / {n_bins})" for i in range(n_bins)]
    edges = f"""if(size(array_distinct(q)) < {FEWEST_EDGES},
        array({', '.join(even)}, {stop}), array_distinct(q))"""
    return found.select("feature", F.expr(edges).alias("edges"))


def bin_number(
    n_bins: int = N_BINS,
    closed_last: bool = False,
    open_ended: bool = False,
    value: str = "value",
    edges: str = "edges",
) -> Column:
    """Zero-based bin of [a, b) intervals, NULL outside; written over two column names.

    By default the largest edge itself lies outside. `closed_last` counts it into the last bin,
    `open_ended` stretches the outer bins to infinity.
    """
    reached = [f"if({value} >= get({edges}, {i}), 1, 0)" for i in range(n_bins + 1)]
    position, last = f"({' + '.join(reached)} - 1)", f"(size({edges}) - 2)"
    usable = f"{value} is not null and not isnan({value})"
    if open_ended:
        return F.expr(f"if({usable}, least(greatest({position}, 0), {last}), null)")
    inside = f"if({usable} and {position} between 0 and {last}, {position}, null)"
    if closed_last:
        top = f"{usable} and {value} = element_at({edges}, -1)"
        return F.expr(f"if({top}, {last}, {inside})")
    return F.expr(inside)


def bin_proportions(
    rows: DataFrame,
    edges: DataFrame,
    by: Sequence[str] = (),
    n_bins: int = N_BINS,
    **bin_options: bool,
) -> DataFrame:
    """(feature, by..., proportions, n): share per bin of the in-range values, n = all rows.

    Takes long rows (feature, value, by...). Edges are one small row per feature, hence the
    broadcast; empty bins come out as zero without a bin spine because every bin is its own
    conditional count in one partial aggregate.
    """
    placed = rows.join(F.broadcast(edges), "feature", "left").select(
        "feature",
        *by,
        bin_number(n_bins, **bin_options).alias("_bin"),
        F.size("edges").alias("_n_edges"),
    )
    counted = placed.groupBy("feature", *by).agg(
        F.count("*").alias("n"),
        F.count("_bin").alias("_inside"),
        F.max("_n_edges").alias("_n_edges"),
        *[F.expr(f"count_if(_bin = {i}) as _c{i}") for i in range(n_bins)],
    )
    share = ", ".join(f"if(_inside > 0, _c{i} / _inside, 0D)" for i in range(n_bins))
    usable = F.expr(f"slice(array({share}), 1, _n_edges - 1) as proportions")
    return counted.select("feature", *by, usable, "n")


def bin_counts(
    rows: DataFrame,
    edges: DataFrame,
    by: Sequence[str] = (),
    n_bins: int = N_BINS,
    **bin_options: bool,
) -> DataFrame:
    """(feature, counts, n, by...): rows per bin and all rows, a state that can be added up."""
    placed = rows.join(F.broadcast(edges), "feature", "left").select(
        "feature", *by, bin_number(n_bins, **bin_options).alias("_bin"), F.size("edges").alias("_n_edges")
    )
    counted = placed.groupBy("feature", *by).agg(
        F.count("*").alias("n"),
        F.max("_n_edges").alias("_n_edges"),
        *[F.expr(f"count_if(_bin = {i}) as _c{i}") for i in range(n_bins)],
    )
    each = ", ".join(f"_c{i}" for i in range(n_bins))
    return counted.select("feature", F.expr(f"slice(array({each}), 1, _n_edges - 1) as counts"), "n", *by)


def _shares(counts: str) -> Column:
    total = f"aggregate({counts}, 0L, (s, c) -> s + c)"
    return F.expr(f"transform({counts}, c -> if({total} > 0, c / {total}, 0D))")


def drift_of_counts(
    counts: DataFrame,
    reference: DataFrame,
    model_name: str,
    kind: str | Column,
    n_bins: int = N_BINS,
    snapshot: str = "snapshot_date",
) -> DataFrame:
    """The rows of `drift_history` from stored `bin_counts` by month; no row is read again.

    `reference` are the stored counts of the reference months, by the edges of the same model.
    """
    numbered = reference.select("feature", F.posexplode("counts").alias("_i", "_c"))
    summed = numbered.groupBy("feature", "_i").agg(F.sum("_c").alias("_c"))
    base = summed.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("_i", "_c"))).alias("_base"))
    base = base.withColumn("_base", F.col("_base._c"))
    # One row per feature.
    both = counts.join(F.broadcast(base), "feature", "left")
    placed = both.withColumns({"_now": _shares("counts"), "_before": _shares("_base")})
    return placed.select(
        F.lit(model_name).alias("model_name"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        F.col(snapshot).alias("snapshot_date"),
        dates.period_month(F.col(snapshot)).alias("period_month"),
        "feature",
        stability_index("_now", "_before", n_bins).alias("psi"),
        "n",
    )


def stability_index(compared: str, reference: str, n_bins: int = N_BINS) -> Column:
    """Sum of (p - q) * ln(p / q) with both shares clipped to [EPSILON, 1]."""
    terms = []
    for i in range(n_bins):
        p, q = (f"least(greatest(get({c}, {i}), {EPSILON!r}D), 1D)" for c in (compared, reference))
        terms.append(f"if(size({reference}) > {i}, ({p} - {q}) * ln({p} / {q}), 0D)")
    return F.expr(f"if({reference} is not null, {' + '.join(terms)}, null)")


def drift_history(
    rows: DataFrame,
    reference: DataFrame,
    model_name: str,
    kind: str | Column,
    n_bins: int = N_BINS,
    snapshot: str = "snapshot_date",
    **bin_options: bool,
) -> DataFrame:
    """One stability row per (feature, snapshot) of long rows (feature, value, snapshot).

    `reference` are the long rows of the reference months; filter it on the partition column so
    that only those months are read. `kind` is PSI for scores and CSI for features; as a column
    over `feature` it lets scores and features share one pass (see `kind_of`).
    """
    # Reference and months are counted in one pass; the reference rows carry no snapshot.
    edges = bin_edges(reference, n_bins)
    day = F.col(snapshot)
    stacked = rows.select("feature", "value", day.alias("_day"), F.lit(False).alias("_base")).unionByName(
        reference.select(
            "feature", "value", F.lit(None).cast("date").alias("_day"), F.lit(True).alias("_base")
        )
    )
    shares = bin_proportions(stacked, edges, ["_base", "_day"], n_bins, **bin_options)
    # At most one row per feature and month by now.
    base = F.max(F.when(F.col("_base"), F.col("proportions"))).over(Window.partitionBy("feature"))
    months = shares.withColumn("_reference", base).where(~F.col("_base"))
    return months.select(
        F.lit(model_name).alias("model_name"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        F.col("_day").alias("snapshot_date"),
        dates.period_month(F.col("_day")).alias("period_month"),
        "feature",
        stability_index("proportions", "_reference", n_bins).alias("psi"),
        "n",
    )


def kind_of(score: str) -> Column:
    """PSI for the score column, CSI for every other feature."""
    return F.when(F.col("feature") == score, F.lit("PSI")).otherwise(F.lit("CSI"))


def with_severity(history: DataFrame, limits: DriftLimits = DriftLimits()) -> DataFrame:
    """OK, WARN or ALERT by the limits of the row's type."""

    def band(warn: float, alert: float) -> Column:
        psi = F.col("psi")
        return F.when(psi >= alert, F.lit("ALERT")).when(psi >= warn, F.lit("WARN")).otherwise(F.lit("OK"))

    severity = F.when(F.col("type") == "PSI", band(limits.psi_warn, limits.psi_alert)).otherwise(
        band(limits.csi_warn, limits.csi_alert)
    )
    return history.withColumn("severity", severity)


def drift_timeline(history: DataFrame, model_name: str) -> DataFrame:
    """One model's rows with the period as a date, in chart order."""
    month = F.try_to_date(F.concat("period_month", F.lit("-01")), "yyyy-MM-dd")
    return (
        history.where(F.col("model_name") == model_name)
        .withColumn("month", month)
        .orderBy("type", "feature", "month")
    )


def stability_summary(history: DataFrame) -> DataFrame:
    """Largest and mean index per model and feature over all months; a model with a single month of
    history has no rows."""
    per_feature = history.groupBy("model_name", "type", "feature").agg(
        F.max("psi").alias("max_psi"),
        F.avg("psi").alias("mean_psi"),
        F.count_distinct("period_month").alias("n_months"),
        F.min("period_month").alias("_first"),
        F.max("period_month").alias("_last"),
    )
    # One row per feature by now, so a window over a model's features is small.
    everywhere = Window.partitionBy("model_name")
    several = F.min("_first").over(everywhere) < F.max("_last").over(everywhere)
    return (
        per_feature.withColumn("_several", several)
        .where("_several")
        .drop("_several", "_first", "_last")
        .orderBy(F.desc("max_psi"))
    )


def top_drifting(history: DataFrame, k: int = 10) -> DataFrame:
    """All rows of each model's k features with the largest index; ties go to the smaller name.

    Only one row per model and feature is ranked; its rank limit is applied before the shuffle too.
    """
    worst = history.groupBy("model_name", "feature").agg(F.max("psi").alias("_worst"))
    by_worst = Window.partitionBy("model_name").orderBy(F.desc("_worst"), "feature")
    top = worst.withColumn("_rank", F.row_number().over(by_worst)).where(F.col("_rank") <= k)
    kept = history.join(top.select("model_name", "feature"), ["model_name", "feature"], "left_semi")
    return kept.select(*history.columns).orderBy("model_name", "feature", "period_month")
