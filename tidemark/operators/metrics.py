"""Score statistics and classification metrics as grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators.order_stats import auc

# Decision threshold and probability clip.
THRESHOLD = 0.5
CLIP = 1e-7


# Months from a prediction to the label that judges it.
LABEL_SHIFT = 6


def join_labels(predictions: DataFrame, labels: DataFrame, label_shift: int = LABEL_SHIFT) -> DataFrame:
    """Scores with the outcomes of their own outcome month, `label_shift` months after the snapshot.

    Several loans of a customer in that month give several rows, a score without an outcome none.
    """
    outcome = labels.select("Customer_ID", F.to_date("snapshot_date").alias("label_date"), "label")
    due = predictions.withColumn("label_date", F.add_months("snapshot_date", label_shift))
    return due.join(outcome, ["Customer_ID", "label_date"]).select(*predictions.columns, "label_date", "label")


def log_loss(label: Column, score: Column) -> Column:
    p = F.least(F.greatest(score, F.lit(CLIP)), F.lit(1 - CLIP))
    return F.avg(-(label * F.log(p) + (1 - label) * F.log(1 - p)))


def score_stats(
    scored: DataFrame, by: Sequence[str] = (), score: str = "model_predictions"
) -> DataFrame:
    """Label-free statistics; the median is the engine's bounded sketch."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.avg(score).alias("score_mean"),
        F.stddev(score).alias("score_std"),
        F.percentile_approx(score, 0.5).alias("score_median"),
    )


def classification_metrics(
    scored: DataFrame, by: Sequence[str] = (), score: str = "model_predictions", label: str = "label"
) -> DataFrame:
    """Counts, prevalence, accuracy at the threshold and log-loss in one aggregate."""
    p, y = F.col(score), F.col(label)
    positives = F.count_if(y == 1)
    return scored.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        positives.alias("n_pos"),
        (F.count("*") - positives).alias("n_neg"),
        F.try_divide(positives, F.count("*")).alias("prevalence"),
        F.avg(((p >= THRESHOLD).cast("int") == y).cast("int")).alias("accuracy"),
        log_loss(y, p).alias("logloss"),
    )


def auc_gini(
    scored: DataFrame, by: Sequence[str] = (), score: str = "model_predictions", label: str = "label"
) -> DataFrame:
    """AUC with Gini = 2 AUC - 1; both NULL when a group has one class only."""
    ranked = auc(scored, score, label, by)
    return ranked.select(*by, "n_pos", "n_neg", "auc", (F.col("auc") * 2 - 1).alias("gini"))


def performance_history(
    predictions: DataFrame,
    labels: DataFrame,
    period_tag: str,
    label_shift: int = LABEL_SHIFT,
    by: Sequence[str] = ("model_name", "snapshot_date"),
) -> DataFrame:
    """One tidy performance row per model and snapshot of scores.

    Rows are scores that met an outcome. A snapshot of which no score has an outcome yet counts all
    its scores and has NULL metrics. Accuracy and log-loss are sums over distinct scores, so they
    come out of the same pass that ranks the scores for the AUC.
    """
    by = list(by)
    scored = join_labels(predictions, labels, label_shift)
    p = F.least(F.greatest(F.col("_v"), F.lit(CLIP)), F.lit(1 - CLIP))
    hits = F.when(F.col("_v") >= THRESHOLD, F.col("_pos")).otherwise(F.col("_neg"))
    loss = -(F.col("_pos") * F.log(p) + F.col("_neg") * F.log(1 - p))
    ranked = auc(scored, "model_predictions", "label", by, {"hits": hits, "loss": loss})
    judged = F.col("n_pos") + F.col("n_neg")
    everyone = predictions.groupBy(*by).agg(F.count("*").alias("_all"))
    return everyone.join(ranked, by, "left").select(
        *by,
        dates.performance_period(F.col("snapshot_date"), label_shift).alias("period_month"),
        F.lit(period_tag).alias("period_tag"),
        "auc",
        F.try_divide("loss", judged).alias("logloss"),
        F.try_divide("hits", judged).alias("accuracy"),
        (F.col("auc") * 2 - 1).alias("gini"),
        F.coalesce("n_rows", "_all").alias("n_rows"),
        "n_pos",
        (F.col("n_rows") - F.col("n_pos")).alias("n_neg"),
    )


def unpivot_metrics(history: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Tall (keep..., metric, value)."""
    wide = history.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(keep), list(metrics), "metric", "value")


def metric_timeline(
    history: DataFrame, metrics: Sequence[str], period_tag: str | None = None
) -> DataFrame:
    """Tall metric rows per model in period order, optionally for one period tag."""
    rows = history if period_tag is None else history.where(F.col("period_tag") == period_tag)
    tall = unpivot_metrics(rows, ["model_name", "period_month", "period_tag"], metrics)
    return tall.orderBy("metric", "model_name", "period_month")
