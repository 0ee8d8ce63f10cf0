"""One monitoring run: score, measure drift and performance, keep histories, decide."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import decision, drift, metrics, models
from tidemark.operators.order_stats import unpivot
from tidemark.operators.typing import to_numeric
from tidemark.session import checkpointed
from tidemark.sources.files import upsert_history

STABILITY_KEYS = ("model_name", "type", "feature", "period_month")
PERFORMANCE_KEYS = ("model_name", "snapshot_date", "period_tag")
SCORE_KEYS = ("model_name", "snapshot_date")


@dataclass(frozen=True)
class MonitoringRun:
    predictions: DataFrame
    stability: DataFrame
    performance: DataFrame
    scores: DataFrame
    decision: DataFrame


def monitor(
    model: models.TrainedModel,
    store: DataFrame,
    labels: DataFrame,
    snapshot: dt.date,
    reference: Sequence[dt.date],
    folder: str,
    model_name: str = "prod_model",
) -> MonitoringRun:
    """Score the snapshot and its reference months, then update both histories below `folder`.

    `labels` are the outcomes known so far. Without any of the snapshot's outcome month the
    performance row has NULL metrics, and only drift can trigger a retrain. Score statistics need no
    label and are always kept.
    """
    days = [F.lit(d) for d in reference]
    scored = checkpointed(models.batch_score(model, store, snapshot, reference, model_name))
    score_rows = unpivot(to_numeric(scored, ["model_predictions"]), ["model_predictions"], ["snapshot_date"])
    wanted = store.where(F.col("snapshot_date").isin(F.lit(snapshot), *days))
    feature_rows = unpivot(to_numeric(wanted, list(model.features)), list(model.features), ["snapshot_date"])

    rows = score_rows.unionByName(feature_rows)
    drifted = drift.drift_history(
        rows.where(F.col("snapshot_date") == F.lit(snapshot)),
        rows.where(F.col("snapshot_date").isin(*days)),
        model_name,
        drift.kind_of("model_predictions"),
    )
    stability = upsert_history(drifted, f"{folder}/stability", STABILITY_KEYS)
    current = scored.where(F.col("snapshot_date") == F.lit(snapshot))
    performance = upsert_history(
        metrics.performance_history(current, labels, "PROD"), f"{folder}/performance", PERFORMANCE_KEYS
    )
    stats = metrics.score_stats(current, SCORE_KEYS)
    scores = upsert_history(
        stats.withColumn("period_month", dates.period_month(F.col("snapshot_date"))),
        f"{folder}/scores",
        SCORE_KEYS,
    )
    runs = current.sparkSession.range(1).select(
        F.lit(model_name).alias("model_name"), F.lit(snapshot).alias("snapshot_date")
    )
    return MonitoringRun(
        scored, stability, performance, scores, decision.retrain_decision(runs, performance, stability)
    )
