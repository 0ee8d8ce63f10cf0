"""Model lifecycle: registry, selection, deployment and retrain log as tables below one folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import dataset, history, models
from tidemark.sources.files import read_snapshots, upsert_history

REGISTRY, DEPLOYMENTS, RETRAIN_LOG = "registry", "deployments", "retrain_log"
# Newest models per family that compete, and the metrics that decide.
RECENT = 3
METRIC, FALLBACK = "auc_oot", "auc_test"


def register(model: models.TrainedModel, split: DataFrame, folder: str) -> DataFrame:
    """Save the model and write its registry row; training the same date again replaces the row."""
    row = models.registry_row(model, models.evaluate(model, split), dataset.split_stats(split))
    path = models.save(split.sparkSession, model, f"{folder}/bank")
    return upsert_history(
        row.withColumn("path", F.lit(path)), f"{folder}/{REGISTRY}", ["model_name"], "snapshot_date"
    )


def select_best(registry: DataFrame, day: dt.date, k: int = RECENT) -> DataFrame:
    """The best of the k newest models of each family up to `day`; family and date come from the name."""
    named = registry.withColumns(
        {"family": dates.name_family(F.col("model_name")), "trained_on": dates.name_date(F.col("model_name"))}
    ).where(F.col("trained_on") <= F.lit(day))
    return history.best_of_recent(named, [], ["family"], [F.desc("trained_on")], METRIC, FALLBACK, k)


def deploy(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """Add the deployment of `day`: the best model, and the reference months of its drift checks.

    While the same model stays deployed its reference months stay as they were; a new one takes the
    two months before its training date. Deploying a day again replaces its row.
    """
    best = select_best(read_snapshots(spark, f"{folder}/{REGISTRY}"), day).select(
        F.lit(day).alias("snapshot_date"),
        "model_name",
        "path",
        F.lit(METRIC).alias("selection_metric"),
        "selection_value",
        dates.reference_months(F.col("trained_on")).alias("reference_months"),
    )
    earlier = read_snapshots(spark, f"{folder}/{DEPLOYMENTS}", schema=best.schema).where(
        F.col("snapshot_date") < F.lit(day)
    )
    last = earlier.orderBy(F.desc("snapshot_date")).limit(1).select(
        F.col("model_name").alias("last_model"), F.col("reference_months").alias("last_months")
    )
    same = F.col("model_name") == F.col("last_model")
    # one row on either side
    kept = best.join(F.broadcast(last), same, "left").withColumn(
        "reference_months", F.coalesce("last_months", "reference_months")
    )
    return upsert_history(
        kept.select(*best.columns), f"{folder}/{DEPLOYMENTS}", ["snapshot_date"], "snapshot_date"
    )


def log_decisions(decisions: DataFrame, folder: str, keys: Sequence[str] = ("model_name", "snapshot_date")) -> DataFrame:
    """Keep retrain decisions, the last per model and run."""
    return upsert_history(decisions, f"{folder}/{RETRAIN_LOG}", keys, "snapshot_date")


def score_months(spark: SparkSession, folder: str, store: DataFrame, months: Sequence[dt.date]) -> DataFrame:
    """Score months through the deployment table, with the records of the deployed models."""
    deployed = read_snapshots(spark, f"{folder}/{DEPLOYMENTS}")
    paths = {r["model_name"]: r["path"] for r in deployed.select("model_name", "path").distinct().collect()}
    return models.score_deployed(store, deployed, {name: models.load(spark, path) for name, path in paths.items()}, months)
