"""Retrain decisions from performance and stability histories."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.rules import RETRAIN_POLICY, DriftLimits, PerformanceLimits

# Fixed value: the reason text when nothing fired.
NOTHING_BREACHED = "No thresholds breached or no label yet."


def _three_digits(c: Column) -> Column:
    return F.round(c, 3).cast("decimal(18,3)").cast("string")


def _reason(breached: Column, name: str, value: Column, op: str, limit: float) -> Column:
    text = F.concat(F.lit(f"{name} "), _three_digits(value), F.lit(f" {op} {limit}"))
    return F.when(breached, text)


def retrain_decision(
    runs: DataFrame,
    performance: DataFrame,
    stability: DataFrame,
    limits: PerformanceLimits = PerformanceLimits(),
    drift: DriftLimits = DriftLimits(),
    policy: Sequence[str] = RETRAIN_POLICY,
    retrain_from: dt.date | None = None,
    shared_drift_flag: bool = False,
) -> DataFrame:
    """(model_name, snapshot_date, retraining, reason) for every run (model_name, snapshot_date).

    Performance is the PROD row of the run's snapshot, drift the month before it. A NULL metric
    breaches nothing. PSI and CSI fire their own policy entries; `shared_drift_flag` lets either
    entry react to both. A run before `retrain_from`, or with a false `is_allowed` column, is
    refused without looking at the metrics.
    """
    prod = performance.where(F.col("period_tag") == "PROD").select(
        "model_name", "snapshot_date", "auc", "gini", "accuracy", "logloss"
    )
    worst = stability.groupBy("model_name", "period_month").agg(
        F.max(F.when(F.col("type") == "PSI", F.col("psi"))).alias("_psi"),
        F.max(F.when(F.col("type") == "CSI", F.col("psi"))).alias("_csi"),
    )
    seen = (
        runs.withColumn("period_month", dates.period_month(F.col("snapshot_date")))
        .join(prod, ["model_name", "snapshot_date"], "left")
        .join(worst, ["model_name", "period_month"], "left")
    )
    below = [
        ("auc", F.col("auc") < limits.auc_min, "<", limits.auc_min),
        ("gini", F.col("gini") < limits.gini_min, "<", limits.gini_min),
        ("accuracy", F.col("accuracy") < limits.accuracy_min, "<", limits.accuracy_min),
        ("logloss", F.col("logloss") > limits.logloss_max, ">", limits.logloss_max),
    ]
    psi_bad = F.coalesce(F.col("_psi") >= drift.psi_alert, F.lit(False))
    csi_bad = F.coalesce(F.col("_csi") >= drift.csi_alert, F.lit(False))
    perf_bad = F.lit(False)
    for _, breached, _, _ in below:
        perf_bad = perf_bad | F.coalesce(breached, F.lit(False))
    reasons = F.array_compact(
        F.array(
            *[_reason(b, name, F.col(name), op, limit) for name, b, op, limit in below],
            _reason(psi_bad, "PSI", F.col("_psi"), "≥", drift.psi_alert),
            _reason(csi_bad, "max CSI", F.col("_csi"), "≥", drift.csi_alert),
        )
    )
    if shared_drift_flag:
        psi_bad = csi_bad = psi_bad | csi_bad
    active = {entry.upper() for entry in policy}
    fired = F.lit(False)
    for entry, flag in (("PERF_BELOW", perf_bad), ("PSI_ALERT", psi_bad), ("CSI_ALERT", csi_bad)):
        if entry in active:
            fired = fired | flag

    allowed = F.lit(True)
    if retrain_from is not None:
        allowed = allowed & (F.col("snapshot_date") >= F.lit(retrain_from))
    if "is_allowed" in runs.columns:
        allowed = allowed & F.coalesce(F.col("is_allowed"), F.lit(False))
    refusal = F.lit(
        f"Retraining not allowed. Either logical date < {retrain_from} or dataset not found."
    )
    verdict = F.when(F.size(reasons) == 0, F.lit(NOTHING_BREACHED)).otherwise(
        F.array_join(reasons, "; ")
    )
    return seen.select(
        "model_name",
        "snapshot_date",
        (allowed & fired).alias("retraining"),
        F.when(allowed, verdict).otherwise(refusal).alias("reason"),
    )
