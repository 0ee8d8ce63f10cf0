"""Loan delinquency columns and label stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import numeric
from tidemark.operators.typing import fill_nulls, numeric_columns
from tidemark.rules import LabelRule


def delinquency_columns(loans: DataFrame) -> DataFrame:
    """Add mob, installments_missed, first_missed_date and dpd to typed loan rows.

    Every NULL number of the loan row counts as 0, so an unknown instalment number means
    month 0. Overdue money with nothing due counts no missed instalment and leaves dpd NULL.
    """
    missed = numeric.missed_installments(F.col("overdue_amt"), F.col("due_amt"))
    counted = loans.withColumns({"mob": F.col("installment_num"), "installments_missed": missed})
    filled = fill_nulls(counted, numeric_columns(counted))
    dated = filled.withColumn(
        "first_missed_date",
        numeric.first_missed_date(F.col("snapshot_date"), F.col("installments_missed")),
    )
    return dated.withColumn(
        "dpd",
        numeric.days_past_due(
            F.col("overdue_amt"), F.col("snapshot_date"), F.col("first_missed_date")
        ),
    )


def primary_label(
    loans: DataFrame,
    rule: LabelRule = LabelRule(),
    scores: DataFrame | None = None,
    null_as_negative: bool = True,
) -> DataFrame:
    """Label loans at the rule's month on book by days past due.

    With `rule.crs > 0` only customers whose risk score (from `scores`, same snapshot) reaches
    the threshold get a label.
    """
    due = loans.where(F.col("mob") == rule.mob)
    if rule.crs > 0:
        if scores is None:
            raise ValueError("a rule with crs > 0 needs the scores of the same snapshots")
        keys = ["Customer_ID", "snapshot_date"]
        due = due.join(scores.select(*keys, "crs"), keys, "left").where(F.col("crs") >= rule.crs)
    return due.select(
        "loan_id",
        "Customer_ID",
        _at_least("dpd", rule.dpd, null_as_negative).alias("label"),
        F.lit(rule.primary_def).alias("label_def"),
        F.lit(rule.primary_version).alias("rule_version"),
        "snapshot_date",
    )


def surrogate_label(
    features: DataFrame, rule: LabelRule = LabelRule(), null_as_negative: bool = True
) -> DataFrame:
    """Label customers at month 0 by their log delinquency score; no rows without that column."""
    if "delinquency_score_log" not in features.columns:
        features = features.withColumn("delinquency_score_log", F.lit(None).cast("double")).where("false")
    return features.where(F.col("mob") == 0).select(
        "Customer_ID",
        _at_least("delinquency_score_log", rule.dsl, null_as_negative).alias("label"),
        F.lit(rule.surrogate_def).alias("label_def"),
        "snapshot_date",
    )


def _at_least(column: str, threshold: int, null_as_negative: bool):
    hit = F.col(column) >= threshold
    label = F.when(hit, F.lit(1)).otherwise(F.lit(0))
    return label if null_as_negative else F.when(F.col(column).isNotNull(), label)
