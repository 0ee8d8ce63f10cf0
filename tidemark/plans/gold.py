"""Silver to gold: feature projections, encodings, the wide store and the label stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import codes
from tidemark.functions import numeric
from tidemark.operators import features
from tidemark.rules import RiskRule

KEYS = ("Customer_ID", "snapshot_date")


def add_scores(financials: DataFrame, rule: RiskRule = RiskRule()) -> DataFrame:
    """Risk score with its version and the log delinquency score."""
    owed = F.col("Outstanding_Debt") * F.col("Delay_from_due_date")
    return financials.withColumns(
        {
            "crs": numeric.risk_score(rule),
            "crs_version": F.lit(rule.version),
            "delinquency_score_log": numeric.log1p_if_non_negative(owed),
        }
    )


def gold_attributes(attributes: DataFrame) -> DataFrame:
    return attributes.select("Customer_ID", "Age_Group", "snapshot_date")


def gold_financials(
    financials: DataFrame,
    months: DataFrame,
    rule: RiskRule = RiskRule(),
    n_months: int = 3,
) -> DataFrame:
    """Scores, groups and the rolling savings rate of clean financial rows.

    Clean rows are unique per customer and snapshot. `months` are the snapshots delivered at
    all; the average needs the last n of them.
    """
    rolled = features.rolling_average(
        add_scores(financials, rule),
        "savings_rate",
        "savings_rate_avg_3m",
        n_months=n_months,
        unique=True,
        months=months,
    )
    return rolled.select(
        *KEYS,
        "Annual_Income_Group",
        "delinquency_score_log",
        "crs",
        "dti",
        "Payment_Behavior_ID",
        "Payment_of_Min_Amount_ID",
        "savings_rate_avg_3m",
    )


def gold_clickstream(clickstream: DataFrame) -> DataFrame:
    return clickstream.select(*KEYS, *[f"fe_{i}" for i in range(1, 21)])


def clickstream_average(
    clickstream: DataFrame, months: DataFrame, column: str = "fe_1", n_months: int = 3
) -> DataFrame:
    return features.rolling_average(
        clickstream, column, f"{column}_avg_{n_months}m", n_months=n_months, months=months
    )


def surrogate_source(
    financials: DataFrame, loans: DataFrame, unique: bool | None = None
) -> DataFrame:
    """The store's columns that the surrogate label needs; other sources cannot add such rows."""
    return features.merge_sources(
        {
            "financials": financials.select(*KEYS, "delinquency_score_log"),
            "loans": loans.select(*KEYS, "mob"),
        },
        KEYS,
        unique,
    )


def gold_loans(loans: DataFrame) -> DataFrame:
    return loans.select("Customer_ID", "mob", "dpd", "snapshot_date")


def loan_type_counts(financials: DataFrame) -> DataFrame:
    return features.count_encode(
        financials, "Type_of_Loan", list(codes.LOAN_TYPE.values()), [*KEYS, "Num_of_Loan"]
    )


def income_one_hot(financials: DataFrame) -> DataFrame:
    return features.one_hot(
        financials, "Annual_Income_Group", range(1, len(codes.INCOME_CEILINGS) + 2), KEYS
    )


def feature_store(
    attributes: DataFrame,
    financials: DataFrame,
    clickstream: DataFrame,
    loans: DataFrame,
    unique: bool | None = None,
) -> DataFrame:
    """All gold features per customer and snapshot, whichever sources have the key."""
    return features.merge_sources(
        {
            "attributes": attributes,
            "financials": financials,
            "clickstream": clickstream,
            "loans": loans,
        },
        KEYS,
        unique,
    )


def start_rows(
    attributes: DataFrame, financials: DataFrame, clickstream: DataFrame, loans: DataFrame
) -> DataFrame:
    """The store's rows at month 0, without merging the rows of any other month.

    Only a loan at month 0 makes such a row, so the other sources, with one row per key, are looked up
    from it. Equals `feature_store(...)` under `mob = 0` for sources without repeated keys.
    """
    rows = loans.where(F.col("mob") == 0)
    for other in (attributes, financials, clickstream):
        rows = rows.join(other, list(KEYS), "left")
    return rows
