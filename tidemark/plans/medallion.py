"""Bronze, silver and gold as tables: a full backfill or a single month through the same plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import codes, schemas
from tidemark.functions.dates import shift_months
from tidemark.operators import labels, lookup, quality
from tidemark.operators.snapshots import at_snapshot
from tidemark.plans import gold, silver
from tidemark.rules import LabelRule
from tidemark.session import checkpointed
from tidemark.sources.files import (
    file_format,
    read_or_empty,
    read_snapshots,
    write_snapshots,
)

ROLLING_MONTHS = 3


@dataclass(frozen=True)
class Layout:
    """Folders below one root; the root must be storage that all executors share."""

    root: str

    def bronze(self, source: str) -> str:
        return f"{self.root}/bronze/{source}"

    def silver(self, source: str) -> str:
        return f"{self.root}/silver/{source}"

    def quarantine(self, source: str) -> str:
        return f"{self.root}/silver/quarantine/{source}"

    def code_table(self, name: str) -> str:
        return f"{self.root}/silver/code_table/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def ingest_bronze(
    spark: SparkSession, files: Mapping[str, str], layout: Layout, snapshot: dt.date | None = None
) -> None:
    """CSV (or parquet) deliveries to text tables by snapshot; rows without a date cannot be
    placed and stay out. A missing delivery leaves its table as it is."""
    for source, path in files.items():
        rows = read_or_empty(spark, path, schemas.SOURCES[source])
        if file_format(path) == "parquet":
            rows = rows.select(*[F.col(c).cast("string") for c in rows.columns])
        dated = rows.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date")).where(
            F.col("snapshot_date").isNotNull()
        )
        # A delivery replaces its month also when it has no rows; a missing file leaves the table as it is.
        months = [] if snapshot is None or rows.isEmpty() else [snapshot]
        write_snapshots(dated if snapshot is None else at_snapshot(dated, snapshot), layout.bronze(source), months)


def _bronze_schema(source: str) -> T.StructType:
    text = schemas.raw_schema(schemas.SOURCES[source])
    return T.StructType(
        [T.StructField(f.name, T.DateType() if f.name == "snapshot_date" else f.dataType) for f in text]
    )


def bronze(spark: SparkSession, layout: Layout, source: str, snapshot: dt.date | None) -> DataFrame:
    return read_snapshots(spark, layout.bronze(source), snapshot, snapshot, _bronze_schema(source))


# Sources with validation rules write a quarantine table next to their clean one.
_VALIDATED = {
    "fe_attributes": (silver.validated_attributes, silver.silver_attributes),
    "fe_financials": (silver.validated_financials, silver.silver_financials),
}
_PLAIN = {"fe_clickstream": silver.silver_clickstream, "lms": silver.silver_loans}


def build_silver(spark: SparkSession, layout: Layout, snapshot: dt.date | None = None) -> None:
    """Clean, type and validate each source. Validated rows are checkpointed once, because the
    clean and the quarantine table are both written from them."""
    for source, (validate, finish) in _VALIDATED.items():
        checked = checkpointed(validate(bronze(spark, layout, source, snapshot)))
        months = run_months(spark, layout, [source], snapshot)
        write_snapshots(finish(checked), layout.silver(source), months)
        write_snapshots(quality.quarantined_rows(checked), layout.quarantine(source), months)
    for source, finish in _PLAIN.items():
        months = run_months(spark, layout, [source], snapshot)
        write_snapshots(finish(bronze(spark, layout, source, snapshot)), layout.silver(source), months)


def run_months(
    spark: SparkSession, layout: Layout, sources: Sequence[str], snapshot: dt.date | None
) -> list[dt.date]:
    """The months that a run rewrites: the given one, or all that bronze has (from folder names only)."""
    if snapshot is not None:
        return [snapshot]
    found = [bronze(spark, layout, source, None).select("snapshot_date").distinct() for source in sources]
    return sorted({r[0] for frame in found for r in frame.collect()})


def silver_table(
    spark: SparkSession, layout: Layout, source: str, start: dt.date | None, end: dt.date | None
) -> DataFrame:
    """A silver table with its full schema, also when the source was never delivered."""
    nothing = spark.createDataFrame([], _bronze_schema(source))
    if source in _PLAIN:
        schema = _PLAIN[source](nothing).schema
    else:
        validate, finish = _VALIDATED[source]
        schema = finish(validate(nothing)).schema
    return read_snapshots(spark, layout.silver(source), start, end, schema)


def quarantine_table(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    schema = _VALIDATED[source][0](spark.createDataFrame([], _bronze_schema(source))).schema
    return read_snapshots(spark, layout.quarantine(source), schema=schema)


def write_code_tables(spark: SparkSession, layout: Layout) -> None:
    tables = {
        "age_group": lookup.ceiling_table(spark, codes.AGE_CEILINGS, "Age_Group", "Age_Group_Ceiling"),
        "annual_income_group": lookup.ceiling_table(
            spark, codes.INCOME_CEILINGS, "Annual_Income_Group", "Annual_Income_Ceiling"
        ),
        "payment_behavior": lookup.code_table(
            spark, codes.PAYMENT_BEHAVIOUR, "Payment_Behavior_ID", "Payment_Behavior_Label"
        ),
        "payment_of_min_amount": lookup.code_table(
            spark, codes.PAYMENT_OF_MIN_AMOUNT, "Payment_of_Min_Amount_ID", "Payment_of_Min_Amount_Label"
        ),
        "credit_mix": lookup.code_table(spark, codes.CREDIT_MIX, "Credit_Mix_ID", "Credit_Mix_Label"),
        "loan_type": lookup.code_table(spark, codes.LOAN_TYPE, "Loan_Type_ID", "Loan_Type_Name"),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(layout.code_table(name))


def build_gold(
    spark: SparkSession,
    layout: Layout,
    snapshot: dt.date | None = None,
    rule: LabelRule = LabelRule(),
) -> None:
    """Feature store, transformed stores and both label stores.

    A monthly run reads the earlier months that the rolling average needs and writes one month.
    """

    def only(df: DataFrame) -> DataFrame:
        return df if snapshot is None else at_snapshot(df, snapshot)

    def table(source: str, start: dt.date | None) -> DataFrame:
        return silver_table(spark, layout, source, start, snapshot)

    first = None if snapshot is None else shift_months(snapshot, -(ROLLING_MONTHS - 1))
    financials, loans = table("fe_financials", first), table("lms", snapshot)
    # The calendar comes from the delivered months, also when a month has no clean row.
    delivered = read_snapshots(
        spark, layout.bronze("fe_financials"), first, snapshot, _bronze_schema("fe_financials")
    )
    months = delivered.select("snapshot_date")
    scored = only(gold.gold_financials(financials, months, rule.risk, ROLLING_MONTHS))
    store = gold.feature_store(
        gold.gold_attributes(table("fe_attributes", snapshot)),
        scored,
        gold.gold_clickstream(table("fe_clickstream", snapshot)),
        gold.gold_loans(loans),
    )
    rewritten = run_months(spark, layout, list(schemas.SOURCES), snapshot)

    def write(df: DataFrame, name: str) -> None:
        write_snapshots(df, layout.gold(name), rewritten)

    write(store, "feature_store")
    write(gold.loan_type_counts(only(financials)), "loan_type_counts")
    write(gold.income_one_hot(only(financials)), "income_one_hot")
    write(labels.primary_label(loans, rule, scored if rule.crs else None), "label_primary")
    stored = read_snapshots(spark, layout.gold("feature_store"), snapshot, snapshot, store.schema)
    write(labels.surrogate_label(stored, rule), "label_surrogate")


def run(
    spark: SparkSession, files: Mapping[str, str], layout: Layout, snapshot: dt.date | None = None
) -> None:
    """All layers, for every snapshot at once or for one month."""
    ingest_bronze(spark, files, layout, snapshot)
    build_silver(spark, layout, snapshot)
    write_code_tables(spark, layout)
    build_gold(spark, layout, snapshot)


def quarantine_report(spark: SparkSession, layout: Layout) -> DataFrame:
    """Errors per source and type over all snapshots."""
    reports = [
        quality.error_counts(quarantine_table(spark, layout, source)).withColumn(
            "source", F.lit(source)
        )
        for source in _VALIDATED
    ]
    return reports[0].unionByName(reports[1])
