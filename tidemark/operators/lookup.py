"""Code tables and lookups against them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def code_table(
    spark: SparkSession, codes: Mapping[int, str | float], id_name: str, label_name: str
) -> DataFrame:
    """A fixed mapping as an in-memory relation whose size the planner knows."""
    rows = ", ".join(
        f"(bigint({code}), {label!r})" if isinstance(label, str) else f"(bigint({code}), double('{label}'))"
        for code, label in codes.items()
    )
    return spark.sql(f"select * from values {rows} as t(`{id_name}`, `{label_name}`)")


def ceiling_table(
    spark: SparkSession, ceilings: list[float], id_name: str, ceiling_name: str
) -> DataFrame:
    """Bin id and exclusive upper edge; the last bin is open."""
    edges = dict(enumerate([*ceilings, float("inf")], start=1))
    return code_table(spark, edges, id_name, ceiling_name)


def lookup(
    df: DataFrame,
    codes: DataFrame,
    on: str,
    label_name: str,
    ignore_case: bool = False,
) -> DataFrame:
    """Left join to a code table on its label; unmatched rows get a NULL id.

    Code tables are fixed lists of at most a dozen rows, so the broadcast is bounded.
    """
    left, right = F.col(on), F.col(label_name)
    if ignore_case:
        left, right = F.lower(left), F.lower(right)
    return df.join(F.broadcast(codes), left == right, "left").drop(label_name)


def label_lookup(df: DataFrame, codes: DataFrame, id_name: str) -> DataFrame:
    """Left join from a bin id to its label."""
    return df.join(F.broadcast(codes), id_name, "left")


def join_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Add the columns of a table of one row, such as global aggregates, by one broadcast."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one.withColumn("_one", F.lit(1))), "_one").drop("_one")
