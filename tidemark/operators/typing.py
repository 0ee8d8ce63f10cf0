"""Schema enforcement and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_columns(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The schema's columns in their enforced types: unparseable or absent values become NULL."""
    present = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        kind = field.dataType.simpleString()
        if present.get(field.name) == kind:
            columns.append(F.col(field.name))
        elif field.name in present:
            columns.append(F.expr(f"try_cast(`{field.name}` as {kind}) as `{field.name}`"))
        else:
            columns.append(F.expr(f"cast(null as {kind}) as `{field.name}`"))
    return columns


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order, in one projection."""
    return df.select(typed_columns(df, schema))


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coerce columns to double; what does not parse becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def fill_nulls(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    present = set(df.columns)
    return df.na.fill(value, subset=[c for c in columns if c in present])


def drop_if_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(how="all", subset=list(columns))


def pick_features(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted features that exist, in the frame's own column order."""
    chosen = set(wanted)
    return [c for c in df.columns if c in chosen]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
