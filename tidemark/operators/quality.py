"""Duplicate detection, validation rules and the quarantine.

Duplicates are found with a partially aggregated count per key and joined back, never with a
window over the key: one key may hold a large share of all rows, and a window would put that
share into a single task. The join side is the list of repeated keys only; adaptive execution
broadcasts it when its measured size allows and splits hot partitions of the row side when not.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.typing import typed_columns


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n) for every key that occurs more than once; NULL counts as a value."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def flag_repeated(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    ignore: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add a boolean column: is this row's key shared with another row?

    Rows under `ignore` (a sentinel such as an unknown id) are never flagged. Their last key,
    which must be a string, is replaced by a per-row hash for the join, so that the sentinel
    does not gather in one shuffle partition. `counted` is the frame to count keys in, when
    `df` already carries other flags on the same rows.
    """
    source = df if counted is None else counted
    source = source if ignore is None else source.where(~ignore)
    repeated = repeated_keys(source, keys).select(
        *[F.col(k).alias(f"_r_{i}") for i, k in enumerate(keys)], F.lit(True).alias("_repeated")
    )
    columns = df.columns
    probe = {f"_p_{i}": F.col(k) for i, k in enumerate(keys)}
    if ignore is not None:
        spread = F.concat(F.lit("\u0000"), F.xxhash64(*columns).cast("string"))
        last = len(keys) - 1
        probe[f"_p_{last}"] = F.when(ignore, spread).otherwise(F.col(keys[last]))
    match = F.expr(" and ".join(f"_p_{i} <=> _r_{i}" for i in range(len(keys))))
    joined = df.withColumns(probe).join(repeated, match, "left")
    return joined.select(*columns, F.expr(f"_repeated is not null as `{flag}`"))


# --- rules: each is an SQL expression for an error text or NULL ------------------


def missing(raw: str, name: str) -> str:
    return f"if(`{raw}` is null, 'MISSING:{name}', null)"


def bad_cast(raw: str, name: str) -> str:
    """A raw value is there but its typed column is NULL."""
    failed = f"`{raw}` is not null and `{name}` is null"
    return f"if({failed}, concat('TYPE_CAST_ERROR:{name}:', `{raw}`), null)"


def negative(name: str, tag: str) -> str:
    return f"if(`{name}` < 0, '{tag}:{name}', null)"


def out_of_range(name: str, low: int, high: int, tag: str) -> str:
    """Non-negative but outside [low, high]; negatives are reported by their own rule."""
    outside = f"`{name}` >= 0 and (`{name}` < {low} or `{name}` > {high})"
    return f"if({outside}, concat('{tag}:', `{name}`), null)"


def tagged(flag: str, tag: str, value: str) -> str:
    """Error under a flag; a NULL value leaves the tag alone."""
    return f"if({flag}, concat_ws(':', '{tag}', `{value}`), null)"


def any_null(columns: Sequence[str]) -> Column:
    return F.expr(" or ".join(f"`{c}` is null" for c in columns))


def error_list(rules: Iterable[str]) -> Column:
    """The texts of the rules that fired. Texts differ between rules, so taking the set
    difference with NULL keeps them all, and unlike a lambda it stays in generated code."""
    return F.expr(f"array_except(array({', '.join(rules)}), array(cast(null as string)))")


def parse(
    df: DataFrame, schema: T.StructType, optional: Sequence[str] = (), errors: str = "_parse_errors"
) -> DataFrame:
    """The schema's typed columns plus an error list: all MISSING, then all TYPE_CAST_ERROR.

    Absent columns count as missing. Each value is cast once; the raw text stays at hand for
    the second projection, which compares the two.
    """
    present = dict(df.dtypes)
    names = schema.fieldNames()
    cast = [f.name for f in schema.fields if present.get(f.name) not in (None, f.dataType.simpleString())]
    both = df.select(
        *typed_columns(df, schema), *[F.col(c).alias(f"_raw_{c}") for c in cast]
    )
    rules = [missing(f"_raw_{c}" if c in cast else c, c) for c in names if c not in optional]
    rules += [bad_cast(f"_raw_{c}", c) for c in cast if c not in optional]
    return both.select(*names, error_list(rules).alias(errors))


# --- quarantine ----------------------------------------------------------------


def clean_rows(validated: DataFrame, errors: str = "errors") -> DataFrame:
    return validated.where(F.size(errors) == 0).drop(errors)


def quarantined_rows(validated: DataFrame, errors: str = "errors") -> DataFrame:
    return validated.where(F.size(errors) > 0)


def error_counts(validated: DataFrame, errors: str = "errors", by: Sequence[str] = ()) -> DataFrame:
    """Rows per error type, the part of each error text before the first colon."""
    return (
        validated.select(*by, F.explode(errors).alias("_error"))
        .select(*by, F.substring_index("_error", ":", 1).alias("error_type"))
        .groupBy(*by, "error_type")
        .agg(F.count("*").alias("n_errors"))
    )
