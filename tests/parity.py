"""Compare a Spark result with its SQL twin: rows, column names, types and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_KIND = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(actual: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    rows = actual.collect()
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    kinds = {c[0]: str(c[1]) for c in expected.description}
    wanted = expected.fetchall()
    problems = []
    if sorted(names) != sorted(actual.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(names)}"]
    for field in actual.schema.fields:
        kind = SPARK_KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != kinds[field.name]:
            problems.append(f"type of {field.name}: {kind} != {kinds[field.name]}")
    if len(rows) != len(wanted):
        problems.append(f"rows {len(rows)} != {len(wanted)}")
    order = sorted(names)
    place = [names.index(c) for c in order]
    left = Counter(tuple(_plain(r[c]) for c in order) for r in rows)
    right = Counter(tuple(_plain(w[i]) for i in place) for w in wanted)
    only_left, only_right = left - right, right - left
    if only_left or only_right:
        problems.append(
            f"{sum(only_left.values())} rows only in Spark, {sum(only_right.values())} only in SQL; columns "
            f"{order}; e.g. {list(only_left)[:2]} vs {list(only_right)[:2]}"
        )
    return problems
