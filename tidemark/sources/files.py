"""Scans and sinks for raw files and snapshot-partitioned tables."""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import shift_months
from tidemark.operators.history import upsert_keep_last
from tidemark.operators.snapshots import distinct_months, in_range
from tidemark.schemas import raw_schema
from tidemark.sources import commits

SNAPSHOT = "snapshot_date"
HEADER_READERS = 8
_FORMATS = {".parquet": "parquet", ".pq": "parquet", ".csv": "csv", ".csv.gz": "csv", ".gz": "csv"}


def file_format(path: str) -> str:
    """parquet or csv by suffix; globs and trailing slashes are fine."""
    name = path.rstrip("/*").lower()
    for suffix, kind in _FORMATS.items():
        if name.endswith(suffix):
            return kind
    raise ValueError(f"unsupported file type: {path}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One file, folder or glob. CSV needs a header and is read as text in one pass."""
    if file_format(path) == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if schema is None:
        return _csv(spark).option("enforceSchema", False).csv(path)
    return _by_header(spark, path, raw_schema(schema).fieldNames())


def _csv(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("mode", "PERMISSIVE")


def _by_header(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Text columns of all CSV files of a path, found by header name in each file.

    Files with the same header are one scan; a column that a file lacks is NULL in its rows, one that
    every file lacks is an error. Only the first line of each file is read for this.
    """
    files = [_literal(f) for f in _csv(spark).csv(path).inputFiles()]
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda f: tuple(_csv(spark).csv(f).columns), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        if header:  # a file without any line has none
            groups.setdefault(header, []).append(file)
    if missing := [c for c in wanted if not any(c in header for header in groups)]:
        raise ValueError(f"{path} has no columns {missing}")
    frames = []
    for header, members in sorted(groups.items()):
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        frame = _csv(spark).schema(text).option("enforceSchema", False).csv(members)
        frames.append(
            frame.select(*[F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in wanted])
        )
    return functools.reduce(DataFrame.union, frames)


def _literal(uri: str) -> str:
    """The path of a listed file as the readers take it: decoded, glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Like read_table, but a missing path gives an empty frame with the expected columns."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = raw_schema(schema) if file_format(path) == "csv" else schema
        return spark.createDataFrame([], kept)


def read_snapshots(
    spark: SparkSession,
    folder: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table of `write_snapshots`, or any folder partitioned by month, optionally from start to
    end inclusive (prunes partitions).

    With a schema, a table that does not exist yet is empty and absent columns are NULL.
    """
    low, high = (f"{SNAPSHOT}={day.isoformat()}" for day in (start or dt.date.min, end or dt.date.max))
    everything = start is None and end is None
    table = commits.read(spark, folder, schema, wanted=lambda name: everything or low <= name <= high)
    if table is None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        try:
            table = reader.option("mergeSchema", schema is None).parquet(folder)
        except AnalysisException as error:
            if schema is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            table = spark.createDataFrame([], schema)
    if everything:
        return table
    return in_range(table, start or dt.date.min, end or dt.date.max, SNAPSHOT)


def read_last_months(
    spark: SparkSession, folder: str, snapshot: dt.date, n_months: int = 3
) -> DataFrame:
    """The n months up to `snapshot`; no rows at all unless every one of them exists."""
    first = shift_months(snapshot.replace(day=1), -(n_months - 1))
    rows = read_snapshots(spark, folder, first, snapshot)
    present = distinct_months(rows, SNAPSHOT).agg(F.count("*")).scalar()
    return rows.where(present == n_months)


def write_snapshots(df: DataFrame, folder: str, months: Iterable[dt.date] = ()) -> None:
    """Replace the months that `df` has rows for, in one commit; leave the others alone.

    `months` are all months of the run: those that came out empty lose their old rows. A write that
    fails midway leaves the table as it was.
    """
    commits.write(df, folder, SNAPSHOT, months)


def write_csv(df: DataFrame, folder: str) -> None:
    """Distributed CSV with a header per part file."""
    df.write.mode("overwrite").option("header", True).csv(folder)


def upsert_history(
    new: DataFrame, folder: str, keys: Sequence[str], partition: str = "period_month"
) -> DataFrame:
    """Add rows to a history table, last write per key wins; only touched periods are rewritten.

    Of several new rows with one key the last in the frame's order stays, also on the first write.
    The merge is committed only on top of the commit that it read.
    """
    spark = new.sparkSession
    incoming = new.withColumn("ingest_seq", F.monotonically_increasing_id())
    base = commits.latest(spark, folder)
    stored = spark.createDataFrame([], new.schema)
    if base is not None:
        stored = commits.read(spark, folder, new.schema, base)
    # One row per touched period.
    touched = new.select(partition).distinct()
    earlier = stored.join(F.broadcast(touched), partition, "left_semi")
    earlier = earlier.withColumn("ingest_seq", F.lit(-1).cast("bigint"))
    merged = upsert_keep_last(earlier, incoming, keys).drop("ingest_seq")
    done = commits.write(merged, folder, partition, expected=base.number if base else 0)
    return commits.read(spark, folder, new.schema, done)
