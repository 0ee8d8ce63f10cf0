"""Incremental bronze ingestion: files that arrived since the last run, exactly once.

The reference workflow waits for monthly CSV files and copies one month at a time. Here a file
stream with an available-now trigger picks up whatever is new and ends; its checkpoint remembers
the files already taken, so a rerun or a lost executor neither skips nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import raw_schema
from tidemark.sources import commits, files


def incoming_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Text rows of all CSV files in a landing folder, as a stream."""
    rows = (
        spark.readStream.schema(raw_schema(schema))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(folder)
    )
    return rows.withColumn("snapshot_date", F.col("snapshot_date").try_cast("date")).where(
        F.col("snapshot_date").isNotNull()
    )


def ingest_available(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append to the bronze table, one partition per snapshot, and stop when caught up.

    A micro-batch is one commit of the same table that the batch runs write; a batch that is
    repeated after a failure is known by the stream's checkpoint and its number, and adds nothing.
    `checkpoint` belongs in storage that outlives the executors.
    """

    def add(batch: DataFrame, number: int) -> None:
        commits.write(batch, table, files.SNAPSHOT, append=True, batch=(checkpoint, number))

    return (
        rows.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
