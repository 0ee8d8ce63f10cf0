"""Sums of arrays over all rows: one partial array per task, added up in Spark before the driver sees them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partials that one task adds up, and those that the driver may add up itself.
FAN_IN, LAST = 32, 8
SCHEMA = "part bigint, data binary"


def parts_of(rows: DataFrame) -> int:
    """Partitions with rows; count once per stored table and hand it to `summed`."""
    return rows.select(F.spark_partition_id().alias("p")).distinct().count()


def _one(part: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([total.tobytes()], pa.binary())], names=["part", "data"])


def _add(table: pa.Table) -> pa.Table:
    """Add the partials of one group in the order of their parts, so that reruns agree to the last bit."""
    rows = sorted(zip(table.column("part").to_pylist(), table.column("data"), strict=True), key=lambda r: r[0])
    total = np.frombuffer(rows[0][1].as_py(), np.float64).copy()
    for _, data in rows[1:]:
        total += np.frombuffer(data.as_py(), np.float64)
    return pa.Table.from_batches([_one(rows[0][0] // FAN_IN, total)])


def summed(
    rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int, parts: int
) -> np.ndarray:
    """The sum over all tasks of `work`'s array of `size` doubles.

    A task sends one array. More than LAST partials are added FAN_IN at a time by a group each, level by
    level, so neither a task nor the driver holds many. An empty table sums to zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        yield _one(context.partitionId() if context else 0, np.ascontiguousarray(work(batches), np.float64))

    partials = rows.mapInArrow(run, SCHEMA)
    while parts > LAST:
        partials = partials.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_add, SCHEMA)
        parts = -(-parts // FAN_IN)
    total = np.zeros(size)
    for row in sorted(partials.collect(), key=lambda r: r["part"]):
        total += np.frombuffer(row["data"], np.float64)
    return total
