"""Session defaults and the checkpoint policy."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning does the skew splitting and the size-checked broadcast conversion that
# the operators rely on. Sizes are left to the cluster's own settings.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods beyond this many bytes; a subtree whose generated code would
    # hold one runs without whole-stage code generation instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def session_builder(app_name: str = "tidemark") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    # Checkpoint files go when the frame they belong to is collected as garbage.
    return builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")


def tune(spark: SparkSession) -> None:
    """Apply the runtime defaults to a session built elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster; on a local master the warehouse serves as well."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    context.setCheckpointDir(shared)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise once in reliable storage and cut the lineage, for frames read many times."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder; it is removed when the application ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str = "rows", partition_by: str | None = None) -> DataFrame:
    """The rows written once as Parquet in a scratch folder and read again, for frames read many times.

    Readers prune columns, and partitions where `partition_by` names a column.
    """
    folder = scratch_folder(df.sparkSession, name)
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
