"""Materialised intermediates in the shared checkpoint folder.

An intermediate that several jobs read, or whose partition ids must stay
fixed, is written once as Parquet next to the cluster's checkpoints.  Lost
executors then cost a re-read, never a recomputation with other results.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a task at most where much is done per row, and rows below which a task is not worth its start.
ROWS_PER_TASK = 200_000
LEAST_ROWS = 5_000


def shared_folder(spark: SparkSession) -> str:
    """Return the folder of ``spark.checkpoint.dir``; local sessions may lack one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """Return a fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tabloom-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for so many rows: all cores, if the rows are worth it, and never more than ROWS_PER_TASK rows a task."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // ROWS_PER_TASK), min(cores, -(-rows // LEAST_ROWS)))


def deal(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over tasks, before a step that does much per row.

    Files are cut into tasks by their compressed bytes, at row groups: millions
    of short rows, or of rows that compress well, can meet in one task.  Rows are
    counted per task, and moved only where a task has over twice its share.
    """
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))
    rows, most = per_task.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = task_count(df.sparkSession, rows)
    return df.repartition(tasks) if most * tasks > 2 * rows else df


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Deal the ``rows`` rows of an iterative fit: all cores take part, and the rows that a task keeps are bounded."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, task_count(df.sparkSession, rows)))
