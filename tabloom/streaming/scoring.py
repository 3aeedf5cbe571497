"""Scoring of an append stream in validated micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.scoring import score_batch
from tabloom.scratch import deal


def score_stream(
    stream: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    model: PipelineModel,
    request: str,
    input_index: str,
    scored_path: str,
    rejected_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Validate, score and rank each micro-batch; rows of refused requests go to their own sink.

    ``check`` adds the ``reasons`` column.  Every row reaches one of the sinks,
    and scores are judged before anything is published.  A rank needs the whole
    request, so a request must arrive in one micro-batch.  Output is keyed by
    batch id and replaced when a batch is run again, which makes a restart exact.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored, rejected = score_batch(check(deal(batch)), model, request, input_index)
        rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
        scored.write.mode("overwrite").parquet(f"{scored_path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Stream of the Parquet files of one table below ``folder``."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{folder}/{name}.parquet*")
    )


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All micro-batches that ``score_stream`` wrote to one of its sinks."""
    return spark.read.schema(schema).parquet(f"{path}/batch=*").drop("batch")
