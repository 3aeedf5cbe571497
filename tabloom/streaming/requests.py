"""Scoring of requests whose rows arrive in several micro-batches.

Every row says how many rows its request has.  Rows of a request that is not
complete are kept in a table of open requests, one version per micro-batch, and
join the rows of the next batch.  A request is decided once:

* complete: all its rows are there; it is checked, scored and ranked as a whole;
* ``request:size``: it announces, or has, more rows than allowed; it is refused
  without being kept, so an open request is never longer than a request may be;
* ``request:late``: its newest row is older than the newest row of the stream by
  more than ``wait``.

The clock is the newest arrival seen so far, so results depend on the rows and
their batches only, not on when a batch runs.  Unlike Spark's own watermark, it
drops nothing: rows of a request that was decided before are an incomplete
request of their own and become late.  A batch that runs again reads the same
version of the open requests and replaces its own output, which makes a restart
exact.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.lookup import left_lookup
from tabloom.operators.scoring import MAX_REQUEST_ROWS, REASONS, score_batch
from tabloom.scratch import deal, materialize

#: What becomes of a request in a batch.
COMPLETE, SIZE, LATE, OPEN = "complete", "request:size", "request:late", "open"


def request_fates(
    rows: DataFrame, request: str, expected: str, arrived: str, clock: datetime | None, wait: timedelta,
    maximum: int = MAX_REQUEST_ROWS,
) -> DataFrame:
    """One row per request: its rows ``n``, and its ``fate`` now."""
    sizes = rows.where(F.col(request).isNotNull()).groupBy(request).agg(
        F.count("*").alias("n"), F.max(F.coalesce(F.col(expected), F.lit(1))).alias("wanted"), F.max(arrived).alias("newest")
    )
    old = F.coalesce(F.col("newest") < F.lit(clock) - F.lit(wait), F.lit(False)) if clock else F.lit(False)
    fate = (
        F.when((F.col("wanted") > maximum) | (F.col("n") > maximum) | (F.col("n") > F.col("wanted")), SIZE)
        .when(F.col("n") == F.col("wanted"), COMPLETE)
        .when(old, LATE)
        .otherwise(OPEN)
    )
    return sizes.select(request, "n", fate.alias("fate"))


def _version(spark: SparkSession, path: str, batch_id: int, schema) -> DataFrame | None:
    """A table of the batch before, if there was one."""
    if batch_id == 0:
        return None
    try:
        return spark.read.schema(schema).parquet(f"{path}/batch={batch_id - 1}")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def open_requests(spark: SparkSession, state: str, batch_id: int, schema) -> DataFrame | None:
    """Rows of requests that were open after a batch."""
    return _version(spark, f"{state}/open", batch_id + 1, schema)


def score_request_stream(
    stream: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    model: PipelineModel,
    request: str,
    input_index: str,
    expected: str,
    arrived: str,
    wait: timedelta,
    scored_path: str,
    rejected_path: str,
    state: str,
    checkpoint: str,
    maximum: int = MAX_REQUEST_ROWS,
) -> StreamingQuery:
    """Gather, check, score and rank requests; every row reaches one sink, or stays open until its request is decided.

    ``expected`` names the column with the rows of the request, ``arrived`` the
    time at which the row came.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        waiting = open_requests(spark, state, batch_id - 1, batch.schema)
        rows = materialize(deal(batch if waiting is None else batch.unionByName(waiting)), "gathered")
        clocks = [rows.agg(F.max(arrived)).first()[0]]
        last = _version(spark, f"{state}/clock", batch_id, "clock timestamp")
        if last is not None:
            clocks.append(last.first()[0])
        clock = max((c for c in clocks if c is not None), default=None)
        fates = materialize(request_fates(rows, request, expected, arrived, clock, wait, maximum), "fates")
        decided = materialize(left_lookup(rows, fates, [request], "n"), "decided")

        decided.where(F.col("fate") == OPEN).select(*names).write.mode("overwrite").parquet(f"{state}/open/batch={batch_id}")
        spark.createDataFrame([(clock,)], "clock timestamp").write.mode("overwrite").parquet(f"{state}/clock/batch={batch_id}")
        # Rows without a request id are refused by the check of whole requests.
        whole = decided.where((F.col("fate") == COMPLETE) | F.col(request).isNull()).select(*names)
        scored, rejected = score_batch(check(deal(whole)), model, request, input_index, maximum)
        unfit = decided.where(F.col("fate").isin(SIZE, LATE))
        refused = check(deal(unfit)).withColumn(REASONS, F.array_append(REASONS, F.col("fate"))).drop("fate")
        out = rejected.unionByName(refused.select(*rejected.columns))
        out.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
        scored.write.mode("overwrite").parquet(f"{scored_path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
