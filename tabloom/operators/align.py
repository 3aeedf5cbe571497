"""Rows of written tables side by side, by position.

A row's position is the number of rows in the files before its own (by path)
plus its place in the file.  Files, not tasks, define it, so it is the same
however a scan is split and however often it runs.  Only one row per file is
ordered; rows are numbered by a lookup and joined on their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.operators.lookup import left_lookup
from tabloom.operators.prefix import running_totals

INDEX = "__index"
_FILE, _PLACE, _ROWS, _BEFORE = "__file", "__place", "__rows", "__before"


def row_positions(spark: SparkSession, path: str, index: str = INDEX) -> tuple[DataFrame, int]:
    """The Parquet table at ``path`` with each row's position from 0, and its number of rows."""
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_PLACE)
    )
    files = rows.groupBy(_FILE).agg(F.count("*").alias(_ROWS))
    counted = running_totals(files, [F.col(_FILE)], {"__upto": _ROWS}).select(
        _FILE, _ROWS, (F.col("__upto") - F.col(_ROWS)).alias(_BEFORE)
    )
    total = files.agg(F.sum(_ROWS)).first()[0] or 0
    placed = left_lookup(rows, counted, [_FILE], _ROWS)
    return placed.withColumn(index, F.col(_BEFORE) + F.col(_PLACE)).drop(_FILE, _PLACE, _ROWS, _BEFORE), total


def align(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Columns of two Parquet tables of equal length, row by row.

    Lengths that differ and columns that both tables have are refused.
    """
    (one, rows), (other, others) = row_positions(spark, left), row_positions(spark, right)
    if rows != others:
        raise ContractError(f"tables of {rows} and {others} rows cannot be aligned")
    clash = sorted({c.lower() for c in one.columns} & {c.lower() for c in other.columns} - {INDEX})
    if clash:
        raise ContractError(f"both tables have {', '.join(clash)}")
    return one.join(other, INDEX).drop(INDEX)
