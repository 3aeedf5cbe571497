"""Tables, parameterised scans and JSON reports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.contracts import ContractError, require_columns
from tabloom.functions.clean import decimals_to_double


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one where nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def run_sql(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    """SQL with named markers (``:name``); one without a value is an error."""
    return spark.sql(text, args=parameters)


def pinned_scan(df: DataFrame, column: str, value: object, columns: Sequence[str]) -> DataFrame:
    """Contract columns of the rows with one column value; filter and columns reach the scan."""
    require_columns(df, [*columns, column])
    return df.where(F.col(column) == F.lit(value)).select(*columns)


VERSIONS = "version string, copy string, rows bigint, sequence bigint, schema string, entry string"
#: Folder levels of a version's rows.
FOLDERS = ("table_version", "table_copy")


@dataclass(frozen=True)
class VersionedTable:
    """Versions of a table side by side, one folder per value of its lineage ``column``.

    A version is written to a folder of its own, and a record in the list of
    versions makes it visible; a run that dies before has published nothing.
    Publishing a version again adds a copy and a later record: new readers take
    the new copy, running ones finish on the old one.  Versions may differ in
    their columns.  Nothing is deleted.
    """

    spark: SparkSession
    root: str
    column: str

    def versions(self) -> DataFrame:
        """The valid record of each version: the latest, and of two at once the last by name."""
        records = read_or_empty(self.spark, f"{self.root}/versions", VERSIONS)
        latest = F.max_by(F.struct(*records.columns), F.struct("sequence", "copy"))
        return records.groupBy("version").agg(latest.alias("record")).select("record.*")

    def publish(self, df: DataFrame, version: str) -> int:
        """Store ``df`` as a version and return its rows; rows of another version are an error."""
        require_columns(df, [self.column])
        clash = sorted(set(FOLDERS) & set(df.columns))
        if clash:
            raise ContractError("columns are named as folders of a version: " + ", ".join(clash))
        copy = uuid.uuid4().hex
        target = f"{self.root}/rows/{FOLDERS[0]}={version}/{FOLDERS[1]}={copy}"
        df.write.mode("errorifexists").parquet(target)
        # One short column of what was written is read again, not the source.
        strange = F.count_if(~F.col(self.column).eqNullSafe(F.lit(version)))
        written = self.spark.read.schema(df.schema).parquet(target)
        found = written.agg(F.count("*").alias("rows"), strange.alias("strange")).first()
        if found["strange"]:
            raise ContractError(f"{found['strange']} rows belong to another {self.column} than {version}")
        last = read_or_empty(self.spark, f"{self.root}/versions", VERSIONS).agg(F.max("sequence")).first()[0] or 0
        row = (version, copy, found["rows"], last + 1, df.schema.json())
        record = self.spark.createDataFrame([row], VERSIONS.rsplit(",", 1)[0]).coalesce(1)
        # A folder per record: two writers never share a commit folder.
        record.write.mode("errorifexists").parquet(f"{self.root}/versions/entry={copy}")
        return found["rows"]

    def scan(self, version: str, columns: Sequence[str]) -> DataFrame:
        """Columns of one version; only its folder is read."""
        record = self.versions().where(F.col("version") == version).first()
        if record is None:
            raise ContractError(f"no {self.column} {version} is stored")
        stored = T.StructType.fromJson(json.loads(record["schema"]))
        schema = T.StructType([*stored, *[T.StructField(name, T.StringType()) for name in FOLDERS]])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/rows")
        pinned = rows.where((F.col(FOLDERS[0]) == version) & (F.col(FOLDERS[1]) == record["copy"])).drop(*FOLDERS)
        require_columns(pinned, columns)
        return pinned.select(*columns)


def write_report(df: DataFrame, path: str) -> None:
    """Write a small report as JSON lines with sorted keys; NULL fields are kept."""
    plain = decimals_to_double(df.select(*sorted(df.columns)))
    plain.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def written_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the reports below ``folder``, as (run, name); only paths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = "\\Q" + folder.rstrip("/") + "\\E"
    name = F.regexp_extract("path", f"{root}/([^/]+)/[^/]+$", 1)
    return files.select(F.lit(folder).alias("run"), name.alias("name")).where("name <> ''").distinct()
