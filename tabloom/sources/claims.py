"""Claims on shared storage: work that at most one run may do.

A run first writes its claim and then looks: it holds the work only if no other
claim is active.  Of two runs the one that wrote later sees the other one, so
never do both hold the work.  A run that sees others withdraws, waits a random
time and tries again; it gives up once another run holds the work.  A run that
dies with an active claim keeps it, as nobody can tell how far it came.

Each record is a folder of its own: writers share no commit folder, and nothing
is overwritten or deleted.  The storage must list what was written before, as
distributed file systems and current object stores do.
"""

from __future__ import annotations

import random
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.sources.tables import read_or_empty

RECORD = "work string, owner string, claim string, state string"
WANTED, HELD, WITHDRAWN, REPEATED = "wanted", "held", "withdrawn", "repeated"
ATTEMPTS = 6
#: Longest first wait in seconds; later waits are longer.
WAIT = 0.25


@dataclass(frozen=True)
class Claims:
    """Claims below one folder."""

    spark: SparkSession
    folder: str

    def _write(self, work: str, owner: str, claim: str, state: str) -> None:
        record = self.spark.createDataFrame([(work, owner)], "work string, owner string")
        record.coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/claim={claim}/state={state}")

    def records(self) -> DataFrame:
        """All records ever written."""
        return read_or_empty(self.spark, self.folder, RECORD)

    def active(self, work: str) -> DataFrame:
        """Claims of ``work`` that were not withdrawn, and whether they hold it."""
        per_claim = self.records().where(F.col("work") == work).groupBy("claim").agg(
            F.first("owner").alias("owner"),
            F.bool_or(F.col("state") == WITHDRAWN).alias("withdrawn"),
            F.bool_or(F.col("state").isin(HELD, REPEATED)).alias("holds"),
        )
        return per_claim.where("NOT withdrawn").drop("withdrawn")

    def take(self, work: str, owner: str) -> bool:
        """Whether this call, and no other one ever, holds ``work``."""
        for attempt in range(ATTEMPTS):
            if attempt:
                time.sleep(random.uniform(0, WAIT * 2**attempt))
            before = self.active(work)
            if not before.where("holds").isEmpty():
                return False
            if not before.isEmpty():
                continue
            claim = uuid.uuid4().hex
            self._write(work, owner, claim, WANTED)
            if self.active(work).where(F.col("claim") != claim).isEmpty():
                self._write(work, owner, claim, HELD)
                return True
            self._write(work, owner, claim, WITHDRAWN)
        return False

    def repeat(self, work: str, owner: str) -> None:
        """Record that the work is done once more, on purpose."""
        self._write(work, owner, uuid.uuid4().hex, REPEATED)
