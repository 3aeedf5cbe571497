"""Comparison of stored and expected key-value manifests, and report catalogues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.contracts import ContractError

#: Keys that an error message spells out; it counts the others.
NAMED_KEYS = 100


def manifest_diff(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str] = ("key",), value: str = "value"
) -> DataFrame:
    """Keys that are missing, unexpected or hold another value.

    Each side has one row per key.  Both are stacked and met by one aggregate
    on the key, which merges on the map side.
    """
    keys = list(keys)

    def side(df: DataFrame, is_expected: bool) -> DataFrame:
        return df.select(
            *keys, F.lit(is_expected).alias("__expected"), F.col(value).cast("string").alias("__value")
        )

    met = side(expected, True).unionByName(side(actual, False)).groupBy(*keys)
    wide = met.agg(
        F.bool_or("__expected").alias("__wanted"),
        F.bool_or(~F.col("__expected")).alias("__found"),
        F.max(F.when(F.col("__expected"), F.col("__value"))).alias("expected"),
        F.max(F.when(~F.col("__expected"), F.col("__value"))).alias("actual"),
    )
    problem = (
        F.when(~F.col("__found"), F.lit("missing"))
        .when(~F.col("__wanted"), F.lit("unexpected"))
        .when(~F.col("expected").eqNullSafe(F.col("actual")), F.lit("mismatch"))
    )
    return wide.select(*keys, problem.alias("problem"), "expected", "actual").where(
        F.col("problem").isNotNull()
    )


def require_same_manifest(expected: DataFrame, actual: DataFrame) -> None:
    """Raise with the differing keys of one object; extra keys are allowed."""
    differences = manifest_diff(expected, actual).where(F.col("problem") != "unexpected")
    rows = differences.orderBy("key").limit(NAMED_KEYS).collect()
    if rows:
        named = ", ".join(f"{row['key']} ({row['problem']})" for row in rows)
        total = len(rows) if len(rows) < NAMED_KEYS else differences.count()
        more = f" and {total - len(rows)} more" if total > len(rows) else ""
        raise ContractError(f"stored manifest conflicts with its contract in {total} keys: {named}{more}")


def report_catalog(written: DataFrame, run: str, name: str, expected: Sequence[str]) -> DataFrame:
    """Which expected reports each run has written; a run with a NULL name only has none."""
    wanted = F.array(*[F.lit(report) for report in expected])
    present = written.groupBy(run).agg(F.collect_set(F.when(F.col(name).isin(*expected), F.col(name))).alias("__have"))
    return present.select(run, F.explode(wanted).alias("report"), "__have").select(
        run,
        "report",
        F.array_contains("__have", F.col("report")).alias("present"),
        (F.size("__have") > 0).alias("any_report"),
    )


def require_reports(catalog: DataFrame) -> list[str]:
    """Names of the written reports of one run; none at all is an error."""
    names = [row["report"] for row in catalog.where("present").orderBy("report").collect()]
    if not names:
        raise ContractError("no generated reports were found")
    return names
