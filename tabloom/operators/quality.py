"""Typed modeling table, quality checks and missingness, driven by a contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.contracts import ColumnContract, ContractError, TableContract, require_columns
from tabloom.functions.clean import binary_label, blank_to_null, percent, remap, safe_double, safe_long, trim_text

ERROR = "ERROR"


def _typed(column: ColumnContract) -> Column:
    text = blank_to_null(F.col(column.raw_name))
    if column.kind == "bigint":
        value = safe_long(text)
    elif column.kind == "double":
        value = safe_double(text)
    elif column.kind == "binary":
        value = binary_label(text)
    else:
        value = remap(text, column.remap)
    return value.alias(column.name)


def modeling_table(
    raw: DataFrame,
    contract: TableContract,
    source_uri: str,
    source_sha256: str,
    with_timestamp: bool = False,
) -> DataFrame:
    """Raw text columns to the typed table: trim, blank to NULL, safe casts, lineage.

    Texts are trimmed in a step of their own: the casts read a text several
    times, and would each trim it again.
    """
    require_columns(raw, contract.raw_columns)
    texts = list(dict.fromkeys(contract.raw_columns))
    raw = raw.select(*[trim_text(F.col(name)).alias(name) for name in texts])
    uri, sha256 = contract.lineage
    lineage = [F.lit(source_uri).alias(uri), F.lit(source_sha256).alias(sha256)]
    if with_timestamp:
        lineage.append(F.current_timestamp().alias("transformed_at_utc"))
    return raw.select(*[_typed(column) for column in contract.columns], *lineage)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the whole row; NULL fields count as values."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Surplus rows per repeated key, summed; NULL keys are ignored."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def duplicate_rows(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Surplus copies of whole rows; only a digest of each row is shuffled."""
    columns = [name for name in df.columns if name not in exclude]
    counts = df.groupBy(row_digest(columns).alias("digest")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def _value_checks(contract: TableContract) -> dict[str, Column]:
    identifier, label = F.col(contract.identifier), F.col(contract.label)
    checks = {
        f"{contract.identifier}_not_null": identifier.isNull(),
        f"{contract.label}_not_null": label.isNull(),
        f"{contract.label}_is_binary": label.isNotNull() & ~label.isin(0, 1),
    }
    for column in contract.columns:
        if column.check_name:
            checks[column.check_name] = column.violation()
    return checks


def _total(name: str) -> Column:
    """Sum over partial one-row summaries."""
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def quality_checks(
    df: DataFrame,
    contract: TableContract,
    expected_rows: int,
    source_uri: str,
    source_sha256: str,
    raw: DataFrame | None = None,
) -> DataFrame:
    """One row per check: name, severity and failed rows, ordered by name.

    All value checks are counted in one scan, first per label value so that the
    number of classes needs no distinct count.  Duplicates take a second scan
    that shuffles the identifier and a row digest.
    """
    uri, sha256 = contract.lineage
    checks = _value_checks(contract)
    for name, value in ((uri, source_uri), (sha256, source_sha256)):
        # A NULL lineage passes, as != is NULL there.
        checks[f"{name}_matches"] = F.coalesce(F.col(name) != F.lit(value), F.lit(False))
    counts = [F.count_if(bad).alias(name) for name, bad in checks.items()]
    by_label = df.groupBy(contract.label).agg(F.count("*").alias("__rows"), *counts)
    summary = by_label.select(
        "__rows", F.col(contract.label).isNotNull().cast("bigint").alias("__classes"), *checks
    )

    # Two counts of one key each: two distinct counts in one aggregate would send every row twice.
    repeats = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    by_id = df.where(F.col(contract.identifier).isNotNull()).groupBy(contract.identifier).agg(F.count("*").alias("n"))
    by_row = df.groupBy(row_digest(df.columns).alias("digest")).agg(F.count("*").alias("n"))
    pieces = summary.unionByName(by_id.agg(repeats.alias("__duplicate_ids")), allowMissingColumns=True)
    pieces = pieces.unionByName(by_row.agg(repeats.alias("__duplicate_rows")), allowMissingColumns=True)
    if raw is not None:
        pieces = pieces.unionByName(raw.agg(F.count("*").alias("__raw_rows")), allowMissingColumns=True)
    named = {name: _total(name) for name in checks}
    named["expected_row_count"] = F.abs(_total("__rows") - F.lit(expected_rows))
    named[f"{contract.identifier}_unique"] = _total("__duplicate_ids")
    named["no_exact_duplicate_rows"] = _total("__duplicate_rows")
    named[f"both_{contract.label}_classes_present"] = (_total("__classes") != 2).cast("bigint")
    if raw is not None:
        named["raw_and_modeling_row_counts_match"] = F.abs(_total("__raw_rows") - _total("__rows"))
    wide = pieces.agg(*[value.cast("bigint").alias(name) for name, value in named.items()])
    return (
        wide.unpivot([], list(named), "check_name", "failed_rows")
        .select("check_name", F.lit(ERROR).alias("severity"), "failed_rows")
        .orderBy("check_name")
    )


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and percent per column, from one scan."""
    wide = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    )
    return (
        wide.unpivot("__rows", list(columns), "column_name", "missing_count")
        .select(
            "column_name",
            "missing_count",
            percent(F.col("missing_count"), F.col("__rows")).alias("missing_percent"),
        )
        .orderBy(F.desc_nulls_last("missing_percent"), "column_name")
    )


def validation_report(checks: DataFrame) -> DataFrame:
    """One row: passed, and the sorted names of failing ERROR checks."""
    failing = (F.col("severity") == ERROR) & (F.col("failed_rows") > 0)
    return checks.agg(
        (F.count_if(failing) == 0).alias("passed"),
        F.array_sort(F.collect_list(F.when(failing, F.col("check_name")))).alias("failed_checks"),
        F.count("*").alias("checks"),
    )


def require_valid(checks: DataFrame) -> None:
    """Raise with the names of failing ERROR checks."""
    report = validation_report(checks).first()
    if not report["passed"]:
        raise ContractError("data validation failed: " + ", ".join(report["failed_checks"]))


def frame_contract(df: DataFrame, contract: TableContract, expected_rows: int, source_sha256: str) -> DataFrame:
    """Violation counts that must all be 0 before a table is split."""
    require_columns(df, contract.scan_columns)
    identifier, label = F.col(contract.identifier), F.col(contract.label)
    sha256 = F.col(contract.lineage[-1])
    checks = {
        "identifier_missing": identifier.isNull(),
        "label_missing": label.isNull(),
        "label_not_binary": label.isNotNull() & ~label.isin(0, 1),
        "source_hash_missing": sha256.isNull(),
        "source_hash_other": sha256.isNotNull() & (sha256 != F.lit(source_sha256)),
    }
    for column in contract.columns:
        if column.name in contract.numeric:
            checks[f"{column.name}_missing"] = F.col(column.name).isNull()
            checks[f"{column.name}_out_of_range"] = F.col(column.name).isNotNull() & column.violation()
    # One scan without a shuffle for the values, one narrow shuffle of the identifier.
    summary = df.agg(
        F.count("*").alias("__rows"),
        F.count_if(label == 0).alias("__class_0"),
        F.count_if(label == 1).alias("__class_1"),
        *[F.count_if(bad).alias(name) for name, bad in checks.items()],
    )
    repeated = duplicate_keys(df, contract.identifier).select("duplicate_keys")
    pieces = summary.unionByName(repeated, allowMissingColumns=True)
    named = {name: _total(name) for name in checks}
    named["row_count"] = F.abs(_total("__rows") - F.lit(expected_rows))
    named["identifier_duplicated"] = _total("duplicate_keys")
    named["class_too_small"] = F.least(_total("__class_0"), _total("__class_1")) < 2
    wide = pieces.agg(*[value.cast("bigint").alias(name) for name, value in named.items()])
    return wide.unpivot([], list(named), "check_name", "failed_rows").orderBy("check_name")


def require_frame(df: DataFrame, contract: TableContract, expected_rows: int, source_sha256: str) -> DataFrame:
    """Return the contract's columns, label as tinyint, or raise with the broken rules."""
    checks = frame_contract(df, contract, expected_rows, source_sha256)
    broken = [row["check_name"] for row in checks.where("failed_rows > 0").collect()]
    if broken:
        raise ContractError("modeling data breaks its contract: " + ", ".join(broken))
    return df.select(*contract.scan_columns).withColumn(
        contract.label, F.col(contract.label).cast("tinyint")
    )
