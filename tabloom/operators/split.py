"""Exact stratified hold-out split and folds.

Rows are ordered inside a class by a salted hash of the identifier.  A split is
then a few cut points per class, and assigning rows is a comparison against
literals: one small count by hash bucket, a ranking of the few buckets that
hold a cut, and no shuffle of the table itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.contracts import ContractError
from tabloom.operators.digest import digests
from tabloom.scratch import materialize

BUCKET_DIGITS = 4
MAX_CLASSES = 1_000

DEVELOPMENT = "development"
TEST = "test"


def hash_key(identifier: str, salt: str) -> Column:
    """Uniform text key that depends on the identifier and salt only."""
    return F.md5(F.concat_ws(":", F.lit(salt), F.col(identifier).cast("string")))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count("*").alias("n"))


def _bucket_counts(df: DataFrame, identifier: str, label: str, salt: str) -> DataFrame:
    """Rows per class and hash bucket: at most classes x 16**BUCKET_DIGITS rows."""
    bucket = F.substring(hash_key(identifier, salt), 1, BUCKET_DIGITS)
    counts = df.groupBy(F.col(label).alias("label"), bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return materialize(counts, "buckets")


def _class_sizes(buckets: DataFrame) -> dict[object, int]:
    sizes = (
        buckets.groupBy("label").agg(F.sum("n").alias("n")).orderBy("label").limit(MAX_CLASSES + 1).collect()
    )
    if len(sizes) > MAX_CLASSES:
        raise ContractError(f"a stratified split needs at most {MAX_CLASSES} classes")
    if any(row["label"] is None for row in sizes):
        raise ContractError("the label must not be NULL")
    return {row["label"]: row["n"] for row in sizes}


def _cut_keys(
    df: DataFrame,
    identifier: str,
    label: str,
    salt: str,
    buckets: DataFrame,
    positions: dict[object, list[int]],
) -> dict[object, dict[int, tuple[str, object]]]:
    """Key of the row at each wanted position (1-based, in hash order) of a class."""
    spark = df.sparkSession
    wanted = [(cls, position) for cls, places in positions.items() for position in sorted(set(places))]
    if not wanted:
        return {}
    label_type = df.schema[label].dataType.simpleString()
    targets = spark.createDataFrame(wanted, f"label {label_type}, position bigint")

    # One class holds at most 16**BUCKET_DIGITS buckets, so this window is bounded.
    order = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = buckets.select("label", "bucket", "n", F.sum("n").over(order).alias("last"))
    cut_buckets = (
        ends.join(F.broadcast(targets), "label")
        .where((F.col("position") <= F.col("last")) & (F.col("position") > F.col("last") - F.col("n")))
        .groupBy("label", "bucket")
        .agg(F.collect_list(F.col("position") - (F.col("last") - F.col("n"))).alias("places"),
             F.min(F.col("last") - F.col("n")).alias("before"))
    )
    key = hash_key(identifier, salt)
    rows = df.select(
        F.col(label).alias("label"),
        F.col(identifier).alias("id"),
        key.alias("key"),
        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
    ).join(F.broadcast(cut_buckets), ["label", "bucket"])
    inside = Window.partitionBy("label", "bucket").orderBy("key", "id")
    cuts = (
        rows.withColumn("place", F.row_number().over(inside))
        .where(F.array_contains("places", F.col("place").cast("bigint")))
        .select("label", "key", "id", (F.col("before") + F.col("place")).alias("position"))
        .collect()  # one row per class and cut
    )
    found: dict[object, dict[int, tuple[str, object]]] = {}
    for row in cuts:
        found.setdefault(row["label"], {})[row["position"]] = (row["key"], row["id"])
    return found


_KEY = "__key"


def _at_or_before(identifier: str, cut: tuple[str, object]) -> Column:
    return (F.col(_KEY) < cut[0]) | ((F.col(_KEY) == cut[0]) & (F.col(identifier) <= F.lit(cut[1])))


def _assign(df: DataFrame, identifier: str, salt: str, output: str, value: Column) -> DataFrame:
    """Add ``value``, which compares the hash key, hashing each row once."""
    return df.withColumn(_KEY, hash_key(identifier, salt)).withColumn(output, value).drop(_KEY)


def _with_quotas(
    assigned: DataFrame, identifier: str, label: str, output: str, wanted: dict[tuple[object, object], int]
) -> DataFrame:
    """The assigned rows, if each part has its quota; repeated or NULL identifiers break it."""
    found = {}
    # One row per class and part.
    for row in assigned.groupBy(label, output).agg(F.count("*"), F.count_if(F.col(identifier).isNull())).collect():
        found[row[0], row[1]] = row[2]
        if row[3]:
            raise ContractError(f"{identifier} must not be NULL")
    if found != {part: n for part, n in wanted.items() if n}:
        raise ContractError(f"{identifier} must be unique: rows with the same one cannot be split by quota")
    return assigned


def development_quotas(sizes: dict[object, int], test_size: float) -> dict[object, int]:
    """Development rows per class: proportional, leftovers to the largest remainders."""
    total = sum(sizes.values())
    development = total - math.ceil(total * test_size)
    # Whole numbers only: the remainder of n * development / total decides.
    quotas = {cls: n * development // total for cls, n in sizes.items()}
    by_remainder = sorted(sizes, key=lambda cls: (-(sizes[cls] * development % total), cls))
    for cls in by_remainder[: development - sum(quotas.values())]:
        quotas[cls] += 1
    return quotas


def stratified_split(
    df: DataFrame,
    identifier: str,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    output: str = "split",
) -> DataFrame:
    """Add ``output`` = development or test, with exact class quotas.

    The result depends on identifiers, labels and seed only, never on row
    order or partitioning.  Identifiers must be unique.
    """
    if not 0 < test_size < 0.5:
        raise ValueError("test_size takes a share between 0 and 0.5, both excluded")
    if isinstance(seed, bool) or not isinstance(seed, int):
        raise TypeError("seed must be an integer")
    salt = str(seed)
    buckets = _bucket_counts(df, identifier, label, salt)
    sizes = _class_sizes(buckets)
    if len(sizes) < 2 or min(sizes.values()) < 2:
        raise ContractError("at least two classes of at least two rows are needed")
    quotas = development_quotas(sizes, test_size)
    cuts = _cut_keys(
        df, identifier, label, salt, buckets, {cls: [quota] for cls, quota in quotas.items() if quota}
    )
    in_development = F.lit(False)
    for cls, by_position in cuts.items():
        cut = by_position[quotas[cls]]
        in_development = in_development | (
            (F.col(label) == F.lit(cls)) & _at_or_before(identifier, cut)
        )
    value = F.when(in_development, F.lit(DEVELOPMENT)).otherwise(F.lit(TEST))
    wanted = {(cls, part): n for cls in sizes for part, n in ((DEVELOPMENT, quotas[cls]), (TEST, sizes[cls] - quotas[cls]))}
    return _with_quotas(_assign(df, identifier, salt, output, value), identifier, label, output, wanted)


def fold_sizes(sizes: dict[object, int], folds: int) -> dict[object, list[int]]:
    """Rows per class and fold when class-sorted rows are dealt out in turn."""
    result: dict[object, list[int]] = {}
    start = 0
    for cls in sorted(sizes):
        n = sizes[cls]
        # Rows start .. start+n-1 whose number leaves remainder f when divided by folds.
        result[cls] = [
            (start + n - 1 - fold) // folds - (start - 1 - fold) // folds for fold in range(folds)
        ]
        start += n
    return result


def stratified_folds(
    df: DataFrame,
    identifier: str,
    label: str,
    folds: int = 5,
    seed: int = 42,
    output: str = "fold",
) -> DataFrame:
    """Add ``output`` = 1..folds; fold and class sizes differ by at most one row."""
    if folds < 3:
        raise ValueError("folds must be at least 3")
    salt = f"{seed}:fold"
    buckets = _bucket_counts(df, identifier, label, salt)
    sizes = _class_sizes(buckets)
    if len(sizes) != 2 or min(sizes.values()) < folds:
        raise ContractError("each of two classes must hold at least one row per fold")
    ends: dict[object, list[int]] = {}
    for cls, per_fold in fold_sizes(sizes, folds).items():
        running = 0
        ends[cls] = []
        for size in per_fold[:-1]:
            running += size
            ends[cls].append(running)
    cuts = _cut_keys(df, identifier, label, salt, buckets, ends)
    fold = F.lit(folds)
    for number in range(folds - 1, 0, -1):
        before = F.lit(False)
        for cls, places in ends.items():
            cut = cuts[cls][places[number - 1]]
            before = before | ((F.col(label) == F.lit(cls)) & _at_or_before(identifier, cut))
        fold = F.when(before, F.lit(number)).otherwise(fold)
    wanted = {(cls, i): n for cls, per_fold in fold_sizes(sizes, folds).items() for i, n in enumerate(per_fold, start=1)}
    return _with_quotas(_assign(df, identifier, salt, output, fold), identifier, label, output, wanted)


def split_manifest(df: DataFrame, identifier: str, label: str, split: str = "split") -> DataFrame:
    """Rows, positives, rate and identifier digest per partition."""
    y = F.col(label).cast("bigint")
    sums = {"positive_rows": y, "__labelled": y.isNotNull().cast("bigint")}
    return digests(df, F.col(identifier), [split], sums, "id_digest").select(
        split, "rows", "positive_rows",
        F.try_divide(F.col("positive_rows").cast("double"), F.col("__labelled").cast("double")).alias("positive_rate"),
        "id_digest",
    )


def shared_identifiers(df: DataFrame, identifier: str, split: str = "split") -> DataFrame:
    """One row: identifiers in all and those found in more than one partition."""
    return (
        df.groupBy(identifier)
        .agg((F.min(F.xxhash64(split)) != F.max(F.xxhash64(split))).cast("bigint").alias("shared"))
        .agg(
            F.count("*").alias("identifiers"),
            F.coalesce(F.sum("shared"), F.lit(0)).cast("bigint").alias("shared_identifiers"),
        )
    )


def class_weights(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Add balanced weights: rows / (classes x rows of the class)."""
    counts = class_counts(df, label).orderBy(label).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ContractError(f"class weights need at most {MAX_CLASSES} classes")
    total = sum(row["n"] for row in counts)
    weight = F.lit(None).cast("double")
    for row in counts:
        value = total / (len(counts) * row["n"])
        weight = F.when(F.col(label) == F.lit(row[label]), F.lit(value)).otherwise(weight)
    return df.withColumn(output, weight)
