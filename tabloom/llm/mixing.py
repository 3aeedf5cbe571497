"""Mixing sources to target weights by Poisson replication.

The weight of a source and the size of the wanted mix give the mean number of
times that each of its documents is repeated.  Every document draws its own
number: a hash of seed and id is a uniform number, and the inverse of the
Poisson distribution with that mean turns it into a count.  Documents are
exploded by their counts and all copies are shuffled by a second hash.

The draw depends on seed, id and rate only, so a lost executor or another
partitioning changes nothing.  Rates are one row per source; a table of many
sources is joined without one task per hot source.  Everything is built from
Spark's own expressions.

Edge cases: a null source is a source of its own; a null id draws as an empty
one; repeated rows draw alike and are each copied; a source without weight is
left out; an empty table, or weights that are all 0, give an empty mix; columns
of the documents stay, and the names of the two added columns get underscores
after them while the documents have such a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import free_name, running
from tabloom.operators.lookup import left_lookup
from tabloom.scratch import materialize

SEED = 17
COPY, ORDER = "copy", "shuffle_key"
#: Exponent of the natural proportions in the default weights.
TEMPERATURE = 0.5
#: Hexadecimal digits of a hash that make a uniform number.
UNIFORM_DIGITS, ORDER_DIGITS = 13, 15


def source_key(source: Column) -> Column:
    """A key without nulls; a null source differs from any text."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def hashed(digits: int, *parts: Column) -> Column:
    """The first hexadecimal digits of a digest of the parts, as a number."""
    joined = F.concat_ws(":", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts])
    return F.conv(F.substring(F.md5(joined), 1, digits), 16, 10).cast("long")


def source_sizes(df: DataFrame, source: str = "source", size: Column | None = None) -> DataFrame:
    """``source_key, n``: rows, or another additive size, of each source."""
    amount = F.count("*") if size is None else F.sum(size)
    return df.groupBy(source_key(F.col(source)).alias("source_key")).agg(amount.cast("double").alias("n"))


def temperature_weights(sizes: DataFrame, exponent: float = TEMPERATURE) -> DataFrame:
    """Weights between natural proportions (exponent 1) and equal ones (0)."""
    return sizes.select("source_key", F.pow("n", F.lit(exponent)).alias("weight"))


def given_weights(sizes: DataFrame, weights: dict[str | None, float]) -> DataFrame:
    """Weights by source name."""
    if not weights:
        return sizes.select("source_key", F.lit(0.0).alias("weight")).limit(0)
    keys = [(F.lit("n") if name is None else F.lit("s" + name), F.lit(float(w))) for name, w in weights.items()]
    table = F.create_map(*[part for pair in keys for part in pair])
    return sizes.select("source_key", F.element_at(table, F.col("source_key")).alias("weight")).where("weight IS NOT NULL")


def repetition_rates(sizes: DataFrame, weights: DataFrame, total: float | None = None) -> DataFrame:
    """``source_key, n, rate, steps``: mean copies, and the Poisson distribution function up to its far tail."""
    joined = materialize(sizes.join(weights.where("weight > 0"), "source_key").where("n > 0"), "sources")
    sums = joined.agg(F.sum("weight"), F.sum("n")).first()
    if not sums[0]:
        return joined.selectExpr("source_key", "n", "0D AS rate", "array(1D) AS steps").limit(0)
    if total is None:
        total = sizes.agg(F.sum("n")).first()[0]
    rate = F.col("weight") / F.lit(sums[0]) * F.lit(float(total)) / F.col("n")
    farthest = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")

    def step(seen: Column, k: Column) -> Column:
        log_p = seen["log_p"] + F.log(F.col("rate")) - F.log(k.cast("double"))
        below = seen["below"] + F.exp(log_p)
        return F.struct(F.struct(log_p.alias("log_p"), below.alias("below")).alias("state"), below.alias("value"))

    none = F.exp(-F.col("rate"))
    start = F.struct((-F.col("rate")).alias("log_p"), none.alias("below"))
    steps = F.concat(F.array(none), running(F.sequence(F.lit(1), farthest), start, step, "double"))
    return joined.withColumn("rate", rate).select("source_key", "n", "rate", steps.alias("steps"))


def poisson_mix(
    df: DataFrame, rates: DataFrame, identifier: str = "doc_id", source: str = "source", seed: int = SEED
) -> DataFrame:
    """All copies in global random order: the documents' columns, the number of the copy, and the order's key."""
    copy, order = free_name(COPY, df.columns), free_name(ORDER, df.columns)
    key, steps = free_name("source_key", df.columns), free_name("steps", df.columns)
    weight = free_name("n", df.columns)
    table = materialize(
        rates.select(F.col("source_key").alias(key), F.col("n").alias(weight), F.col("steps").alias(steps)), "rates"
    )
    uniform = hashed(UNIFORM_DIGITS, F.lit(seed), F.col(identifier)) / F.lit(float(16**UNIFORM_DIGITS))
    joined = left_lookup(df.withColumn(key, source_key(F.col(source))), table, [key], weight)
    drawn = joined.where(F.col(steps).isNotNull()).withColumn(steps, F.size(F.filter(steps, lambda below: below <= uniform)))
    copies = drawn.where(F.col(steps) > 0).select(*df.columns, F.explode(F.sequence(F.lit(1), F.col(steps))).alias(copy))
    keys = copies.withColumn(order, hashed(ORDER_DIGITS, F.lit(seed), F.col(identifier), F.col(copy)))
    return keys.repartition(order).sortWithinPartitions(order, identifier, copy)
