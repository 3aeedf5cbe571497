"""Cleaning and safe typing of raw text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Decimal number text, without Java's d/f suffixes and hex forms.
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z|^(?i)([+-]?inf(inity)?|nan)\z"

MISSING_GROUP = "__MISSING__"


def trim_text(column: Column) -> Column:
    """Trim Unicode whitespace.

    A plain ``trim`` strips spaces only.  One call with the whole character set
    keeps the generated code small, which matters more than a fast path here.
    """
    return F.btrim(column, F.lit(WHITESPACE))


def blank_to_null(column: Column) -> Column:
    """Empty text becomes NULL; ``column`` is read twice, so it should be cheap."""
    return F.nullif(column, F.lit(""))


def clean_text(column: Column) -> Column:
    """Trim Unicode whitespace; blank becomes NULL."""
    return blank_to_null(trim_text(column))


def safe_long(column: Column) -> Column:
    """Whole-number text to bigint; anything else becomes NULL."""
    return column.try_cast("bigint")


def safe_double(column: Column) -> Column:
    """Decimal text to double; anything else becomes NULL."""
    return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))


def binary_label(column: Column) -> Column:
    """Text 0/1 (as any decimal spelling) to bigint 0/1; anything else becomes NULL."""
    number = safe_double(column)
    return F.when(number.isin(0.0, 1.0), number.cast("bigint"))


def remap(column: Column, mapping: Mapping[str, str]) -> Column:
    """Replace known values and keep all others."""
    result = column
    for old, new in mapping.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result


def group_label(column: Column) -> Column:
    """Group key as text, with a visible label for NULL."""
    return F.coalesce(column.cast("string"), F.lit(MISSING_GROUP))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL for an empty whole."""
    return F.round(F.lit(100) * F.try_divide(part, whole), 2)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def decimals_to_double(df):
    """Cast decimal columns to double, for JSON output."""
    return df.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        ]
    )
