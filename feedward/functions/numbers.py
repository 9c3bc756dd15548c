"""Numeric expressions: rounding, percentages, lenient text parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

# Wide enough for any bigint ratio times 100; ten places absorb binary noise
# such as 0.285 * 100 = 28.499999999999996 before the tie is decided.
_EXACT = DecimalType(38, 10)
# From here on a double is a whole number.
_WHOLE = 1e17

# The longest leading part of a text that reads as a number.
_NUMBER_PREFIX = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def round_half_up(value: Column, places: int) -> Column:
    """Round half away from zero and return a double, NULL for NULL.

    Values too large to have such places, infinity and NaN stay as they are.
    """
    rounded = F.round(value.try_cast(_EXACT), places).cast(DoubleType())
    return F.when(F.abs(value) < F.lit(_WHOLE), rounded).otherwise(value.cast(DoubleType()))


def percent(part: Column, whole: Column, places: int) -> Column:
    """``100 * part / whole`` rounded; NULL where the whole is zero or NULL."""
    ratio = part.cast(DoubleType()) / F.nullif(whole.cast(DoubleType()), F.lit(0.0))
    return round_half_up(ratio * 100, places)


def shortfall_ratio(expected: Column, received: Column) -> Column:
    """Unrounded share of expected records that did not arrive.

    Negative on over-delivery; NULL where nothing was expected.
    """
    return (expected - received).cast(DoubleType()) / F.nullif(
        expected.cast(DoubleType()), F.lit(0.0)
    )


def is_positive(value: Column) -> Column:
    """Greater than zero; NULL for NULL, and false for NaN, which Spark orders above all numbers."""
    return (value > 0) & ~F.isnan(value.cast(DoubleType()))


def number_prefix(text: Column) -> Column:
    """Lenient text-to-double: the leading number, 0 when there is none.

    ``'12abc'`` gives 12.0, ``'abc'`` gives 0.0, NULL stays NULL. A strict cast
    would fail the job on the first bad field under ANSI mode, and a plain
    ``try_cast`` would hide the bad field as a NULL.
    """
    digits = F.regexp_extract(F.trim(text), _NUMBER_PREFIX, 0)
    return F.when(text.isNotNull(), F.coalesce(digits.try_cast("double"), F.lit(0.0)))
