"""Sums of doubles over their whole range that do not depend on the order of rows.

A value is *fixed* if ten places after the point hold it exactly and it is below a million
millions, as amounts of money are: it is added up as a decimal. Any other finite value goes into the *bin* of its
exponent, eight powers of two wide, as a whole number of the bin's unit, and each bin is
added up by itself. Both additions are exact; only the total is rounded to a double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from feedward.functions import round_half_up

FIXED, BIN, UNITS, SPECIAL = "_fixed", "_bin", "_units", "_special"
_FIXED_TYPE = DecimalType(28, 10)
_FIXED_LIMIT = 1e12
_BIN_BITS = 8
# A double has 53 bits: in units of 2 ** -53 times a bin's lower end it is whole, and below 2 ** 62.
_UNIT_BITS = 53


def _times_power_of_two(value: Column, exponent: Column) -> Column:
    """Exact unless the result is out of range; in two steps, as a single factor could be."""
    half = F.floor(exponent / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), exponent - half)


def split(df: DataFrame, value: Column) -> DataFrame:
    """The table with the value's four parts; each row has one of them, a NULL value has none."""
    value, given = F.col("_value"), value.cast("double")
    size, decimal = F.abs(value), value.try_cast(_FIXED_TYPE)
    finite = size < F.lit(float("inf"))
    fixed = (size < F.lit(_FIXED_LIMIT)) & (decimal.cast("double") == value)
    place = F.floor(F.log2(size) / _BIN_BITS).cast("int")
    units = _times_power_of_two(value, F.lit(_UNIT_BITS) - F.col(BIN) * _BIN_BITS)
    return (
        df.withColumn("_value", given)
        .withColumn(FIXED, F.when(fixed, decimal))
        .withColumn(BIN, F.when(finite & F.col(FIXED).isNull(), place))
        .withColumn(UNITS, F.when(F.col(BIN).isNotNull(), units.cast("bigint").cast("decimal(28,0)")))
        .withColumn(SPECIAL, F.when(~finite, value))
        .drop("_value")
    )


def add_parts() -> list[Column]:
    """Over rows of one bin: the sums of the parts, under their names."""
    return [F.sum(name).alias(name) for name in (FIXED, UNITS, SPECIAL)]


def bin_value() -> Column:
    """What the units of a row's bin amount to."""
    return _times_power_of_two(F.col(UNITS).cast("double"), F.col(BIN) * _BIN_BITS - _UNIT_BITS)


def total() -> Column:
    """Over one row for each bin: the sum, bins added from the smallest on. NULL without any value."""
    bins = F.array_sort(F.collect_list(F.when(F.col(BIN).isNotNull(), F.struct(BIN, bin_value().alias("value")))))
    binned = F.aggregate(bins, F.lit(0.0), lambda found, one: found + one["value"])
    fixed, special = F.sum(FIXED), F.sum(SPECIAL)
    whole = F.coalesce(fixed.cast("double"), F.lit(0.0)) + binned + F.coalesce(special, F.lit(0.0))
    return F.when(fixed.isNotNull() | special.isNotNull() | (F.size(bins) > 0), whole)


def rounded_total(places: int) -> Column:
    """The total rounded half away from zero; ties are decided on the exact decimal sum if that is all."""
    others = F.count(BIN) + F.count(SPECIAL)
    exact = F.round(F.sum(FIXED), places).cast("double")
    return F.when(others == 0, exact).otherwise(round_half_up(total(), places))


def by_bin(df: DataFrame, keys: Sequence[str], *others: Column) -> DataFrame:
    """Split rows added up by key and bin, combined before the shuffle, with other aggregates beside."""
    return df.groupBy(*keys, BIN).agg(*add_parts(), *others)
