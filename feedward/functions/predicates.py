"""Predicates and labels."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_present(columns: Sequence[str]) -> Column:
    """True when at least one of the columns is not NULL.

    Written as an OR chain rather than ``dropna(how="all")``: once a join adds
    ``key IS NOT NULL``, Catalyst absorbs the whole chain into it and the scan
    reads the key column alone.
    """
    return reduce(or_, [F.col(name).isNotNull() for name in columns])


def count_where(condition: Column) -> Column:
    """Number of rows for which the condition is true (NULL counts as false)."""
    return F.count_if(condition)


def breach_label(ratio: Column, threshold: float) -> Column:
    """``BREACH`` strictly above the threshold, otherwise ``OK`` (also for NULL)."""
    return F.when(ratio > threshold, F.lit("BREACH")).otherwise(F.lit("OK"))


def older_than(stamp: Column, as_of: Column, age: timedelta) -> Column:
    """Strictly older than ``as_of - age``; NULL stamps are not matched."""
    return stamp < as_of - F.lit(age)
