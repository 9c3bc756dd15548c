"""Generic data-quality checks.

Every check returns a one-row DataFrame with a single ``rows_affected`` count.
Conditions on a row's own values can also be counted together, in one scan, by
:func:`count_each`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedward.functions import (
    count_where,
    older_than,
    percent,
    shortfall_ratio,
    stamp_literal,
)

COUNT = "rows_affected"


def count_each(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with, per named condition, the number of rows it holds for."""
    return df.agg(*[count_where(condition).alias(name) for name, condition in conditions.items()])


def predicate_check(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is true."""
    return count_each(df, {COUNT: condition})


def null_check(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return predicate_check(df, F.col(column).isNull())


def outside_domain(column: str, values: Sequence[str]) -> Column:
    """Value present but not in the list; a NULL is not matched."""
    return ~F.col(column).isin(*values)


def domain_check(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is present but unknown."""
    return predicate_check(df, outside_domain(column, values))


def unique_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys, not rows, that occur more than once (NULL is a key too)."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    return repeated.agg(F.count("*").alias(COUNT))


def per_key(sides: Sequence[tuple[DataFrame, str, Mapping[str, Column]]]) -> DataFrame:
    """One row for each key ``ref`` of several tables, with the sums of every table's own counters.

    A side is a table, its key column and named counters (bigint). All sides are added up in one
    aggregation over their union, which combines before the shuffle: no join, and
    no task that sees more than one row per map task for a hot key.
    """
    names = [name for _, _, counters in sides for name in counters]
    none = F.lit(0).cast("bigint")
    rows = [
        df.select(
            F.col(key).alias("ref"),
            *[counters.get(name, none).cast("bigint").alias(name) for name in names],
        )
        for df, key, counters in sides
    ]
    grouped = reduce(DataFrame.unionByName, rows).groupBy("ref")
    return grouped.agg(*[F.sum(name).alias(name) for name in names])


def orphan_count(children: str, parents: str) -> Column:
    """Over :func:`per_key`: child rows whose key no parent has, with the rules of SQL ``NOT IN``.

    A NULL child key is not counted, a single NULL among the parent keys makes
    the count 0, and against an empty parent every child row counts.
    """
    none, has_key = F.lit(0).cast("bigint"), F.col("ref").isNotNull()
    found, alone = F.sum(parents), F.sum(F.when(has_key & (F.col(parents) == 0), F.col(children)))
    return (
        F.when(found == 0, F.sum(children))
        .when(F.sum(F.when(~has_key, F.col(parents))) > 0, none)
        .otherwise(F.coalesce(alone, none))
    )


def matched_count(children: str, parents: str) -> Column:
    """Over :func:`per_key`: rows of the inner join of children and parents on the key."""
    both = F.when(F.col("ref").isNotNull(), F.col(children) * F.col(parents))
    return F.coalesce(F.sum(both), F.lit(0).cast("bigint"))


def total_of(name: str) -> Column:
    """Over :func:`per_key`: the counter's sum over all keys, 0 without any row."""
    return F.coalesce(F.sum(name), F.lit(0).cast("bigint"))


def flag(condition: Column) -> Column:
    """1 where the condition is true, otherwise 0 (also for NULL): a counter for :func:`per_key`."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def referential_check(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose key is not in the parent, with the rules of SQL ``NOT IN``.

    Spark plans ``NOT IN`` as a broadcast of all parent keys. Here both sides
    are counted per key instead, see :func:`per_key`.
    """
    one = F.lit(1).cast("bigint")
    sides = [(child, key, {"children": one}), (parent, parent_key or key, {"parents": one})]
    return per_key(sides).agg(orphan_count("children", "parents").alias(COUNT))


def short_of(expected: str, received: str, threshold: float) -> Column:
    """More than the tolerated share of the expected records is missing."""
    return shortfall_ratio(F.col(expected), F.col(received)) > threshold


def reconciliation_check(
    df: DataFrame, expected: str, received: str, threshold: float
) -> DataFrame:
    """Runs short by more than the threshold, whatever their status."""
    return predicate_check(df, short_of(expected, received, threshold))


def freshness_check(
    df: DataFrame, key: str, stamp: str, as_of: datetime, max_age: timedelta
) -> DataFrame:
    """Keys whose latest stamp is older than ``max_age`` at ``as_of``."""
    latest = df.groupBy(key).agg(F.max(stamp).alias("latest"))
    return predicate_check(latest, outdated("latest", as_of, max_age))


def outdated(stamp: str, as_of: datetime, max_age: timedelta) -> Column:
    """Whether a stamp is older than ``max_age`` at ``as_of``."""
    return older_than(F.col(stamp), stamp_literal(as_of), max_age)


def count_rows(df: DataFrame) -> DataFrame:
    """One row with the number of rows. Reads no column of a stored table."""
    return df.agg(F.count("*").alias("row_count"))


def lost_rows(raw_rows: Column, clean_rows: Column, max_pct: float = 10) -> list[Column]:
    """Rows lost between two layers, their rounded share, and whether that stays under ``max_pct``."""
    dropped = raw_rows - clean_rows
    pct = F.coalesce(percent(dropped, raw_rows, 1), F.lit(0.0))
    return [
        dropped.alias(COUNT),
        pct.alias("dropped_pct"),
        F.when(pct < max_pct, F.lit("PASS")).otherwise(F.lit("WARN")).alias("status"),
    ]


def compare_counts(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], max_pct: float = 10
) -> DataFrame:
    """Rows lost between layers: one row per named pair of raw and clean counts.

    The counts come as one-row tables, see :func:`count_rows`. The status
    compares the rounded percentage with ``max_pct``.
    """
    none, rows = F.lit(0).cast("bigint"), F.col("row_count")
    sides = []
    for name, (raw, clean) in pairs.items():
        label = F.lit(name).alias("check_name")
        sides.append(raw.select(label, rows.alias("raw_rows"), none.alias("clean_rows")))
        sides.append(clean.select(label, none.alias("raw_rows"), rows.alias("clean_rows")))
    counts = reduce(DataFrame.unionByName, sides).groupBy("check_name")
    lost = counts.agg(F.sum("raw_rows").alias("raw_rows"), F.sum("clean_rows").alias("clean_rows"))
    return lost.select("*", *lost_rows(F.col("raw_rows"), F.col("clean_rows"), max_pct))


def row_count_check(raw: DataFrame, clean: DataFrame, max_pct: float = 10) -> DataFrame:
    """Rows lost between two tables, and whether the loss stays under ``max_pct``."""
    pair = {"row_count": (count_rows(raw), count_rows(clean))}
    return compare_counts(pair, max_pct).drop("check_name")


def status_of(count: Column, level: Column) -> Column:
    """``PASS`` when nothing is affected, otherwise the check's own level."""
    return F.when(count > 0, level).otherwise(F.lit("PASS"))
