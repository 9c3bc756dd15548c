"""Catalog listing and load assertions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedward.operators.checks import count_rows


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views in a catalog database."""
    return sorted(table.name for table in spark.catalog.listTables(database))


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def assert_tables(found: Iterable[str], expected: Iterable[str]) -> None:
    """Fail unless exactly the expected tables are there."""
    found, expected = set(found), set(expected)
    if found != expected:
        raise AssertionError(
            f"missing tables: {sorted(expected - found)}, unexpected: {sorted(found - expected)}"
        )


def table_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count. Counting reads no columns."""
    counts = [
        count_rows(df).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def total_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: the rows of all tables together."""
    return table_rows(tables).agg(F.sum("row_count").alias("total_rows"))


def assert_total_rows(tables: Mapping[str, DataFrame], expected: int) -> None:
    """Fail unless the tables hold exactly ``expected`` rows together."""
    actual = total_rows(tables).first().total_rows
    if actual != expected:
        raise AssertionError(f"expected {expected} rows in total, found {actual}")
