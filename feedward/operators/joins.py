"""Referential joins and the deduplication of keyed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedward.operators.checks import matched_count, per_key


def having_parent(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    *,
    unique_parent: bool = False,
    hashed: bool = False,
) -> DataFrame:
    """Child rows whose key exists in the parent, with the child's columns only.

    A parent key that occurs k times repeats its children k times, as an inner
    join does. Once ``unique_check`` has shown the key to be unique, pass
    ``unique_parent=True`` for a semi join.

    Only the key of the parent is shuffled. Spark broadcasts it if it measures
    below the session's threshold. Otherwise nothing but the exchange and sort
    sits under either side of the sort-merge join, which is what adaptive
    execution needs to split a hot key over several tasks. ``hashed`` does without
    the sort, which pays for wide children: a task holds its share of the parent's keys.
    """
    keys = parent.select(key)
    if hashed:
        keys = keys.hint("shuffle_hash")
    matched = child.join(keys, key, "left_semi" if unique_parent else "inner")
    return matched.select(child.columns)


def matched_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """How many rows :func:`having_parent` would give, as one row, without joining.

    A join that only feeds a count shuffles nothing but keys. A hot key then
    compresses so well that adaptive execution, which goes by bytes, does not
    see it. Counting per key on both sides first leaves one row per key and task.
    """
    one = F.lit(1).cast("bigint")
    sides = per_key([(child, key, {"children": one}), (parent, key, {"parents": one})])
    return sides.agg(matched_count("children", "parents").alias("row_count"))


def ranked(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows with their place ``_rank`` among those of the same key, NULL being a key too.

    ``order_by`` must order the rows of a key totally, or a retried task could
    pick another one. Without it all other columns are used, in table order.
    Spark turns an upper limit on the rank into a group limit ahead of the
    shuffle, so a hot key sends a few rows per task, not its whole group.
    """
    if order_by is None:
        order_by = [name for name in df.columns if name != key]
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order_by)))


def keep_first(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first row of each key, see :func:`ranked`; rows without a key are dropped."""
    first = ranked(df.filter(F.col(key).isNotNull()), key, order_by)
    return first.filter(F.col("_rank") == 1).drop("_rank")


#: A row's place among the stored files, see :func:`located`.
LOCATOR = ("_located_file", "_located_row")


def located(df: DataFrame) -> DataFrame:
    """The rows of a plan that only projects and filters stored Parquet files, with their places there."""
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return df.select("*", file.alias(LOCATOR[0]), row.alias(LOCATOR[1]))


def fetched(df: DataFrame, places: DataFrame) -> DataFrame:
    """The :func:`located` rows at the given places, as often as each place is given.

    Whatever has been decided on a few columns is applied to the whole rows here: they are
    shuffled once and never sorted. The hash table of a task holds nothing but places.
    """
    rows = df.join(places.hint("shuffle_hash"), list(LOCATOR))
    return rows.drop(*LOCATOR)
