"""KPI tables kept up to date by day: new rows are added to stored partial states of their days alone.

A state table has one row for each group of a KPI table with what can be added up: counts, sums and maxima.
It is partitioned by day, or by month where a day has few rows. An update aggregates the new rows, adds the stored states of
the days (months) that occur among them, and overwrites those partitions; others are
neither read nor written. The KPI table is a projection of its states.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedward.functions import (
    breach_label,
    count_where,
    day_of,
    percent,
    round_half_up,
    shortfall_ratio,
)
from feedward.operators import kpi, sums
from feedward.sources.files import list_paths
from feedward.sources.writers import rebuild


#: The partition column of stored states.
PERIOD = "state_period"


@dataclass(frozen=True)
class Kept:
    """How a KPI table is kept: its groups, the states of some rows, and the table from its states."""

    keys: Sequence[str]
    day: str
    added: Sequence[str]
    greatest: Sequence[str]
    states: Callable[[DataFrame], DataFrame]
    table: Callable[[DataFrame], DataFrame]
    by_month: bool = False

    def placed(self, states: DataFrame) -> DataFrame:
        """The states with the partition that each belongs to."""
        day = F.col(self.day)
        return states.withColumn(PERIOD, F.trunc(day, "month") if self.by_month else day)

    def merged(self, states: DataFrame) -> DataFrame:
        """States of the same group as one."""
        return states.groupBy(*self.keys).agg(
            *[F.sum(name).cast(dict(states.dtypes)[name]).alias(name) for name in self.added],
            *[F.max(name).alias(name) for name in self.greatest],
        )


def _feed_states(logs: DataFrame) -> DataFrame:
    return logs.groupBy("data_holder", "feed_type", day_of(F.col("run_at")).alias("feed_date")).agg(
        F.count("*").alias("total_runs"),
        *[
            count_where(F.col("status") == status).alias(f"{status}_count")
            for status in ("success", "failed", "partial")
        ],
        *kpi.timed_totals(),
        F.max(kpi.timed_latency()).alias("max_latency"),
        F.sum("records_expected").alias("total_records_expected"),
        F.sum("records_received").alias("total_records_received"),
        *kpi.reconciled_totals(),
    )


def _health(states: DataFrame) -> DataFrame:
    mean = F.col("latency_sum") / F.nullif(F.col("timed_runs"), F.lit(0))
    return states.select(
        "data_holder", "feed_type", "feed_date", "total_runs",
        "success_count", "failed_count", "partial_count",
        percent(F.col("success_count"), F.col("total_runs"), 1).alias("success_rate_pct"),
        round_half_up(mean, 0).alias("avg_latency_ms"),
        F.col("max_latency").cast("double").alias("max_latency_ms"),
        "total_records_expected", "total_records_received",
    )


def _reconciled(states: DataFrame) -> DataFrame:
    expected, received = F.col("incomplete_expected"), F.col("incomplete_received")
    return states.filter(F.col("incomplete_runs") > 0).select(
        "data_holder", "feed_type", "feed_date",
        expected.alias("total_expected"), received.alias("total_received"),
        (expected - received).alias("total_gap"),
        percent(expected - received, expected, 2).alias("gap_pct"),
        breach_label(shortfall_ratio(expected, received), kpi.BREACH_THRESHOLD).alias("reconciliation_status"),
    )


def _consent_states(consents: DataFrame) -> DataFrame:
    days = F.col("sharing_duration_days")
    return consents.groupBy("data_holder", day_of(F.col("created_at")).alias("consent_date")).agg(
        F.count("*").alias("total_consents"),
        *[
            count_where(F.col("status") == status).alias(f"{status}_count")
            for status in ("active", "revoked", "expired")
        ],
        F.sum(days).alias("sharing_days"),
        F.count(days).alias("timed_consents"),
    )


def _consents(states: DataFrame) -> DataFrame:
    mean = F.col("sharing_days") / F.nullif(F.col("timed_consents"), F.lit(0))
    return states.select(
        "data_holder", "consent_date", "total_consents", "active_count", "revoked_count", "expired_count",
        percent(F.col("active_count"), F.col("total_consents"), 1).alias("active_rate_pct"),
        round_half_up(mean, 0).alias("avg_sharing_days"),
    )


_FEEDS = {
    "keys": ("data_holder", "feed_type", "feed_date"),
    "day": "feed_date",
    "added": (
        "total_runs", "success_count", "failed_count", "partial_count", "latency_sum", "timed_runs",
        "total_records_expected", "total_records_received",
        "incomplete_runs", "incomplete_expected", "incomplete_received",
    ),
    "greatest": ("max_latency",),
    "states": _feed_states,
}

#: KPI tables by name. Volumes take transactions that have their account's type and holder beside them.
KEPT = {
    "agg_feed_health": Kept(**_FEEDS, table=_health),
    "agg_reconciliation": Kept(**_FEEDS, table=_reconciled),
    "agg_consent_summary": Kept(
        keys=("data_holder", "consent_date"),
        day="consent_date",
        added=(
            "total_consents", "active_count", "revoked_count", "expired_count", "sharing_days", "timed_consents",
        ),
        greatest=(),
        states=_consent_states,
        table=_consents,
        by_month=True,
    ),
    "agg_transaction_volumes": Kept(
        keys=(*kpi.VOLUME_KEYS, sums.BIN),
        day="txn_date",
        added=("rows", sums.FIXED, sums.UNITS, sums.SPECIAL),
        greatest=(),
        states=kpi.volume_states,
        table=kpi.volume_totals,
        by_month=True,
    ),
}


def update(name: str, new_rows: DataFrame, path: str) -> DataFrame:
    """Add clean rows to the stored states of a KPI table at ``path`` and return the whole table.

    Rows may be of any day, late ones too; the periods of one update, which are listed on the driver, select the
    partitions that are read. Rows without a day have a partition of their own. The new
    states are written aside first: partitions are not replaced by a plan that reads them. Adding the
    same rows again counts them again.
    """
    kept, spark = KEPT[name], new_rows.sparkSession
    fresh = rebuild(spark, kept.states(new_rows), f"{path}/fresh")
    stored = f"{path}/states"
    if list_paths(spark, f"{stored}/{PERIOD}=*"):
        periods = [row[0] for row in kept.placed(fresh).select(PERIOD).distinct().collect()]
        changed = F.col(PERIOD).isin([period for period in periods if period is not None])
        if None in periods:
            changed = changed | F.col(PERIOD).isNull()
        before = _stored(spark, kept, stored, fresh).filter(changed).select(*fresh.columns)
        fresh = rebuild(spark, kept.merged(before.unionByName(fresh)), f"{path}/fresh")
    # One file for each partition, however many tasks the states came from.
    write = kept.placed(fresh).repartition(PERIOD).write.mode("overwrite")
    write.option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(stored)
    return kept.table(_stored(spark, kept, stored, fresh))


def _stored(spark: SparkSession, kept: Kept, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(kept.placed(like).schema).parquet(path)
