"""Summary measures behind the dashboard, computed from the KPI tables.

Means of daily values (``_unweighted``) and means over runs (``_weighted``) are
different numbers; both are given, each under its own name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedward.functions import count_where, percent, round_half_up, shortfall_ratio
from feedward.operators import sums
from feedward.operators.checks import compare_counts
from feedward.operators.kpi import (
    BREACH_THRESHOLD,
    feed_health,
    reconciled_totals,
    timed_latency,
    timed_totals,
)


def _is_breach() -> Column:
    return F.col("reconciliation_status") == "BREACH"


def holder_reliability(health: DataFrame) -> DataFrame:
    """Success rate per holder: mean of daily rates, and over all its runs."""
    return health.groupBy("data_holder").agg(
        F.sum("total_runs").alias("total_runs"),
        round_half_up(F.avg("success_rate_pct"), 1).alias("success_rate_unweighted"),
        percent(F.sum("success_count"), F.sum("total_runs"), 1).alias("success_rate_weighted"),
    )


def breach_share(recon: DataFrame, health: DataFrame) -> DataFrame:
    """Breached groups, as a share of reconciled groups and of all runs."""
    none = F.lit(0).cast("bigint")
    groups = recon.agg(
        count_where(_is_breach()).alias("breach_groups"), F.count("*").alias("recon_groups")
    ).withColumn("total_runs", none)
    runs = health.agg(F.coalesce(F.sum("total_runs"), none).alias("total_runs")).select(
        none.alias("breach_groups"), none.alias("recon_groups"), "total_runs"
    )
    totals = groups.unionByName(runs).agg(
        *[F.sum(name).alias(name) for name in ("breach_groups", "recon_groups", "total_runs")]
    )
    breached = F.col("breach_groups")
    return totals.select(
        "*",
        percent(breached, F.col("recon_groups"), 2).alias("share_of_groups_pct"),
        percent(breached, F.col("total_runs"), 2).alias("share_of_runs_pct"),
    )


def breach_rollup(recon: DataFrame) -> DataFrame:
    """Per holder and feed type, over its breached groups only."""
    return (
        recon.filter(_is_breach())
        .groupBy("data_holder", "feed_type")
        .agg(
            F.count("*").alias("breach_groups"),
            F.sum("total_expected").alias("total_expected"),
            F.sum("total_received").alias("total_received"),
            F.sum("total_gap").alias("total_gap"),
            round_half_up(F.avg("gap_pct"), 2).alias("avg_gap_pct"),
        )
    )


def worst_reconciliation(recon: DataFrame, n: int = 1, by: str = "avg_gap_pct") -> DataFrame:
    """The ``n`` worst entries of :func:`breach_rollup`, ties broken by name."""
    return breach_rollup(recon).orderBy(F.desc(by), "data_holder", "feed_type").limit(n)


def rows_removed(raw_count: DataFrame, clean_count: DataFrame) -> DataFrame:
    """How many rows cleaning took out of a table, from its two row counts."""
    counts = compare_counts({"rows_removed": (raw_count, clean_count)})
    return counts.drop("check_name", "status")


def holder_latency(health: DataFrame, logs: DataFrame) -> DataFrame:
    """Mean latency per holder: of its daily means, and of its timed runs.

    The KPI table does not hold the number of timed runs, so both tables feed
    one aggregation; each leaves the other's column empty, and means skip NULL.
    """
    daily = health.select(
        "data_holder",
        F.col("avg_latency_ms").alias("daily_ms"),
        F.lit(None).cast("bigint").alias("run_ms"),
    )
    runs = logs.select(
        "data_holder", F.lit(None).cast("double").alias("daily_ms"), timed_latency().alias("run_ms")
    )
    return (
        daily.unionByName(runs)
        .groupBy("data_holder")
        .agg(
            round_half_up(F.avg("daily_ms"), 0).alias("latency_ms_unweighted"),
            round_half_up(F.avg("run_ms"), 0).alias("latency_ms_weighted"),
        )
    )


def consent_trend(summary: DataFrame) -> DataFrame:
    """Consents by month of creation and status."""
    monthly = summary.groupBy(F.trunc("consent_date", "month").alias("consent_month")).agg(
        F.sum("active_count").alias("active"),
        F.sum("revoked_count").alias("revoked"),
        F.sum("expired_count").alias("expired"),
    )
    return monthly.unpivot(
        "consent_month", ["active", "revoked", "expired"], "status", "consent_count"
    )


def status_mix(health: DataFrame) -> DataFrame:
    """Runs by status per holder, and the share that arrived partially."""
    return health.groupBy("data_holder").agg(
        F.sum("success_count").alias("success_runs"),
        F.sum("partial_count").alias("partial_runs"),
        F.sum("failed_count").alias("failed_runs"),
        percent(F.sum("partial_count"), F.sum("total_runs"), 1).alias("partial_share_pct"),
    )


def volume_trend(volumes: DataFrame) -> DataFrame:
    """Transactions per account type and day."""
    keys = ["account_type", "txn_date"]
    parts = sums.split(volumes, F.col("total_amount_aud"))
    return (
        sums.by_bin(parts, keys, F.sum("txn_count").alias("txn_count"))
        .groupBy(*keys)
        .agg(F.sum("txn_count").alias("txn_count"), sums.total().alias("total_amount_aud"))
    )


def feed_grains(logs: DataFrame) -> DataFrame:
    """The measures of feed runs per holder, per day and over all, from one scan of the logs.

    Without any run there are no rows.

    Runs are added up per holder, feed type and day, which is where daily rates, daily mean
    latencies and breaches are defined; GROUPING SETS then roll those groups up to every grain at once. ``grain``
    tells them apart, and the columns that a grain does not have are NULL.
    """
    daily = feed_health(logs, *reconciled_totals(), *timed_totals())
    expected, received = F.col("incomplete_expected"), F.col("incomplete_received")
    breached = shortfall_ratio(expected, received) > BREACH_THRESHOLD
    daily = daily.select("*", (F.col("incomplete_runs") > 0).alias("reconciled"), breached.alias("breached"))
    runs, holder, day = F.sum("total_runs"), F.col("data_holder"), F.col("feed_date")
    grains = daily.groupingSets([[holder], [day], []], holder, day)
    return grains.agg(
        # One bit for each key that is left out, the first key's the higher.
        F.element_at(F.lit(["holder", "day", "all"]), F.grouping_id().cast("int")).alias("grain"),
        F.coalesce(runs, F.lit(0)).alias("total_runs"),
        round_half_up(F.avg("success_rate_pct"), 1).alias("success_rate_unweighted"),
        percent(F.sum("success_count"), runs, 1).alias("success_rate_weighted"),
        percent(F.sum("partial_count"), runs, 1).alias("partial_share_pct"),
        round_half_up(F.avg("avg_latency_ms"), 0).alias("latency_ms_unweighted"),
        round_half_up(F.sum("latency_sum") / F.nullif(F.sum("timed_runs"), F.lit(0)), 0).alias(
            "latency_ms_weighted"
        ),
        count_where(F.col("reconciled")).alias("recon_groups"),
        count_where(F.col("reconciled") & F.col("breached")).alias("breach_groups"),
    )


def of_grain(grains: DataFrame, grain: str) -> DataFrame:
    """The rows of :func:`feed_grains` at one grain: ``holder``, ``day`` or ``all``."""
    return grains.filter(F.col("grain") == grain)


def kpi_cards(grains: DataFrame, consents: DataFrame) -> DataFrame:
    """Four headline numbers, one row each, from :func:`feed_grains` and the consent summary."""
    active = consents.agg(F.coalesce(F.sum("active_count"), F.lit(0)).cast("double").alias("value"))
    named = {
        "success_rate_pct": F.col("success_rate_weighted"),
        "breach_groups": F.coalesce("breach_groups", F.lit(0)).cast("double"),
        "avg_latency_ms": F.col("latency_ms_weighted"),
    }
    rows = [F.struct(F.lit(card).alias("card"), value.alias("value")) for card, value in named.items()]
    # Without any run there is no such grain, and one row of NULLs in its place.
    measures = ("success_rate_weighted", "breach_groups", "latency_ms_weighted")
    overall = of_grain(grains, "all").agg(*[F.max(name).alias(name) for name in measures])
    feeds = overall.select(F.inline(F.array(*rows)))
    return feeds.unionByName(active.select(F.lit("active_consents").alias("card"), "value"))


def extremes(df: DataFrame, entity: str, *measures: str) -> DataFrame:
    """Per measure the entity with the lowest and with the highest value, ties broken by name.

    All ends come from one aggregation. A measure without any value has no rows.
    """
    ends, rows = [], []
    name = F.col(entity)
    for number, measure in enumerate(measures):
        value = F.col(measure)
        for position, rank in (("lowest", value), ("highest", -value)):
            end = f"{position}_{number}"
            candidate = F.struct(rank.alias("rank"), name.alias("entity"), value.alias("value"))
            ends.append(F.min(F.when(value.isNotNull(), candidate)).alias(end))
            rows.append(
                F.struct(
                    F.lit(measure).alias("measure"),
                    F.lit(position).alias("position"),
                    F.col(end)["entity"].alias(entity),
                    F.col(end)["value"].cast("double").alias("value"),
                )
            )
    found = df.agg(*ends).select(F.inline(F.array(*rows)))
    return found.filter(F.col("value").isNotNull())
