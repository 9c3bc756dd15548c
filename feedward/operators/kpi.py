"""KPI layer: daily health, consent, reconciliation and volume tables.

Each is one hash aggregation with map-side partials, so hot holders or days
cost no more than cold ones. Output column names are fixed values of the contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from feedward.functions import (
    breach_label,
    count_where,
    day_of,
    percent,
    round_half_up,
    shortfall_ratio,
)
from feedward.operators import sums

# Reconciliation tolerance and the run statuses it looks at.
BREACH_THRESHOLD = 0.05
INCOMPLETE_STATUSES = ("partial", "failed")

VOLUME_KEYS = ("account_type", "data_holder", "txn_date", "transaction_type")

# A total of amounts, and how often it counts; their product has all its ten places in 38 digits.
_TOTAL = DecimalType(27, 10)
_TIMES = DecimalType(10, 0)
# Below it, a million million products add up to a decimal.
_SAFE_PRODUCT = 1e16


def timed_latency() -> Column:
    """Latency of runs that have one; zero and the -1 marker count as missing."""
    latency = F.col("latency_ms")
    return F.when(latency > 0, latency)


def timed_totals() -> list[Column]:
    """What a mean latency over further groups needs."""
    return [F.sum(timed_latency()).alias("latency_sum"), F.count(timed_latency()).alias("timed_runs")]


def reconciled_totals() -> list[Column]:
    """Incomplete runs, and the records that they expected and received."""
    incomplete = F.col("status").isin(*INCOMPLETE_STATUSES)
    return [
        count_where(incomplete).alias("incomplete_runs"),
        F.sum(F.when(incomplete, F.col("records_expected"))).alias("incomplete_expected"),
        F.sum(F.when(incomplete, F.col("records_received"))).alias("incomplete_received"),
    ]


def feed_health(logs: DataFrame, *others: Column) -> DataFrame:
    """Per holder, feed type and day: runs by status, latency, record totals, and other aggregates."""
    succeeded = count_where(F.col("status") == "success")
    return logs.groupBy("data_holder", "feed_type", day_of(F.col("run_at")).alias("feed_date")).agg(
        F.count("*").alias("total_runs"),
        succeeded.alias("success_count"),
        count_where(F.col("status") == "failed").alias("failed_count"),
        count_where(F.col("status") == "partial").alias("partial_count"),
        percent(succeeded, F.count("*"), 1).alias("success_rate_pct"),
        round_half_up(F.avg(timed_latency()), 0).alias("avg_latency_ms"),
        F.max(timed_latency()).cast("double").alias("max_latency_ms"),
        F.sum("records_expected").alias("total_records_expected"),
        F.sum("records_received").alias("total_records_received"),
        *others,
    )


def consent_summary(consents: DataFrame) -> DataFrame:
    """Per holder and day of creation: consents by status and mean duration."""
    active = count_where(F.col("status") == "active")
    return consents.groupBy("data_holder", day_of(F.col("created_at")).alias("consent_date")).agg(
        F.count("*").alias("total_consents"),
        active.alias("active_count"),
        count_where(F.col("status") == "revoked").alias("revoked_count"),
        count_where(F.col("status") == "expired").alias("expired_count"),
        percent(active, F.count("*"), 1).alias("active_rate_pct"),
        round_half_up(F.avg("sharing_duration_days"), 0).alias("avg_sharing_days"),
    )


def reconciliation(logs: DataFrame, threshold: float = BREACH_THRESHOLD) -> DataFrame:
    """Per holder, feed type and day, over incomplete runs: records missing.

    The label compares the unrounded ratio; ``gap_pct`` is rounded.
    """
    totals = (
        logs.filter(F.col("status").isin(*INCOMPLETE_STATUSES))
        .groupBy("data_holder", "feed_type", day_of(F.col("run_at")).alias("feed_date"))
        .agg(
            F.sum("records_expected").alias("total_expected"),
            F.sum("records_received").alias("total_received"),
        )
    )
    expected, received = F.col("total_expected"), F.col("total_received")
    return totals.select(
        "*",
        (expected - received).alias("total_gap"),
        percent(expected - received, expected, 2).alias("gap_pct"),
        breach_label(shortfall_ratio(expected, received), threshold).alias(
            "reconciliation_status"
        ),
    )


def transaction_volumes(
    transactions: DataFrame, accounts: DataFrame, *, matched: bool = True
) -> DataFrame:
    """Per account type, holder, day and transaction type: count and amounts.

    Transactions meet their accounts first, which shuffles four narrow columns once, and are totalled in the
    tasks that joined them; adaptive execution splits a hot account over several. Totals by account would
    be shuffled twice and are hardly fewer than the transactions. ``matched=False`` takes valid
    transactions that have not been through the referential join yet and does
    that as well: an account id that occurs k times repeats its transactions
    once more k times. Amounts of any size are added up exactly, see
    :mod:`feedward.operators.sums`; nothing is rounded before the totals.
    """
    dated = transactions.select(
        "account_id", "transaction_type", day_of(F.col("transaction_date")).alias("txn_date"), "amount_aud"
    )
    kinds = accounts.groupBy("account_id", "account_type", "data_holder").agg(
        F.count("*").alias("copies")
    )
    times = F.col("copies")
    if not matched:
        times = times * F.sum("copies").over(Window.partitionBy("account_id"))
    kinds = kinds.withColumn("times", times).drop("copies")
    parts = sums.split(dated.join(kinds, "account_id"), F.col("amount_aud"))
    repeated = sums.by_bin(_repeated(parts), VOLUME_KEYS, F.sum("times").alias("rows"))
    return volume_totals(repeated)


def volume_states(transactions: DataFrame) -> DataFrame:
    """Partial volumes of transactions that have their account's type and holder beside them."""
    dated = transactions.withColumn("txn_date", day_of(F.col("transaction_date")))
    parts = sums.split(dated, F.col("amount_aud"))
    return sums.by_bin(parts, VOLUME_KEYS, F.count("*").alias("rows"))


def volume_totals(states: DataFrame) -> DataFrame:
    """The volumes of partial sums by group and bin."""
    count = F.sum("rows")
    return states.groupBy(*VOLUME_KEYS).agg(
        count.alias("txn_count"),
        sums.rounded_total(2).alias("total_amount_aud"),
        round_half_up(sums.total() / count, 2).alias("avg_amount_aud"),
    )


def _repeated(parts: DataFrame) -> DataFrame:
    """Split amounts as often as they count: as decimals where those hold the product, else binned."""
    fixed, times = F.col(sums.FIXED), F.col("times")
    small = (F.abs(fixed.cast("double")) * times < F.lit(_SAFE_PRODUCT)) & (times < F.lit(10**10))
    product = F.when(times == 1, fixed).otherwise(fixed.try_cast(_TOTAL) * times.try_cast(_TIMES))
    loose = F.coalesce(F.when(~small, fixed.cast("double")), sums.bin_value(), F.col(sums.SPECIAL))
    kept = parts.withColumn("_product", F.when(small, product))
    return sums.split(kept, loose * times).withColumn(
        sums.FIXED, F.coalesce(F.col("_product"), F.col(sums.FIXED)).cast("decimal(38,10)")
    )
