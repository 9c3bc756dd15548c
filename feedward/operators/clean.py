"""Clean layer: typing, null defaults, whitelists, referential filters, dedup.

The ``valid_*`` functions do what concerns a table alone; the ``clean_*``
functions add the referential filter. Output column names are fixed values of the contract.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedward.functions import any_present, day_of, is_positive, percent, second_of
from feedward.operators.joins import LOCATOR, fetched, having_parent, keep_first, located

# The statuses each feed may carry and the marker for "no latency".
CONSENT_STATUSES = ("active", "revoked", "expired")
FEED_STATUSES = ("success", "failed", "partial")
NO_LATENCY = -1

CUSTOMER_COLUMNS = ("customer_id", "full_name", "email", "phone", "state", "created_at")


def clean_customers(raw: DataFrame) -> DataFrame:
    """Drop rows that are entirely empty; a missing id alone is kept."""
    kept = raw.filter(any_present(CUSTOMER_COLUMNS))
    return kept.select(*CUSTOMER_COLUMNS[:-1], day_of(F.col("created_at")).alias("created_at"))


def is_valid_account(as_of: date) -> Column:
    """Has an id and was opened no later than ``as_of``."""
    return F.col("account_id").isNotNull() & (day_of(F.col("open_date")) <= F.lit(as_of))


def valid_accounts(raw: DataFrame, as_of: date) -> DataFrame:
    """Valid accounts, missing balances set to 0 and flagged."""
    opened = day_of(F.col("open_date"))
    balance = F.col("balance_aud")
    return raw.filter(is_valid_account(as_of)).select(
        "account_id",
        "customer_id",
        "data_holder",
        "account_type",
        F.coalesce(balance.cast("double"), F.lit(0.0)).alias("balance_aud"),
        "currency",
        "status",
        opened.alias("open_date"),
        second_of(F.col("last_updated")).alias("last_updated"),
        balance.isNull().cast("int").alias("flag_null_balance"),
    )


def clean_accounts(
    raw: DataFrame, customers: DataFrame, as_of: date, *, unique_parent: bool = False
) -> DataFrame:
    """Valid accounts of known customers."""
    valid = valid_accounts(raw, as_of)
    return having_parent(valid, customers, "customer_id", unique_parent=unique_parent)


def is_valid_consent() -> Column:
    """Has an id and a known status."""
    return F.col("consent_id").isNotNull() & F.col("status").isin(*CONSENT_STATUSES)


def valid_consents(raw: DataFrame) -> DataFrame:
    """Consents with a known status."""
    stamps = [
        second_of(F.col(name)).alias(name) for name in ("created_at", "expires_at", "revoked_at")
    ]
    return raw.filter(is_valid_consent()).select(
        "consent_id",
        "customer_id",
        "data_holder",
        "status",
        "scopes",
        *stamps,
        F.col("sharing_duration_days").cast("int").alias("sharing_duration_days"),
    )


def clean_consents(
    raw: DataFrame, customers: DataFrame, *, unique_parent: bool = False
) -> DataFrame:
    """Valid consents of known customers."""
    return having_parent(
        valid_consents(raw), customers, "customer_id", unique_parent=unique_parent
    )


def valid_transactions(
    raw: DataFrame,
    order_by: Sequence[str] | None = None,
    *,
    dedup: Literal["first", "keep_all"] = "first",
) -> DataFrame:
    """Positive transactions with an id.

    ``dedup="first"`` keeps the first raw row of each id and only then filters,
    so an id whose first row is invalid disappears. ``"keep_all"`` keeps every
    row that has an id.
    """
    return _typed_transactions(_kept_transactions(raw, order_by, dedup))


def _kept_transactions(raw: DataFrame, order_by: Sequence[str] | None, dedup: str) -> DataFrame:
    if dedup == "first":
        rows = keep_first(raw, "transaction_id", order_by)
    elif dedup == "keep_all":
        rows = raw.filter(F.col("transaction_id").isNotNull())
    else:
        raise ValueError(f"unknown dedup mode: {dedup!r}")
    return rows.filter(is_positive(F.col("amount_aud")))


def _typed_transactions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "transaction_id",
        "account_id",
        "transaction_type",
        F.col("amount_aud").cast("double").alias("amount_aud"),
        "currency",
        "merchant_name",
        second_of(F.col("transaction_date")).alias("transaction_date"),
        second_of(F.col("posted_date")).alias("posted_date"),
        "description",
        "status",
    )


def clean_transactions(
    raw: DataFrame,
    accounts: DataFrame,
    order_by: Sequence[str] | None = None,
    *,
    dedup: Literal["first", "keep_all"] = "first",
    unique_parent: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Valid transactions on clean accounts.

    ``stored`` says that raw is a plan over Parquet files which only projects and
    filters. Which rows stay is then decided on ids, order, account and amount
    alone, and the whole rows are fetched by their place in the files. Where all rows
    with an id stay there is nothing to decide: they meet their accounts in a hash join.
    """
    if stored and dedup == "keep_all":
        valid = valid_transactions(raw, dedup=dedup)
        return having_parent(valid, accounts, "account_id", unique_parent=unique_parent, hashed=True)
    if not stored:
        valid = valid_transactions(raw, order_by, dedup=dedup)
        return having_parent(valid, accounts, "account_id", unique_parent=unique_parent)
    rows = located(raw)
    if order_by is None:
        order_by = [name for name in raw.columns if name != "transaction_id"]
    needed = dict.fromkeys(["transaction_id", "account_id", "amount_aud", *order_by, *LOCATOR])
    kept = _kept_transactions(rows.select(*needed), order_by, dedup).select("account_id", *LOCATOR)
    matched = having_parent(kept, accounts, "account_id", unique_parent=unique_parent)
    return _typed_transactions(fetched(rows, matched.select(*LOCATOR)))


def clean_feed_logs(raw: DataFrame) -> DataFrame:
    """Feed runs with a known status, typed, with the share of missing records."""
    expected = F.col("records_expected").cast("bigint")
    received = F.col("records_received").cast("bigint")
    latency = F.col("latency_ms").cast("bigint")
    valid = raw.filter(F.col("feed_log_id").isNotNull() & F.col("status").isin(*FEED_STATUSES))
    return valid.select(
        "feed_log_id",
        "data_holder",
        "feed_type",
        second_of(F.col("run_at")).alias("run_at"),
        "status",
        expected.alias("records_expected"),
        received.alias("records_received"),
        F.coalesce(latency, F.lit(NO_LATENCY)).alias("latency_ms"),
        "error_code",
        "ingestion_version",
        percent(expected - received, expected, 2).alias("variance_pct"),
    )


# The partition column of stored feed logs.
RUN_DAY = "run_day"


def with_run_day(logs: DataFrame) -> DataFrame:
    """Feed logs with the day to partition them by."""
    return logs.withColumn(RUN_DAY, day_of(F.col("run_at")))


def of_days(logs: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Runs of the days from ``since`` to ``until``; logs stored by day are read for those days alone."""
    day = F.col(RUN_DAY) if RUN_DAY in logs.columns else day_of(F.col("run_at"))
    if since is not None:
        logs = logs.filter(day >= F.lit(since))
    return logs if until is None else logs.filter(day <= F.lit(until))
