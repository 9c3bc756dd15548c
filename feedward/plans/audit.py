"""The audit: fifteen checks over the raw and clean layers as one DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedward.functions import any_present, count_where, day_of, is_positive
from feedward.operators import checks, clean
from feedward.operators.clean import CONSENT_STATUSES
from feedward.operators.joins import ranked
from feedward.operators.kpi import BREACH_THRESHOLD
from feedward.plans.tables import Layers

MAX_FEED_AGE = timedelta(days=1)
MAX_DROPPED_PCT = 10


@dataclass(frozen=True)
class Check:
    """What a check is called, what it looks at, and how its result is reported."""

    name: str
    table: str
    level: str
    note: str


# Names, tables, levels and note texts of the audit log, in its order.
CHECKS = (
    Check(
        "null_balance",
        "raw_accounts",
        "FAIL",
        "{n} accounts had null balance — replaced with 0.00 in clean layer",
    ),
    Check(
        "future_open_date",
        "raw_accounts",
        "FAIL",
        "{n} accounts had future open_date — excluded from clean layer",
    ),
    Check("orphaned_accounts", "raw_accounts", "FAIL", "{n} accounts with no matching customer_id"),
    Check(
        "null_customer_id",
        "raw_consents",
        "FAIL",
        "{n} consents with no customer_id — compliance risk, excluded from clean layer",
    ),
    Check(
        "invalid_consent_status",
        "raw_consents",
        "FAIL",
        "{n} consents with unrecognised status value",
    ),
    Check(
        "duplicate_transaction_ids",
        "raw_transactions",
        "FAIL",
        "{n} duplicate transaction_ids — deduplicated in clean layer",
    ),
    Check(
        "invalid_amount",
        "raw_transactions",
        "FAIL",
        "{n} transactions with zero or negative amount — excluded",
    ),
    Check(
        "orphaned_transactions",
        "raw_transactions",
        "FAIL",
        "{n} transactions with no matching account_id — excluded",
    ),
    Check(
        "reconciliation_breach",
        "clean_feed_logs",
        "FAIL",
        "{n} feeds where records received fell >5% below expected",
    ),
    Check(
        "stale_feed",
        "clean_feed_logs",
        "WARN",
        "{n} data holders have not sent a feed in the last 24 hours",
    ),
    Check(
        "missing_latency",
        "raw_feed_logs",
        "WARN",
        "{n} non-failed feeds missing latency_ms — set to -1 sentinel in clean layer",
    ),
    Check("row_count_clean_accounts", "raw_accounts→clean_accounts", "WARN", ""),
    Check("row_count_clean_transactions", "raw_transactions→clean_transactions", "WARN", ""),
    Check("row_count_clean_consents", "raw_consents→clean_consents", "WARN", ""),
    Check("row_count_clean_feed_logs", "raw_feed_logs→clean_feed_logs", "WARN", ""),
)
ROW_COUNT_NOTE = "%d raw → %d clean (%d dropped, %s%%)"

CHECK_NAMES = tuple(check.name for check in CHECKS)


def row_conditions(as_of: datetime) -> dict[str, dict[str, Column]]:
    """Checks on a row's own values, by table."""
    return {
        "raw_accounts": {
            "null_balance": F.col("balance_aud").isNull(),
            "future_open_date": day_of(F.col("open_date")) > F.lit(as_of.date()),
        },
        "raw_consents": {
            "null_customer_id": F.col("customer_id").isNull(),
            "invalid_consent_status": checks.outside_domain("status", CONSENT_STATUSES),
        },
        "raw_transactions": {"invalid_amount": F.col("amount_aud") <= 0},
        "clean_feed_logs": {
            "reconciliation_breach": checks.short_of(
                "records_expected", "records_received", BREACH_THRESHOLD
            ),
        },
        "raw_feed_logs": {
            "missing_latency": F.col("latency_ms").isNull() & (F.col("status") != "failed"),
        },
    }


def run_checks(
    tables: Layers,
    as_of: datetime,
    names: Iterable[str] = CHECK_NAMES,
    feeds_as_of: datetime | None = None,
    feed_days: tuple[date | None, date | None] = (None, None),
) -> DataFrame:
    """One verdict row per named check.

    ``feeds_as_of`` gives feed freshness a reference time of its own. ``feed_days``, the first and the last,
    bound the feed runs that are looked at; clean logs stored by day are read for those days alone.

    The checks share scans: customers, accounts and consents are added up per customer in one
    aggregation, transactions and accounts per account in another, feed logs per holder.
    """
    wanted = set(names)
    if unknown := wanted - set(CHECK_NAMES):
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    measured = [
        *_by_customer(tables, as_of, wanted),
        *_by_account(tables, as_of, wanted),
        *_by_holder(tables, as_of, feeds_as_of or as_of, wanted, feed_days),
    ]
    rows = reduce(DataFrame.unionByName, measured)
    return _verdicts(_paired(rows))


def _measured(df: DataFrame, values: Mapping[tuple[str, str], Column]) -> DataFrame:
    """(check_name, side, value) rows from one aggregation; side is empty, raw or clean."""
    named = {f"m{i}": label for i, label in enumerate(values)}
    one = df.agg(*[value.alias(name) for name, value in zip(named, values.values(), strict=True)])
    rows = [
        F.struct(
            F.lit(check).alias("check_name"), F.lit(side).alias("side"), F.col(name).alias("value")
        )
        for name, (check, side) in named.items()
    ]
    return one.select(F.inline(F.array(*rows)))


def _written_count(tables: Layers, name: str) -> DataFrame:
    """The rows of a stored clean table, for its layer check."""
    return _measured(tables[name], {(f"row_count_{name}", "clean"): F.count("*")})


def _by_customer(tables: Layers, as_of: datetime, wanted: set[str]) -> list[DataFrame]:
    """Checks on accounts and consents: one scan each of them and of customers.

    Without a check that needs customers the rows are only counted.
    """
    one = F.lit(1).cast("bigint")
    valid = {
        "accounts": clean.is_valid_account(tables.as_of),
        "consents": clean.is_valid_consent(),
    }
    sides, values, results, parents = [], [], [], {}
    for stem, is_valid in valid.items():
        raw, layer = f"raw_{stem}", f"row_count_clean_{stem}"
        counters = {
            name: checks.flag(condition)
            for name, condition in row_conditions(as_of)[raw].items()
            if name in wanted
        }
        own = {(name, ""): checks.total_of(name) for name in counters}
        if stem == "accounts" and "orphaned_accounts" in wanted:
            counters[stem] = parents["known"] = one
            own["orphaned_accounts", ""] = checks.orphan_count(stem, "known")
        if layer in wanted:
            counters[stem] = one
            own[layer, "raw"] = checks.total_of(stem)
            if tables.is_written(f"clean_{stem}"):
                results.append(_written_count(tables, f"clean_{stem}"))
            else:
                counters[f"valid_{stem}"] = checks.flag(is_valid)
                parents["clean"] = checks.flag(any_present(clean.CUSTOMER_COLUMNS))
                own[layer, "clean"] = checks.matched_count(f"valid_{stem}", "clean")
        if counters:
            sides.append((tables[raw], "customer_id", counters))
            values.append(own)
    if parents:
        sides.append((tables["raw_customers"], "customer_id", parents))
        results.append(_measured(checks.per_key(sides), reduce(or_, values)))
        return results
    for (df, _, counters), own in zip(sides, values, strict=True):
        rows = df.select(*[counter.alias(name) for name, counter in counters.items()])
        results.append(_measured(rows, own))
    return results


def _by_account(tables: Layers, as_of: datetime, wanted: set[str]) -> list[DataFrame]:
    """Checks on transactions: at most two scans of them and one clean accounts table.

    One scan adds up all rows by account. The other finds the first two rows
    of each id, which tell both the row that stays and that the id repeats.
    """
    layer = "row_count_clean_transactions"
    if not wanted & {
        "duplicate_transaction_ids", "invalid_amount", "orphaned_transactions", layer,
    }:
        return []
    one, positive = F.lit(1).cast("bigint"), is_positive(F.col("amount_aud"))
    raw = tables["raw_transactions"]
    has_id = F.col("transaction_id").isNotNull()
    invalid = row_conditions(as_of)["raw_transactions"]["invalid_amount"]
    counted = layer in wanted and not tables.is_written("clean_transactions")
    first = counted and tables.dedup == "first"
    counters, values, results, sides = {}, {}, [], []
    if "invalid_amount" in wanted:
        counters["invalid"] = checks.flag(invalid)
        values["invalid_amount", ""] = checks.total_of("invalid")
    if layer in wanted:
        counters["transactions"] = one
        values[layer, "raw"] = checks.total_of("transactions")
        if not counted:
            results.append(_written_count(tables, "clean_transactions"))
    if "orphaned_transactions" in wanted:
        counters["transactions"] = one
        values["orphaned_transactions", ""] = checks.orphan_count("transactions", "parents")
    if counted:
        if not first:
            counters["kept"] = checks.flag(has_id & positive)
        values[layer, "clean"] = checks.matched_count("kept", "parents")
    if first:
        firsts = ranked(raw, "transaction_id", tables.order_by).filter(F.col("_rank") <= 2)
        ids = {"kept": checks.flag((F.col("_rank") == 1) & has_id & positive)}
        if "duplicate_transaction_ids" in wanted:
            ids["repeated"] = checks.flag(F.col("_rank") == 2)
            values["duplicate_transaction_ids", ""] = checks.total_of("repeated")
        sides.append((firsts, "account_id", ids))
    elif "duplicate_transaction_ids" in wanted:
        repeated = checks.unique_check(raw, ["transaction_id"])
        results.append(
            _measured(repeated, {("duplicate_transaction_ids", ""): F.sum(checks.COUNT)})
        )
    if counted or "orphaned_transactions" in wanted:
        sides.append((tables["clean_accounts"], "account_id", {"parents": one}))
    if counters:
        sides.append((raw, "account_id", counters))
    if len(sides) > 1:
        results.append(_measured(checks.per_key(sides), values))
    elif sides:
        rows = raw.select(*[counter.alias(name) for name, counter in counters.items()])
        results.append(_measured(rows, values))
    return results


def _by_holder(
    tables: Layers,
    as_of: datetime,
    feeds_as_of: datetime,
    wanted: set[str],
    feed_days: tuple[date | None, date | None],
) -> list[DataFrame]:
    """Checks on feed logs: one scan of the raw and one of the clean table."""
    layer, results = "row_count_clean_feed_logs", []
    if not wanted & {"missing_latency", "reconciliation_breach", "stale_feed", layer}:
        return []
    conditions = row_conditions(as_of)
    raw = {
        (name, ""): count_where(condition)
        for name, condition in conditions["raw_feed_logs"].items()
        if name in wanted
    }
    own = {
        name: condition
        for name, condition in conditions["clean_feed_logs"].items()
        if name in wanted
    }
    if layer in wanted:
        raw[layer, "raw"] = F.count("*")
    if raw:
        results.append(_measured(clean.of_days(tables["raw_feed_logs"], *feed_days), raw))
    logs = clean.of_days(tables["clean_feed_logs"], *feed_days)
    if "stale_feed" in wanted:
        holders = logs.groupBy("data_holder").agg(
            F.max("run_at").alias("latest"),
            F.count("*").alias("runs"),
            *[count_where(condition).alias(name) for name, condition in own.items()],
        )
        stale = checks.outdated("latest", feeds_as_of, MAX_FEED_AGE)
        values = {("stale_feed", ""): count_where(stale)}
        values |= {(name, ""): checks.total_of(name) for name in own}
        if layer in wanted:
            values[layer, "clean"] = checks.total_of("runs")
        results.append(_measured(holders, values))
    else:
        values = {(name, ""): count_where(condition) for name, condition in own.items()}
        if layer in wanted:
            values[layer, "clean"] = F.count("*")
        if values:
            results.append(_measured(logs, values))
    return results


def _paired(measured: DataFrame) -> DataFrame:
    """One row per check: its count, or the two counts of its layers and what was lost."""
    value, side = F.col("value"), F.col("side")
    sides = measured.groupBy("check_name").agg(
        *[
            F.max(F.when(side == name, value)).alias(column)
            for name, column in (("", "counted"), ("raw", "raw_rows"), ("clean", "clean_rows"))
        ]
    )
    dropped, pct, status = checks.lost_rows(F.col("raw_rows"), F.col("clean_rows"), MAX_DROPPED_PCT)
    is_layer = F.col("raw_rows").isNotNull()
    return sides.select(
        "check_name",
        "raw_rows",
        "clean_rows",
        F.coalesce("counted", dropped).alias(checks.COUNT),
        pct,
        F.when(is_layer, status).alias("status"),
    )


def audit_log(
    tables: Layers, as_of: datetime, run_at: datetime, feeds_as_of: datetime | None = None
) -> DataFrame:
    """All checks with one run timestamp; ``check_no`` gives the log's order."""
    stamp = F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S")).alias("run_at")
    verdicts = run_checks(tables, as_of, feeds_as_of=feeds_as_of)
    return verdicts.select("check_no", stamp, *[c for c in verdicts.columns if c != "check_no"])


def audit_summary(audit: DataFrame) -> DataFrame:
    """Number of checks that passed, failed and warned."""
    return audit.agg(
        F.count("*").alias("total_checks"),
        *[
            count_where(F.col("status") == status).alias(name)
            for status, name in (("PASS", "passed"), ("FAIL", "failed"), ("WARN", "warned"))
        ],
    )


def _verdicts(measured: DataFrame) -> DataFrame:
    """Put number, table, status and note to the measured counts."""
    number = F.array_position(F.lit(list(CHECK_NAMES)), F.col("check_name")).cast("int")

    def attribute(field: str) -> Column:
        return F.element_at(F.lit([getattr(check, field) for check in CHECKS]), number)

    count, raw_rows = F.col(checks.COUNT), F.col("raw_rows")
    # An empty raw table has no percentage to format; the log then says plain 0.
    pct = F.when(raw_rows == 0, F.lit("0")).otherwise(
        F.format_string("%.1f", F.col("dropped_pct").cast("double"))
    )
    counted_note = F.replace(attribute("note"), F.lit("{n}"), count.cast("string"))
    layer_note = F.format_string(
        ROW_COUNT_NOTE, raw_rows.cast("bigint"), F.col("clean_rows").cast("bigint"), count, pct
    )
    return measured.select(
        number.alias("check_no"),
        "check_name",
        attribute("table").alias("table"),
        F.coalesce("status", checks.status_of(count, attribute("level"))).alias("status"),
        count.alias("rows_affected"),
        F.when(raw_rows.isNull(), counted_note).otherwise(layer_note).alias("note"),
    )
