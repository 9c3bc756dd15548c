"""Known results of one published run, recomputed from its files.

Point ``FEEDWARD_GOLDENS`` at a directory with the raw and KPI tables (``raw/``,
``agg/``) and the audit log of that run; without such files these tests are skipped.
"""

import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedward.functions import breach_label, percent, shortfall_ratio
from feedward.operators import clean, measures
from feedward.plans.audit import audit_summary, run_checks
from feedward.plans.tables import Layers
from feedward.sources.readers import load_raw_dir
from feedward.sources.schemas import RAW_SCHEMAS
from helpers import only, values

# By default the folder beside the repository, where the files of the run may lie.
GOLDENS = Path(os.environ.get("FEEDWARD_GOLDENS", Path(__file__).resolve().parents[2] / "reference" / "data"))
# This time and the numbers below are results of the published run.
AS_OF = datetime(2026, 4, 20, 16, 48, 29)

pytestmark = pytest.mark.skipif(not GOLDENS.exists(), reason="FEEDWARD_GOLDENS is not set")


@pytest.fixture(scope="module")
def layers(spark):
    raw = load_raw_dir(spark, str(GOLDENS / "raw"), RAW_SCHEMAS)
    return Layers({name: lambda name=name: raw[name] for name in raw}, AS_OF.date())


def published(spark, name, kinds):
    """A published KPI table: typed columns, without its unnamed row index."""
    df = spark.read.csv(str(GOLDENS / "agg" / f"{name}.csv"), header=True)
    return df.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in df.columns[1:]])


@pytest.fixture(scope="module")
def health(spark):
    counts = ["total_runs", "success_count", "failed_count", "partial_count"]
    counts += ["total_records_expected", "total_records_received"]
    kinds = dict.fromkeys(counts, "bigint") | {"feed_date": "date"}
    kinds |= dict.fromkeys(["success_rate_pct", "avg_latency_ms", "max_latency_ms"], "double")
    return published(spark, "agg_feed_health", kinds)


@pytest.fixture(scope="module")
def recon(spark):
    kinds = dict.fromkeys(["total_expected", "total_received", "total_gap"], "bigint")
    return published(
        spark, "agg_reconciliation", kinds | {"feed_date": "date", "gap_pct": "double"}
    )


def test_clean_customers(layers):
    df = layers["clean_customers"]
    assert df.count() == 200
    assert df.select("customer_id").distinct().count() == 200


def test_account_checks(layers):
    names = ["null_balance", "future_open_date", "orphaned_accounts", "row_count_clean_accounts"]
    log = run_checks(layers, AS_OF, names)
    assert values(log.orderBy("check_no"), "check_no", "status", "rows_affected", "note") == [
        (1, "FAIL", 9, "9 accounts had null balance — replaced with 0.00 in clean layer"),
        (12, "PASS", 2, "320 raw → 318 clean (2 dropped, 0.6%)"),
        (2, "FAIL", 2, "2 accounts had future open_date — excluded from clean layer"),
        (3, "PASS", 0, "0 accounts with no matching customer_id"),
    ]


def test_result_depends_on_as_of(layers):
    later = clean.clean_accounts(
        layers["raw_accounts"], layers["clean_customers"], date(2026, 12, 4)
    )
    assert later.count() == 319


def test_published_audit_log_summary_and_notes(spark, layers):
    log = spark.read.csv(str(next(GOLDENS.glob("audit*.csv"))), header=True)
    assert values(audit_summary(log)) == [(15, 7, 6, 2)]
    names = ["null_balance", "future_open_date", "orphaned_accounts", "row_count_clean_accounts"]
    ours = run_checks(layers, AS_OF, names).select("check_name", "table", "status", "note")
    theirs = log.filter(F.col("check_name").isin(names)).select(ours.columns)
    assert values(ours) == values(theirs)


def test_feed_health_totals(health):
    totals = health.agg(F.count("*"), *[F.sum(c) for c in health.columns[3:7]])
    assert values(totals) == [(342, 400, 231, 79, 90)]
    assert health.filter("avg_latency_ms IS NULL AND max_latency_ms IS NULL").count() == 68


def test_reconciliation_formulas(recon):
    expected, received = F.col("total_expected"), F.col("total_received")
    same = (
        (F.col("gap_pct") == percent(expected - received, expected, 2))
        & (F.col("reconciliation_status") == breach_label(shortfall_ratio(expected, received), 0.05))
        & (F.col("total_gap") == expected - received)
    )
    assert recon.count() == recon.filter(same).count() == 161


def test_reconciled_groups_are_those_with_incomplete_runs(health, recon):
    keys = ["data_holder", "feed_type", "feed_date"]
    incomplete = health.filter("failed_count + partial_count > 0").select(keys)
    assert values(incomplete) == values(recon, *keys)


def test_holder_measures(spark, health):
    reliability = {
        row.data_holder: (row.success_rate_unweighted, row.success_rate_weighted)
        for row in measures.holder_reliability(health).collect()
    }
    assert reliability["ANZ"] == (46.4, 50.0)
    assert reliability["Bendigo Bank"] == (66.7, 68.5)
    partial = {
        row.data_holder: row.partial_share_pct for row in measures.status_mix(health).collect()
    }
    assert partial["ANZ"] == max(partial.values()) == 34.5
    assert partial["Bendigo Bank"] == 18.5
    no_logs = spark.createDataFrame([], "data_holder string, latency_ms bigint")
    latency = measures.holder_latency(health, no_logs)
    ends = measures.extremes(latency, "data_holder", "latency_ms_unweighted")
    assert ("highest", "Bendigo Bank", 4693.0) in values(ends, "position", "data_holder", "value")


def test_breach_measures(recon, health):
    assert values(measures.breach_share(recon, health)) == [(153, 161, 400, 95.03, 38.25)]
    rollup = measures.breach_rollup(recon).filter(
        "data_holder = 'ANZ' AND feed_type = 'accounts'"
    )
    assert values(rollup, "breach_groups", "total_expected", "total_received", "avg_gap_pct") == [
        (9, 11031, 5069, 54.35)
    ]
    worst = measures.worst_reconciliation(recon).first()
    assert (worst.data_holder, worst.feed_type, worst.avg_gap_pct) == (
        "Bendigo Bank",
        "accounts",
        63.42,
    )


def test_consent_trend(spark):
    kinds = dict.fromkeys(
        ["total_consents", "active_count", "revoked_count", "expired_count"], "bigint"
    )
    summary = published(spark, "agg_consent_summary", kinds | {"consent_date": "date"})
    assert summary.count() == 263
    assert only(summary.agg(F.sum("total_consents"))) == 271
    trend = measures.consent_trend(summary).filter("consent_month >= DATE '2026-01-01'")
    wide = trend.groupBy("consent_month").pivot("status", ["active", "revoked", "expired"])
    assert [row[1:] for row in values(wide.sum("consent_count"))] == [
        (7, 8, 2),
        (11, 2, 0),
        (7, 1, 0),
        (1, 1, 0),
    ]
