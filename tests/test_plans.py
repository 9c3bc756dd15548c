"""What the plans must look like to hold at scale."""

import re
from contextlib import contextmanager
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from feedward.operators import checks, clean, kpi
from feedward.sources.schemas import RAW_SCHEMAS

DATA = Path("/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not DATA.exists(), reason="no test data")

# Sort-merge joins everywhere, as for tables beyond the broadcast limit, and
# thresholds low enough for small test tables to count as skewed.
LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
SKEWED = LARGE | {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", sorted(driver.feed_queries()))
def test_no_python_and_no_cross_join(spark, name):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert node not in text


def test_parent_side_of_a_join_reads_only_its_key(spark):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()["clean_accounts"](spark, str(DATA)))
    assert "ReadSchema: struct<c_custkey:bigint>" in text
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate,2001-01-02T00:00\)", text)
    assert "isnotnull(o_custkey" in text


def test_counting_rows_reads_no_columns(spark):
    text = plan(driver.feed_queries()["load_row_totals"](spark, str(DATA)))
    assert set(re.findall(r"ReadSchema: (struct<.*?>)", text)) == {"struct<>"}


def test_deduplication_limits_groups_before_the_shuffle(spark):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()["clean_transactions"](spark, str(DATA)))
    above, below = text.split("Exchange hashpartitioning(transaction_id")[:2]
    assert "row_number(), 1, Final" in above
    assert "row_number(), 1, Partial" in below


def test_orphan_check_is_one_combined_aggregation(spark):
    child = spark.range(100).withColumnRenamed("id", "k")
    with settings(spark, LARGE):
        text = plan(checks.referential_check(child, child, "k"))
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1
    partial = text.split("Exchange hashpartitioning")[1]
    assert "partial_sum" in partial


def hot_transactions(spark, rows=60_000):
    """A third of all rows sits on one account."""
    return spark.range(rows, numPartitions=8).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("account_id"),
        F.lit("debit").alias("transaction_type"),
        (F.abs(F.hash("id")) / 100 + 1).cast("decimal(18,2)").alias("amount_aud"),
        F.lit("AUD").alias("currency"),
        F.lit("Shop").alias("merchant_name"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("transaction_date"),
        F.lit("2026-01-01").cast("timestamp_ntz").alias("posted_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("description"),
        F.lit("settled").alias("status"),
    )


def all_accounts(spark):
    return spark.range(5000).select(
        F.col("id").alias("account_id"),
        F.lit("savings").alias("account_type"),
        F.lit("H").alias("data_holder"),
    )


def test_hot_account_is_split_over_tasks(spark):
    with settings(spark, SKEWED):
        df = clean.clean_transactions(hot_transactions(spark), all_accounts(spark), dedup="keep_all")
        assert len(df.collect()) == 60_000
        assert "skew=true" in plan(df)


def test_hot_account_is_split_although_the_next_join_reuses_the_key(spark):
    with settings(spark, SKEWED):
        accounts = all_accounts(spark)
        cleaned = clean.clean_transactions(hot_transactions(spark), accounts, ["description"])
        volumes = kpi.transaction_volumes(cleaned, accounts)
        assert [row.txn_count for row in volumes.collect()] == [60_000]
        # The transactions themselves; in the volumes a hot account is a few rows.
        assert plan(volumes).count("skew=true") >= 1


def test_hot_transaction_id_sends_one_row_per_task(spark):
    hot = hot_transactions(spark).withColumn("transaction_id", F.least("transaction_id", F.lit(1)))
    first = clean.clean_transactions(hot, all_accounts(spark), ["description"])
    assert first.count() == 2
    text = plan(first)
    assert "row_number(), 1, Partial" in text


def test_as_of_is_the_only_clock(spark):
    text = plan(
        clean.clean_accounts(
            spark.createDataFrame([], RAW_SCHEMAS["accounts"]),
            spark.createDataFrame([], RAW_SCHEMAS["customers"]),
            date(2026, 4, 20),
        )
    )
    assert "current" not in text


SCANS = {"lineitem": 2, "orders": 3, "customer": 3, "events": 2}


@needs_data
@pytest.mark.parametrize(
    "name", ["audit_log", "audit_log_keep_all", "audit_summary", "check_row_counts"]
)
def test_audit_shares_scans(spark, name):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
    for table, most in SCANS.items():
        assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet", text)) <= most


@needs_data
@pytest.mark.parametrize(
    "name, tables",
    [
        ("check_null_balance", {"orders": 1}),
        ("check_invalid_consent_status", {"orders": 1}),
        ("check_orphaned_accounts", {"orders": 1, "customer": 1}),
        ("check_duplicate_transaction_ids", {"lineitem": 1}),
        ("check_invalid_amount", {"lineitem": 1}),
        ("check_orphaned_transactions", {"lineitem": 1, "orders": 1, "customer": 1}),
        ("check_stale_feed", {"events": 1}),
        ("kpi_cards", {"events": 1, "orders": 1, "customer": 1}),
        ("kpi_best_worst", {"events": 1}),
        ("kpi_grains", {"events": 1}),
    ],
)
def test_a_query_scans_what_it_needs_once(spark, name, tables):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
    found = re.findall(r"FileScan parquet .*/(\w+)\.parquet", text)
    assert {table: found.count(table) for table in found} == tables


def test_rows_that_all_stay_are_not_fetched_by_their_place(spark, tmp_path):
    hot_transactions(spark).write.parquet(f"{tmp_path}/t")
    with settings(spark, SKEWED):
        df = clean.clean_transactions(spark.read.parquet(f"{tmp_path}/t"), all_accounts(spark), dedup="keep_all", stored=True)
        assert len(df.collect()) == 60_000
        text = plan(df)
    assert "_metadata" not in text and "ShuffledHashJoin(skew=true)" in text and text.count("Scan parquet") <= 2


@needs_data
@pytest.mark.parametrize("name", ["clean_transactions", "clean_transactions_keep_all"])
def test_whole_transactions_are_never_sorted(spark, name):
    with settings(spark, LARGE):
        df = driver.feed_queries()[name](spark, str(DATA))
        text = df._jdf.queryExecution().executedPlan().toString()
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    assert "ShuffledHashJoin" in text and "BuildRight" in text
    sorts = re.findall(r"\(\d+\) (?:Sort|WindowGroupLimit|Window)\b.*\nInput \[\d+\]: \[(.*)\]", formatted)
    assert sorts and not any("description" in columns or "l_partkey" in columns.replace("seq_1", "") for columns in sorts)


def test_located_rows_are_those_of_the_plain_way(spark, tmp_path):
    rows = hot_transactions(spark).withColumn("transaction_id", F.col("transaction_id") % 40_000)
    rows.repartition(5).write.parquet(f"{tmp_path}/t")
    raw = spark.read.parquet(f"{tmp_path}/t")
    twice = all_accounts(spark).filter("account_id < 4000").union(all_accounts(spark).filter("account_id < 9"))
    for options in ({"dedup": "keep_all"}, {"order_by": ["description"]}, {"order_by": ["description"], "unique_parent": True}):
        plain = clean.clean_transactions(raw, twice, **options)
        fetched = clean.clean_transactions(raw, twice, stored=True, **options)
        assert fetched.columns == plain.columns and fetched.count() == plain.count()
        assert fetched.exceptAll(plain).isEmpty() and plain.exceptAll(fetched).isEmpty()


@pytest.mark.parametrize("matched", [True, False])
def test_volumes_shuffle_transactions_once(spark, matched):
    with settings(spark, LARGE):
        text = plan(kpi.transaction_volumes(hot_transactions(spark), all_accounts(spark), matched=matched))
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert dealt and not any("account_id" in keys and "txn_date" in keys for keys in dealt)


def test_hot_account_is_split_in_the_volumes(spark):
    with settings(spark, SKEWED):
        volumes = kpi.transaction_volumes(hot_transactions(spark), all_accounts(spark))
        assert [row.txn_count for row in volumes.collect()] == [60_000]
        assert "skew=true" in plan(volumes)


@needs_data
def test_stored_logs_are_read_for_the_days_asked(spark):
    for name in ("feed_health_of_days", "checks_of_days"):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
        scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
        assert scans and all("run_day" in scan and "2024-01-10" in scan and "2024-01-29" in scan for scan in scans)


@needs_data
@pytest.mark.parametrize("name", ["bucketed_clean_transactions", "bucketed_transaction_volumes"])
def test_buckets_join_without_a_shuffle(spark, name):
    with settings(spark, LARGE):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2


BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b"}


@needs_data
@pytest.mark.parametrize("name", ["clean_accounts", "clean_transactions", "transaction_volumes"])
def test_children_of_a_large_scan_are_filtered_before_the_shuffle(spark, name):
    with settings(spark, LARGE | BLOOM):
        text = plan(driver.feed_queries()[name](spark, str(DATA)))
    assert "might_contain" in text


def test_hot_account_is_split_behind_a_bloom_filter(spark, tmp_path):
    hot_transactions(spark).write.parquet(f"{tmp_path}/t")
    all_accounts(spark).write.parquet(f"{tmp_path}/a")
    raw, accounts = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/a")
    with settings(spark, SKEWED | BLOOM):
        known = accounts.filter("account_id < 4000")
        df = clean.clean_transactions(raw, known, dedup="keep_all")
        assert df.count() == raw.filter("account_id < 4000").count()
        df.collect()
        text = plan(df)
    assert "might_contain" in text and "skew=true" in text
