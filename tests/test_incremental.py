"""KPI tables kept by day against tables built from all rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from feedward.functions import day_of
from feedward.plans.incremental import KEPT, PERIOD, update
from feedward.sources.files import list_paths
from helpers import values

DATA = "/root/testdata/sf0.001"
DAY_OF = {
    "agg_feed_health": "run_at",
    "agg_reconciliation": "run_at",
    "agg_consent_summary": "created_at",
    "agg_transaction_volumes": "transaction_date",
}


def clean_rows(tables, name):
    if name == "agg_transaction_volumes":
        kinds = tables["clean_accounts"].select("account_id", "account_type", "data_holder")
        return tables["clean_transactions"].join(kinds, "account_id")
    return tables["clean_consents" if name == "agg_consent_summary" else "clean_feed_logs"]


@pytest.mark.parametrize("name", KEPT)
def test_updates_with_late_rows_equal_a_full_build(spark, tmp_path, name):
    tables = driver._layers(spark, DATA)
    rows = clean_rows(tables, name)
    rows = rows.withColumn(DAY_OF[name], F.when(F.xxhash64(*rows.columns) % 50 != 0, F.col(DAY_OF[name])))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    # Most of the first half of days, then all later days with late rows of earlier ones.
    middle = rows.select(F.percentile_approx(F.col(DAY_OF[name]).cast("timestamp"), 0.5)).first()[0]
    early = (F.col(DAY_OF[name]).cast("timestamp") < F.lit(middle)) & (F.xxhash64(*rows.columns) % 7 != 0)
    early = F.coalesce(early, F.xxhash64(*rows.columns) % 2 == 0)
    first = update(name, rows.filter(early), f"{tmp_path}/kept")
    assert first.count() > 0
    whole = update(name, rows.filter(~early), f"{tmp_path}/kept")
    kept = KEPT[name]
    expected = kept.table(kept.states(rows))
    assert whole.columns == expected.columns and values(whole) == values(expected)
    if name == "agg_feed_health":
        from feedward.operators.kpi import feed_health

        assert values(whole) == values(feed_health(rows))


def test_an_update_touches_the_days_of_its_rows_alone(spark, tmp_path):
    logs = driver._layers(spark, DATA)["clean_feed_logs"]
    update("agg_feed_health", logs, f"{tmp_path}/kept")
    pattern = f"{tmp_path}/kept/states/{PERIOD}=*/part-*"
    before = set(list_paths(spark, pattern))
    day = logs.select(day_of(F.col("run_at")).alias("d")).filter("d IS NOT NULL").first().d
    late = logs.filter(day_of(F.col("run_at")) == F.lit(day)).limit(3)
    update("agg_feed_health", late, f"{tmp_path}/kept")
    changed = {path.split(f"{PERIOD}=")[1].split("/")[0] for path in set(list_paths(spark, pattern)) ^ before}
    assert changed == {str(day)}
