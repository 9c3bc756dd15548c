"""Raw -> clean -> KPI -> audit as a job that writes every layer."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from feedward.operators.clean import RUN_DAY, with_run_day
from feedward.plans.audit import audit_log
from feedward.plans.tables import Layers
from feedward.session import chained_jobs, sized_shuffles, slices_for, text_bytes, together
from feedward.sources.catalog import assert_tables, assert_total_rows
from feedward.sources.readers import POSITION_COLUMNS, load_raw_dir
from feedward.sources.schemas import RAW_SCHEMAS, RAW_TABLES
from feedward.sources.writers import export_csv, rebuild, write_audit


# The tables in the order of the job. Those of a step need none of each other, so they are written at the same time.
STEPS = (
    RAW_TABLES,
    ("clean_customers", "clean_feed_logs"),
    ("clean_accounts", "clean_consents", "agg_feed_health", "agg_reconciliation"),
    ("clean_transactions", "agg_consent_summary"),
    ("agg_transaction_volumes",),
)


def run_job(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    as_of: datetime,
    run_at: datetime,
    dedup: str = "first",
    *,
    expected_rows: int | None = None,
    multi_line: Collection[str] = (),
    feeds_as_of: datetime | None = None,
) -> dict[str, DataFrame]:
    """Load the raw CSV directory and rebuild every layer under ``out_dir``.

    Each table is written as Parquet before the next one reads it, so nothing is computed
    twice and no plan grows long. ``out_dir`` must be storage that all
    executors see. "First" transaction means first in the raw file. The job
    stops if the raw tables don't have ``expected_rows`` in total; tables named
    in ``multi_line`` may have line breaks inside quotes. ``feeds_as_of`` gives
    feed freshness a reference time of its own.
    """
    loaded = load_raw_dir(spark, raw_dir, RAW_SCHEMAS, positions=True, multi_line=multi_line)
    assert_tables(loaded, RAW_TABLES)
    if expected_rows is not None:
        assert_total_rows(loaded, expected_rows)
    held = sum(text_bytes(table) for table in loaded.values())
    with sized_shuffles(spark, held), chained_jobs(spark):
        return _build(spark, loaded, out_dir, as_of, run_at, dedup, feeds_as_of)


def _build(
    spark: SparkSession,
    loaded: dict[str, DataFrame],
    out_dir: str,
    as_of: datetime,
    run_at: datetime,
    dedup: str,
    feeds_as_of: datetime | None,
) -> dict[str, DataFrame]:
    for name in loaded.keys() - {"raw_transactions"}:
        loaded[name] = loaded[name].drop(*POSITION_COLUMNS)
    raw = {name: partial(loaded.get, name) for name in loaded}
    tables = Layers(raw, as_of.date(), POSITION_COLUMNS, dedup, stored=True)

    def write(name: str, table: DataFrame) -> DataFrame:
        layer, by, others = name.split("_", 1)[0], [], []
        if name == "clean_feed_logs":  # so that checks and KPI tables of some days read those alone
            table, by = with_run_day(table), [RUN_DAY]
        elif name == "clean_transactions":  # whole rows are shuffled
            rows, parents = (tables[part].count() for part in ("raw_transactions", "clean_accounts"))
            table, *others = tables.in_slices(name, slices_for(spark, rows, parents))
        written = rebuild(spark, table, f"{out_dir}/{layer}/{name}", by, others)
        if layer == "agg":
            export_csv(written, f"{out_dir}/export/{name}.csv")
        return written

    for names in STEPS:
        for name, written in together(write, {name: (name, tables[name]) for name in names}).items():
            tables.replace(name, written)
    log = audit_log(tables, as_of, run_at, feeds_as_of)
    audit = rebuild(spark, log, f"{out_dir}/audit/audit_log")
    write_audit(audit, f"{out_dir}/export/audit_log.csv", f"{out_dir}/audit/history")
    return dict(tables) | {"audit_log": audit}
