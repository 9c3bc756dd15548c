"""Queries over the shared test tables, each with SQL that another engine can check."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce
from importlib.util import find_spec
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedward.operators import measures
from feedward.operators.clean import (
    RUN_DAY,
    clean_feed_logs,
    clean_transactions,
    of_days,
    valid_transactions,
    with_run_day,
)
from feedward.operators.kpi import feed_health, transaction_volumes
from feedward.plans.audit import CHECK_NAMES, audit_log, audit_summary, run_checks
from feedward.plans.incremental import KEPT, update
from feedward.plans.layers import run_job
from feedward.plans.tables import Layers
from feedward.session import ship_package, shared_dir, together
from feedward.sources.catalog import (
    assert_tables,
    list_tables,
    register_views,
    table_rows,
    total_rows,
)
from feedward.sources.readers import load_raw_dir, read_raw
from feedward.sources.schemas import RAW_SCHEMAS, RAW_TABLES
from feedward.sources.star_mapping import MAPPINGS, TRANSACTION_ORDER, mapped_raw
from feedward.sources.writers import (
    export_csv,
    rebuild,
    write_audit,
    write_bucketed,
    write_table,
)
from oracle_sql import ORACLES

# The clock is a parameter. These times cut the test data somewhere in the middle.
AS_OF = datetime(2001, 1, 1)
FEEDS_AS_OF = datetime(2024, 1, 31, 23, 30)
RUN_AT = datetime(2024, 1, 31, 23, 30)
FEED_DAYS = (date(2024, 1, 10), date(2024, 1, 29))

CLEAN_TABLES = ("clean_customers", "clean_accounts", "clean_consents", "clean_feed_logs")

Query = Callable[[SparkSession, str], DataFrame]


def _layers(spark: SparkSession, sf_dir: str, **options) -> Layers:
    raw = {name: partial(mapped_raw, spark, sf_dir, name) for name in MAPPINGS}
    return Layers(raw, AS_OF.date(), TRANSACTION_ORDER, stored=True, **options)


def _on(build: Callable[[Layers], DataFrame], **options) -> Query:
    return lambda spark, sf_dir: build(_layers(spark, sf_dir, **options))


def _raw_only(tables: Layers) -> dict[str, DataFrame]:
    return {name: tables[name] for name in MAPPINGS}


def _check(*names: str) -> Query:
    return _on(lambda t: run_checks(t, AS_OF, names, FEEDS_AS_OF))


def _audit(tables: Layers) -> DataFrame:
    return audit_log(tables, AS_OF, RUN_AT, FEEDS_AS_OF)


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/feedward-{uuid4().hex}"


def _feed_health_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the raw feed logs as CSV, load that directory, aggregate what came back."""
    folder = _new_folder(spark)
    export_csv(_layers(spark, sf_dir)["raw_feed_logs"], f"{folder}/feed_logs.csv")
    loaded = load_raw_dir(spark, folder, RAW_SCHEMAS)
    return feed_health(clean_feed_logs(loaded["raw_feed_logs"]))


def _audit_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all raw tables as CSV, load that directory, audit what came back."""
    folder = _new_folder(spark)
    for name, table in _raw_only(_layers(spark, sf_dir)).items():
        export_csv(table, f"{folder}/{name.removeprefix('raw_')}.csv")
    loaded = load_raw_dir(spark, folder, RAW_SCHEMAS, multi_line=["transactions"])
    assert_tables(loaded, RAW_TABLES)
    raw = {name: partial(loaded.get, name) for name in loaded}
    return _audit(Layers(raw, AS_OF.date(), dedup="keep_all"))


def _job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all raw tables as packed CSV, run the whole job over that directory, return its audit log."""
    folder = _new_folder(spark)
    raw = _raw_only(_layers(spark, sf_dir)).items()
    export = partial(export_csv, packed=True)
    together(export, {n: (table, f"{folder}/raw/{n.removeprefix('raw_')}.csv") for n, table in raw})
    tables = run_job(
        spark, f"{folder}/raw", f"{folder}/out", AS_OF, RUN_AT, "keep_all",
        multi_line=["transactions"], feeds_as_of=FEEDS_AS_OF,
    )
    return tables["audit_log"]


def _exported_feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export a KPI table as CSV and read it back."""
    table, path = _layers(spark, sf_dir)["agg_feed_health"], f"{_new_folder(spark)}/health.csv"
    export_csv(table, path)
    return read_raw(spark, path, table.schema)


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a layer table twice, the second time over the first, and read it back."""
    table, path = _layers(spark, sf_dir)["agg_reconciliation"], f"{_new_folder(spark)}/table"
    rebuild(spark, table.limit(1), path)
    return rebuild(spark, table, path)


def _replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Put a table into the catalog, replace it by what is made of itself, and read it."""
    table, name = _layers(spark, sf_dir)["agg_consent_summary"], f"feedward_{uuid4().hex}"
    write_table(table.withColumn("spare", F.lit(1)), name)
    write_table(spark.table(name).drop("spare"), name)
    replaced = spark.table(name)
    spark.sql(f"DROP VIEW {name}")
    return replaced


def _audit_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the audit log as CSV and to a history by run; read both back and compare them."""
    folder = _new_folder(spark)
    log = rebuild(spark, _audit(_layers(spark, sf_dir)), f"{folder}/audit")
    for _ in range(2):  # a repeated run replaces its own rows
        write_audit(log, f"{folder}/log.csv", f"{folder}/history")
    exported = spark.read.csv(f"{folder}/log.csv", header=True, escape='"')
    history = spark.read.parquet(f"{folder}/history")
    kept = history.select("check_no", "check_name", "status", F.col("rows_affected").alias("rows_kept"))
    exported = exported.select("check_name", F.col("rows_affected").cast("bigint").alias("rows_exported"))
    return kept.join(exported, "check_name", "full_outer")


def _layer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register all layer tables, list them, and count the rows of each raw one by its name."""
    tables = _layers(spark, sf_dir)
    register_views(tables)
    assert_tables(set(list_tables(spark)) & set(tables), tables)
    found = [
        spark.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in list_tables(spark)
        if name in MAPPINGS
    ]
    for name in tables:
        spark.catalog.dropTempView(name)
    return reduce(DataFrame.unionByName, found)


def _rows_removed(tables: Layers) -> DataFrame:
    return measures.rows_removed(
        tables.row_count("raw_transactions"), tables.row_count("clean_transactions")
    )


def _best_worst(tables: Layers) -> DataFrame:
    holders = measures.of_grain(measures.feed_grains(tables["clean_feed_logs"]), "holder")
    return measures.extremes(
        holders, "data_holder", "success_rate_unweighted", "latency_ms_unweighted"
    )


def _kept(name: str) -> Query:
    """A KPI table kept by day: half of the rows, of all days, then the other half."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables, path = _layers(spark, sf_dir), f"{_new_folder(spark)}/kept"
        rows = tables["clean_feed_logs"]
        if name == "agg_consent_summary":
            rows = tables["clean_consents"]
        elif name == "agg_transaction_volumes":
            kinds = tables["clean_accounts"].select("account_id", "account_type", "data_holder")
            rows = tables["clean_transactions"].join(kinds, "account_id")
        late = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 1
        update(name, rows.filter(~late), path)
        return update(name, rows.filter(late), path)

    return query


def _logs_by_day(spark: SparkSession, sf_dir: str) -> Layers:
    """The layers with clean feed logs stored by day."""
    tables = _layers(spark, sf_dir)
    logs = with_run_day(tables["clean_feed_logs"])
    tables.replace("clean_feed_logs", rebuild(spark, logs, f"{_new_folder(spark)}/logs", [RUN_DAY]))
    return tables


def _health_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_health(of_days(_logs_by_day(spark, sf_dir)["clean_feed_logs"], *FEED_DAYS))


def _checks_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("reconciliation_breach", "stale_feed")
    return run_checks(_logs_by_day(spark, sf_dir), AS_OF, names, FEEDS_AS_OF, FEED_DAYS)


def _bucketed(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A query on transactions and clean accounts that are both stored in buckets of the account id."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables, folder = _layers(spark, sf_dir), _new_folder(spark)
        stored = []
        for name in ("raw_transactions", "clean_accounts"):
            table = f"feedward_{uuid4().hex}"
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            stored.append(write_bucketed(tables[name], table, f"{folder}/{name}", "account_id", buckets))
            spark.sql(f"DROP TABLE {table}")
        return build(*stored)

    return query


def feed_queries() -> dict[str, Query]:
    """Every operator of the feed monitoring as a query over the whole tables in a directory."""
    row_counts = [name for name in CHECK_NAMES if name.startswith("row_count_")]
    single = [name for name in CHECK_NAMES if name not in row_counts]
    return {
        "load_row_totals": _on(lambda t: total_rows(_raw_only(t))),
        "load_table_rows": _on(lambda t: table_rows(_raw_only(t))),
        **{name: _on(lambda t, name=name: t[name]) for name in CLEAN_TABLES},
        "clean_transactions": _on(lambda t: t["clean_transactions"]),
        "clean_transactions_keep_all": _on(lambda t: t["clean_transactions"], dedup="keep_all"),
        "transaction_volumes_keep_all": _on(
            lambda t: t["agg_transaction_volumes"], dedup="keep_all"
        ),
        "audit_log_keep_all": _on(_audit, dedup="keep_all"),
        "kpi_rows_removed_keep_all": _on(_rows_removed, dedup="keep_all"),
        "kpi_volume_trend_keep_all": _on(
            lambda t: measures.volume_trend(t["agg_transaction_volumes"]), dedup="keep_all"
        ),
        "clean_accounts_semi_join": _on(lambda t: t["clean_accounts"], unique_parents=True),
        "feed_health": _on(lambda t: t["agg_feed_health"]),
        "feed_health_from_csv": _feed_health_from_csv,
        "consent_summary": _on(lambda t: t["agg_consent_summary"]),
        "reconciliation": _on(lambda t: t["agg_reconciliation"]),
        "transaction_volumes": _on(lambda t: t["agg_transaction_volumes"]),
        **{f"check_{name}": _check(name) for name in single},
        "check_row_counts": _check(*row_counts),
        "audit_log": _on(_audit),
        "audit_log_from_csv": _audit_from_csv,
        "audit_export": _audit_export,
        "layer_tables": _layer_tables,
        "rebuilt_reconciliation": _rebuilt,
        "replaced_consent_summary": _replaced_table,
        "exported_feed_health": _exported_feed_health,
        "job_audit_log": _job_audit,
        **{f"kept_{name.removeprefix('agg_')}": _kept(name) for name in KEPT},
        "feed_health_of_days": _health_of_days,
        "checks_of_days": _checks_of_days,
        "bucketed_clean_transactions": _bucketed(
            lambda raw, accounts: clean_transactions(raw, accounts, dedup="keep_all")
        ),
        "bucketed_transaction_volumes": _bucketed(
            lambda raw, accounts: transaction_volumes(
                valid_transactions(raw, dedup="keep_all"), accounts, matched=False
            )
        ),
        "audit_summary": _on(lambda t: audit_summary(_audit(t))),
        "kpi_holder_reliability": _on(
            lambda t: measures.holder_reliability(t["agg_feed_health"])
        ),
        "kpi_breach_share": _on(
            lambda t: measures.breach_share(t["agg_reconciliation"], t["agg_feed_health"])
        ),
        "kpi_breach_rollup": _on(lambda t: measures.breach_rollup(t["agg_reconciliation"])),
        "kpi_worst_reconciliation": _on(
            lambda t: measures.worst_reconciliation(t["agg_reconciliation"], 3)
        ),
        "kpi_rows_removed": _on(_rows_removed),
        "kpi_holder_latency": _on(
            lambda t: measures.holder_latency(t["agg_feed_health"], t["clean_feed_logs"])
        ),
        "kpi_consent_trend": _on(lambda t: measures.consent_trend(t["agg_consent_summary"])),
        "kpi_status_mix": _on(lambda t: measures.status_mix(t["agg_feed_health"])),
        "kpi_volume_trend": _on(lambda t: measures.volume_trend(t["agg_transaction_volumes"])),
        "kpi_grains": _on(lambda t: measures.feed_grains(t["clean_feed_logs"])),
        "kpi_cards": _on(
            lambda t: measures.kpi_cards(
                measures.feed_grains(t["clean_feed_logs"]), t["agg_consent_summary"]
            )
        ),
        "kpi_best_worst": _on(_best_worst),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole audit log, which touches every raw and clean table."""
    return queries()["audit_log"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """The feed queries, and those of the corpus operators if that subpackage is there."""
    return feed_queries() | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    """Independent SQL over the same tables, for each query that SQL can express."""
    return ORACLES | _corpus()[1]


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the optional subpackage ``llm`` and of the pipeline built on it."""
    if find_spec("feedward.llm") is None:
        return {}, {}
    from feedward.llm.queries import QUERIES, SQL

    found, sql = dict(QUERIES), dict(SQL)
    if find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: _with_workers(query) for name, query in found.items()}, sql


def _with_workers(query: Query) -> Query:
    """A query whose Python workers need this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run
