"""The raw feed tables, derived from a star schema of orders, lines and events.

Each mapping is a list of projections over one source table; every source row
becomes one raw row. The select texts are plain SQL that Spark and other
engines read alike, so a test can run the same mapping elsewhere.

Faults are seeded by key so that each check has something to find: customers
filed under another id, missing balances and customer ids, unknown statuses,
non-positive, sub-cent, huge and tiny amounts, repeated transaction ids, missing latencies, empty and
over-delivered feeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DAY_30, _DAY_90, _DAY_180, _DAY_365 = (f"INTERVAL '{days}' DAY" for days in (30, 90, 180, 365))

_CONSENT_STATUS = (
    "CASE WHEN o_orderkey % 97 = 0 THEN 'unknown' WHEN o_orderkey % 89 = 0 THEN NULL"
    " WHEN o_orderstatus = 'F' THEN 'active' WHEN o_orderstatus = 'O' THEN 'revoked'"
    " ELSE 'expired' END"
)

# raw table -> (source table, projections applied one after the other)
MAPPINGS: dict[str, tuple[str, list[list[str]]]] = {
    "raw_customers": (
        "customer",
        [
            [
                "CASE WHEN c_custkey % 50 = 7 THEN -c_custkey ELSE c_custkey END AS customer_id",
                "c_name AS full_name",
                "'u' || CAST(c_custkey AS STRING) || '@example.com' AS email",
                "'04' || CAST(10000000 + c_custkey AS STRING) AS phone",
                "c_mktsegment AS state",
                "DATE '1995-01-01' AS created_at",
            ]
        ],
    ),
    "raw_accounts": (
        "orders",
        [
            [
                "o_orderkey AS account_id",
                "o_custkey AS customer_id",
                "o_orderpriority AS data_holder",
                "CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'savings' WHEN 1 THEN 'transaction'"
                " WHEN 2 THEN 'term_deposit' WHEN 3 THEN 'mortgage' ELSE 'credit_card' END"
                " AS account_type",
                "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_totalprice END AS balance_aud",
                "'AUD' AS currency",
                "CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open'"
                " ELSE 'suspended' END AS status",
                "o_orderdate AS open_date",
                "o_orderdate AS last_updated",
            ]
        ],
    ),
    "raw_consents": (
        "orders",
        [
            [
                "o_orderkey AS consent_id",
                "CASE WHEN o_orderkey % 25 = 0 THEN NULL ELSE o_custkey END AS customer_id",
                "o_orderpriority AS data_holder",
                f"{_CONSENT_STATUS} AS status",
                "'bank:accounts.basic:read|bank:transactions:read' AS scopes",
                "o_orderdate AS created_at",
                "CAST(o_orderkey % 3 AS INT) AS term",
            ],
            [
                "consent_id",
                "customer_id",
                "data_holder",
                "status",
                "scopes",
                "created_at",
                f"CASE term WHEN 0 THEN created_at + {_DAY_90} WHEN 1 THEN created_at + {_DAY_180}"
                f" ELSE created_at + {_DAY_365} END AS expires_at",
                f"CASE WHEN status = 'revoked' THEN created_at + {_DAY_30} ELSE NULL END"
                " AS revoked_at",
                "CAST(CASE term WHEN 0 THEN 90 WHEN 1 THEN 180 ELSE 365 END AS INT)"
                " AS sharing_duration_days",
            ],
        ],
    ),
    "raw_transactions": (
        "lineitem",
        [
            [
                "l_orderkey * 10 + l_linenumber AS transaction_id",
                "l_orderkey AS account_id",
                "CASE WHEN l_linestatus = 'F' THEN 'debit' ELSE 'credit' END AS transaction_type",
                "CAST(CASE WHEN (l_partkey + l_suppkey) % 40 = 0 THEN -l_extendedprice"
                " WHEN l_partkey % 41 = 0 THEN 0.004 WHEN l_partkey % 43 = 0 THEN 1.005"
                " WHEN l_partkey % 997 = 13 THEN 1e19 WHEN l_partkey % 499 = 17 THEN 1e-11"
                " ELSE l_extendedprice END AS DOUBLE) AS amount_aud",
                "'AUD' AS currency",
                "l_returnflag AS merchant_name",
                "l_shipdate AS transaction_date",
                "l_shipdate AS posted_date",
                "'part ' || CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 17 = 0"
                " THEN ', \"second' || chr(10) || 'line\"' ELSE '' END AS description",
                "CASE l_returnflag WHEN 'A' THEN 'pending' WHEN 'R' THEN 'failed'"
                " ELSE 'settled' END AS status",
                "l_partkey AS seq_1",
                "l_suppkey AS seq_2",
            ]
        ],
    ),
    "raw_feed_logs": (
        "events",
        [
            [
                "event_id AS feed_log_id",
                "'H' || CAST(user_id % 7 AS STRING) AS data_holder",
                "CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'accounts' WHEN 1 THEN 'transactions'"
                " ELSE 'consents' END AS feed_type",
                "ts AS run_at",
                "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial'"
                " ELSE 'success' END AS status",
                "CAST(CASE WHEN event_id % 211 = 0 THEN 0"
                " ELSE 100 + (event_id * 37) % 1901 END AS BIGINT) AS records_expected",
            ],
            [
                "feed_log_id",
                "data_holder",
                "feed_type",
                "run_at",
                "status",
                "records_expected",
                "CAST(CASE WHEN feed_log_id % 307 = 5 THEN records_expected + 25"
                " WHEN status = 'success' THEN records_expected"
                " ELSE (records_expected * (feed_log_id % 101)"
                " - (records_expected * (feed_log_id % 101)) % 100) / 100 END AS BIGINT)"
                " AS records_received",
                "CASE WHEN status = 'failed' OR (status = 'partial' AND feed_log_id % 16 = 0)"
                " THEN NULL ELSE CAST(120 + (feed_log_id * 53) % 7881 AS BIGINT) END"
                " AS latency_ms",
                "CASE WHEN status = 'failed' THEN 'TIMEOUT' ELSE NULL END AS error_code",
                "'v1.' || CAST(feed_log_id % 10 AS STRING) || '.0' AS ingestion_version",
            ],
        ],
    ),
}

# A total order within each transaction id: what "first" means for this source.
TRANSACTION_ORDER = ("transaction_date", "seq_1", "seq_2")


def mapped_raw(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One raw table over ``<directory>/<source>.parquet``."""
    source, projections = MAPPINGS[name]
    df = spark.read.parquet(f"{directory}/{source}.parquet")
    for projection in projections:
        df = df.selectExpr(*projection)
    return df


def mapping_sql(name: str) -> str:
    """The same mapping as one SQL query over a table named like the source."""
    query, projections = MAPPINGS[name]
    for depth, projection in enumerate(projections):
        inner = query if depth == 0 else f"({query}) AS step_{depth}"
        query = f"SELECT {', '.join(projection)} FROM {inner}"
    return query
