"""SQL for another engine (DuckDB dialect) that answers each query on its own terms.

The raw mapping views are shared with the Spark side. Everything after them is
written separately, and in other ways where SQL offers one.
"""

from __future__ import annotations

import re

from feedward.sources.star_mapping import MAPPINGS, mapping_sql


def _rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def _pct(part: str, whole: str, places: int) -> str:
    return _rounded(f"CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100", places)


def _big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


# By way of text, which gives every double its shortest decimal and takes a decimal back to the nearest double.
_MONEY = "CAST(CAST(t.amount_aud AS VARCHAR) AS DECIMAL(38,12))"


def _nearest(decimal: str) -> str:
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"

VIEWS: dict[str, str] = {name: mapping_sql(name) for name in MAPPINGS}

VIEWS["clean_customers"] = """
    SELECT customer_id, full_name, email, phone, state, CAST(created_at AS DATE) AS created_at
    FROM raw_customers
    WHERE coalesce(CAST(customer_id AS VARCHAR), full_name, email, phone, state,
                   CAST(created_at AS VARCHAR)) IS NOT NULL"""

VIEWS["customer_copies"] = """
    SELECT customer_id, count(*) AS copies FROM clean_customers GROUP BY ALL"""

VIEWS["clean_accounts"] = """
    SELECT account_id, customer_id, data_holder, account_type,
           ifnull(CAST(balance_aud AS DOUBLE), 0.0) AS balance_aud, currency, status,
           CAST(open_date AS DATE) AS open_date,
           date_trunc('second', last_updated) AS last_updated,
           CAST(balance_aud IS NULL AS INTEGER) AS flag_null_balance
    FROM (SELECT *, unnest(range(copies)) FROM raw_accounts NATURAL JOIN customer_copies)
    WHERE account_id IS NOT NULL AND NOT CAST(open_date AS DATE) > DATE '2001-01-01'"""

VIEWS["clean_consents"] = """
    SELECT consent_id, customer_id, data_holder, status, scopes,
           date_trunc('second', created_at) AS created_at,
           date_trunc('second', expires_at) AS expires_at,
           date_trunc('second', revoked_at) AS revoked_at,
           CAST(sharing_duration_days AS INTEGER) AS sharing_duration_days
    FROM (SELECT *, unnest(range(copies)) FROM raw_consents NATURAL JOIN customer_copies)
    WHERE consent_id IS NOT NULL
      AND (status = 'active' OR status = 'revoked' OR status = 'expired')"""

VIEWS["account_copies"] = """
    SELECT account_id, count(*) AS copies FROM clean_accounts GROUP BY ALL"""

VIEWS["first_transactions"] = """
    SELECT * FROM raw_transactions WHERE transaction_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY transaction_id
                               ORDER BY transaction_date, seq_1, seq_2) = 1"""

_TRANSACTIONS = """
    SELECT transaction_id, account_id, transaction_type, amount_aud, currency, merchant_name,
           date_trunc('second', transaction_date) AS transaction_date,
           date_trunc('second', posted_date) AS posted_date, description, status
    FROM (SELECT *, unnest(range(copies)) FROM {rows} NATURAL JOIN account_copies)
    WHERE amount_aud > 0 AND transaction_id IS NOT NULL"""
VIEWS["clean_transactions"] = _TRANSACTIONS.format(rows="first_transactions")
VIEWS["clean_transactions_keep_all"] = _TRANSACTIONS.format(rows="raw_transactions")

VIEWS["clean_feed_logs"] = f"""
    SELECT feed_log_id, data_holder, feed_type, date_trunc('second', run_at) AS run_at, status,
           records_expected, records_received, ifnull(latency_ms, -1) AS latency_ms, error_code,
           ingestion_version,
           {_pct("records_expected - records_received", "records_expected", 2)} AS variance_pct
    FROM raw_feed_logs
    WHERE feed_log_id IS NOT NULL
      AND (status = 'success' OR status = 'failed' OR status = 'partial')"""

VIEWS["feed_health"] = f"""
    SELECT data_holder, feed_type, CAST(run_at AS DATE) AS feed_date, count(*) AS total_runs,
           count(*) FILTER (status = 'success') AS success_count,
           count(*) FILTER (status = 'failed') AS failed_count,
           count(*) FILTER (status = 'partial') AS partial_count,
           {_pct("count(*) FILTER (status = 'success')", "count(*)", 1)} AS success_rate_pct,
           {_rounded("avg(latency_ms) FILTER (latency_ms > 0)", 0)} AS avg_latency_ms,
           CAST(max(latency_ms) FILTER (latency_ms > 0) AS DOUBLE) AS max_latency_ms,
           {_big("sum(records_expected)")} AS total_records_expected,
           {_big("sum(records_received)")} AS total_records_received
    FROM clean_feed_logs GROUP BY ALL"""

VIEWS["feed_health_from_csv"] = "FROM feed_health"
VIEWS["clean_accounts_semi_join"] = """
    FROM (SELECT * REPLACE (CAST(open_date AS DATE) AS open_date,
                            date_trunc('second', last_updated) AS last_updated,
                            ifnull(balance_aud, 0.0) AS balance_aud),
                 CAST(balance_aud IS NULL AS INTEGER) AS flag_null_balance
          FROM raw_accounts) a
    WHERE EXISTS (FROM clean_customers c WHERE c.customer_id = a.customer_id)
      AND account_id IS NOT NULL AND open_date < DATE '2001-01-02'"""

VIEWS["consent_summary"] = f"""
    SELECT data_holder, CAST(created_at AS DATE) AS consent_date, count(*) AS total_consents,
           count(*) FILTER (status = 'active') AS active_count,
           count(*) FILTER (status = 'revoked') AS revoked_count,
           count(*) FILTER (status = 'expired') AS expired_count,
           {_pct("count(*) FILTER (status = 'active')", "count(*)", 1)} AS active_rate_pct,
           {_rounded("avg(sharing_duration_days)", 0)} AS avg_sharing_days
    FROM clean_consents GROUP BY ALL"""

VIEWS["incomplete_days"] = f"""
    SELECT data_holder, feed_type, CAST(run_at AS DATE) AS feed_date,
           {_big("sum(records_expected)")} AS total_expected,
           {_big("sum(records_received)")} AS total_received
    FROM clean_feed_logs WHERE status <> 'success' GROUP BY ALL"""

VIEWS["reconciliation"] = f"""
    SELECT *, total_expected - total_received AS total_gap,
           {_pct("total_expected - total_received", "total_expected", 2)} AS gap_pct,
           if(total_expected <> 0 AND (total_expected - total_received) / total_expected > 0.05,
              'BREACH', 'OK') AS reconciliation_status
    FROM incomplete_days"""

VIEWS["transaction_volumes"] = f"""
    SELECT a.account_type, a.data_holder, CAST(t.transaction_date AS DATE) AS txn_date,
           t.transaction_type, count(*) AS txn_count,
           {_nearest(f"round(sum({_MONEY}), 2)")} AS total_amount_aud,
           if({_nearest(f"sum({_MONEY})")} / count(*) < 1e17,
              {_rounded(f"least({_nearest(f'sum({_MONEY})')} / count(*), 1e17)", 2)},
              {_nearest(f"sum({_MONEY})")} / count(*)) AS avg_amount_aud
    FROM clean_accounts a, clean_transactions t WHERE a.account_id = t.account_id
    GROUP BY ALL"""

VIEWS["load_table_rows"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in MAPPINGS
)
VIEWS["load_row_totals"] = f"""
    SELECT {_big("sum(row_count)")} AS total_rows FROM load_table_rows"""


def _orphans(child: str, parent: str, key: str) -> str:
    return f"""
        SELECT count(*) AS n FROM {child} c
        WHERE c.{key} IS NOT NULL
          AND NOT EXISTS (FROM {parent} p WHERE p.{key} = c.{key})
          AND NOT EXISTS (FROM {parent} p WHERE p.{key} IS NULL)"""


# Tables, levels and note texts of the audit log.
# check -> (table, level, note, query giving n)
_COUNTED: dict[str, tuple[str, str, str, str]] = {
    "null_balance": (
        "raw_accounts",
        "FAIL",
        "accounts had null balance — replaced with 0.00 in clean layer",
        "SELECT count(*) - count(balance_aud) AS n FROM raw_accounts",
    ),
    "future_open_date": (
        "raw_accounts",
        "FAIL",
        "accounts had future open_date — excluded from clean layer",
        "SELECT count(*) AS n FROM raw_accounts WHERE open_date >= TIMESTAMP '2001-01-02'",
    ),
    "orphaned_accounts": (
        "raw_accounts",
        "FAIL",
        "accounts with no matching customer_id",
        _orphans("raw_accounts", "raw_customers", "customer_id"),
    ),
    "null_customer_id": (
        "raw_consents",
        "FAIL",
        "consents with no customer_id — compliance risk, excluded from clean layer",
        "SELECT count(*) - count(customer_id) AS n FROM raw_consents",
    ),
    "invalid_consent_status": (
        "raw_consents",
        "FAIL",
        "consents with unrecognised status value",
        """SELECT count(status) - count(*) FILTER (status = 'active' OR status = 'revoked'
                                                   OR status = 'expired') AS n
           FROM raw_consents""",
    ),
    "duplicate_transaction_ids": (
        "raw_transactions",
        "FAIL",
        "duplicate transaction_ids — deduplicated in clean layer",
        """SELECT count(*) AS n
           FROM (SELECT DISTINCT transaction_id FROM raw_transactions
                 QUALIFY count(*) OVER (PARTITION BY transaction_id) > 1)""",
    ),
    "invalid_amount": (
        "raw_transactions",
        "FAIL",
        "transactions with zero or negative amount — excluded",
        "SELECT count(*) AS n FROM raw_transactions WHERE NOT amount_aud > 0",
    ),
    "orphaned_transactions": (
        "raw_transactions",
        "FAIL",
        "transactions with no matching account_id — excluded",
        _orphans("raw_transactions", "clean_accounts", "account_id"),
    ),
    "reconciliation_breach": (
        "clean_feed_logs",
        "FAIL",
        "feeds where records received fell >5%% below expected",
        """SELECT count(*) AS n FROM clean_feed_logs
           WHERE records_expected <> 0
             AND (records_expected - records_received) * 20 > records_expected""",
    ),
    "stale_feed": (
        "clean_feed_logs",
        "WARN",
        "data holders have not sent a feed in the last 24 hours",
        """SELECT count(*) AS n
           FROM (SELECT DISTINCT data_holder FROM clean_feed_logs
                 QUALIFY max(run_at) OVER (PARTITION BY data_holder)
                         < TIMESTAMP '2024-01-30 23:30:00')""",
    ),
    "missing_latency": (
        "raw_feed_logs",
        "WARN",
        "non-failed feeds missing latency_ms — set to -1 sentinel in clean layer",
        """SELECT count(*) AS n FROM raw_feed_logs
           WHERE latency_ms IS NULL AND (status = 'success' OR status = 'partial')""",
    ),
}
_LAYERED = ("accounts", "transactions", "consents", "feed_logs")


def _counted_check(number: int, name: str) -> str:
    table, level, note, count = _COUNTED[name]
    return f"""
        SELECT CAST({number} AS INTEGER) AS check_no, '{name}' AS check_name, '{table}' AS "table",
               if(n = 0, 'PASS', '{level}') AS status, n AS rows_affected,
               printf('%d {note}', n) AS note
        FROM ({count})"""


def _layer_check(number: int, stem: str) -> str:
    return f"""
        SELECT CAST({number} AS INTEGER) AS check_no, 'row_count_clean_{stem}' AS check_name,
               'raw_{stem}→clean_{stem}' AS "table",
               if(ifnull(pct, 0) < 10, 'PASS', 'WARN') AS status, r - c AS rows_affected,
               printf('%d raw → %d clean (%d dropped, %.1f%%)', r, c, r - c, ifnull(pct, 0))
               AS note
        FROM (SELECT r, c, {_pct("r - c", "r", 1)} AS pct
              FROM (SELECT (SELECT count(*) FROM raw_{stem}) AS r,
                           (SELECT count(*) FROM clean_{stem}) AS c))"""


for _number, _name in enumerate(_COUNTED, start=1):
    VIEWS[f"check_{_name}"] = _counted_check(_number, _name)
VIEWS["check_row_counts"] = " UNION ALL ".join(
    _layer_check(len(_COUNTED) + i, stem) for i, stem in enumerate(_LAYERED, start=1)
)
VIEWS["audit_log"] = "SELECT '2024-01-31 23:30:00' AS run_at, * FROM ({})".format(
    " UNION ALL ".join(f"FROM check_{name}" for name in [*_COUNTED, "row_counts"])
)
VIEWS["audit_summary"] = """
    SELECT count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed,
           count(*) FILTER (status = 'FAIL') AS failed, count(*) FILTER (status = 'WARN') AS warned
    FROM audit_log"""

VIEWS["kpi_holder_reliability"] = f"""
    SELECT data_holder, {_big("sum(total_runs)")} AS total_runs,
           {_rounded("avg(success_rate_pct)", 1)} AS success_rate_unweighted,
           {_pct("sum(success_count)", "sum(total_runs)", 1)} AS success_rate_weighted
    FROM feed_health GROUP BY data_holder"""
VIEWS["kpi_breach_share"] = f"""
    SELECT b AS breach_groups, g AS recon_groups, r AS total_runs,
           {_pct("b", "g", 2)} AS share_of_groups_pct, {_pct("b", "r", 2)} AS share_of_runs_pct
    FROM (SELECT (SELECT count(*) FROM reconciliation
                  WHERE reconciliation_status = 'BREACH') AS b,
                 (SELECT count(*) FROM reconciliation) AS g,
                 (SELECT count(*) FROM clean_feed_logs) AS r)"""
VIEWS["kpi_breach_rollup"] = f"""
    SELECT data_holder, feed_type, count(*) AS breach_groups,
           {_big("sum(total_expected)")} AS total_expected,
           {_big("sum(total_received)")} AS total_received,
           {_big("sum(total_expected) - sum(total_received)")} AS total_gap,
           {_rounded("avg(gap_pct)", 2)} AS avg_gap_pct
    FROM reconciliation WHERE reconciliation_status = 'BREACH' GROUP BY ALL"""
VIEWS["kpi_worst_reconciliation"] = """
    FROM kpi_breach_rollup
    QUALIFY row_number() OVER (ORDER BY avg_gap_pct DESC, data_holder, feed_type) <= 3"""
VIEWS["kpi_rows_removed"] = f"""
    SELECT r AS raw_rows, c AS clean_rows, r - c AS rows_affected,
           {_pct("r - c", "r", 1)} AS dropped_pct
    FROM (SELECT (SELECT count(*) FROM raw_transactions) AS r,
                 (SELECT count(*) FROM clean_transactions) AS c)"""
VIEWS["kpi_holder_latency"] = f"""
    SELECT d.data_holder, d.latency_ms_unweighted, r.latency_ms_weighted
    FROM (SELECT data_holder, {_rounded("avg(avg_latency_ms)", 0)} AS latency_ms_unweighted
          FROM feed_health GROUP BY ALL) d
    JOIN (SELECT data_holder,
                 {_rounded("avg(latency_ms) FILTER (latency_ms > 0)", 0)} AS latency_ms_weighted
          FROM clean_feed_logs GROUP BY ALL) r USING (data_holder)"""
VIEWS["consent_months"] = """
    SELECT DISTINCT CAST(date_trunc('month', created_at) AS DATE) AS consent_month
    FROM clean_consents"""
VIEWS["kpi_consent_trend"] = """
    SELECT m.consent_month, s.status, count(c.consent_id) AS consent_count
    FROM consent_months m
    CROSS JOIN (VALUES ('active'), ('revoked'), ('expired')) AS s(status)
    LEFT JOIN clean_consents c
           ON date_trunc('month', c.created_at) = m.consent_month AND c.status = s.status
    GROUP BY ALL"""
VIEWS["kpi_status_mix"] = f"""
    SELECT data_holder, count(*) FILTER (status = 'success') AS success_runs,
           count(*) FILTER (status = 'partial') AS partial_runs,
           count(*) FILTER (status = 'failed') AS failed_runs,
           {_pct("count(*) FILTER (status = 'partial')", "count(*)", 1)} AS partial_share_pct
    FROM clean_feed_logs GROUP BY data_holder"""
VIEWS["kpi_volume_trend"] = f"""
    SELECT account_type, txn_date, {_big("sum(txn_count)")} AS txn_count,
           {_nearest("""sum(CASE WHEN total_amount_aud < 1e15
                    THEN CAST(CAST(total_amount_aud AS VARCHAR) AS DECIMAL(38,2))
                    ELSE CAST(CAST(total_amount_aud AS HUGEINT) AS DECIMAL(38,2)) END)""")} AS total_amount_aud
    FROM transaction_volumes GROUP BY ALL"""
VIEWS["kpi_cards"] = f"""
    SELECT 'success_rate_pct' AS card,
           {_pct("count(*) FILTER (status = 'success')", "count(*)", 1)} AS value
    FROM clean_feed_logs
    UNION ALL
    SELECT 'active_consents', CAST(count(*) AS DOUBLE)
    FROM clean_consents WHERE status = 'active'
    UNION ALL
    SELECT 'breach_groups', CAST(count(*) AS DOUBLE)
    FROM reconciliation WHERE reconciliation_status = 'BREACH'
    UNION ALL
    SELECT 'avg_latency_ms', {_rounded("avg(latency_ms)", 0)}
    FROM clean_feed_logs WHERE latency_ms > 0"""
VIEWS["kpi_best_worst"] = " UNION ALL ".join(
    f"""(SELECT '{measure}' AS measure, '{position}' AS position, data_holder, {measure} AS value
         FROM {table} WHERE {measure} IS NOT NULL
         ORDER BY {measure} {direction}, data_holder LIMIT 1)"""
    for measure, table in (
        ("success_rate_unweighted", "kpi_holder_reliability"),
        ("latency_ms_unweighted", "kpi_holder_latency"),
    )
    for position, direction in (("lowest", "ASC"), ("highest", "DESC"))
)

def _grain(grain: str, key: str | None) -> str:
    """All measures of one grain, each from the tables that define it."""

    def of(column: str) -> str:
        if key is None:
            return ""
        expression = "CAST(run_at AS DATE)" if column == "run_at" else column
        return f"WHERE {expression} IS NOT DISTINCT FROM g.{key}"

    by_run = of("run_at" if key == "feed_date" else key)
    by_day = of(key)
    keys = "(SELECT 1)" if key is None else (
        "(SELECT DISTINCT CAST(run_at AS DATE) AS feed_date FROM clean_feed_logs)"
        if key == "feed_date"
        else "(SELECT DISTINCT data_holder FROM clean_feed_logs)"
    )
    mean = _rounded("avg(latency_ms) FILTER (latency_ms > 0)", 0)
    return f"""
        SELECT {"g.data_holder" if key == "data_holder" else "NULL"} AS data_holder,
               {"g.feed_date" if key == "feed_date" else "CAST(NULL AS DATE)"} AS feed_date,
               '{grain}' AS grain, (SELECT count(*) FROM clean_feed_logs {by_run}) AS total_runs,
               (SELECT {_rounded("avg(success_rate_pct)", 1)} FROM feed_health {by_day})
               AS success_rate_unweighted,
               (SELECT {_pct("count(*) FILTER (status = 'success')", "count(*)", 1)}
                FROM clean_feed_logs {by_run}) AS success_rate_weighted,
               (SELECT {_pct("count(*) FILTER (status = 'partial')", "count(*)", 1)}
                FROM clean_feed_logs {by_run}) AS partial_share_pct,
               (SELECT {_rounded("avg(avg_latency_ms)", 0)} FROM feed_health {by_day})
               AS latency_ms_unweighted,
               (SELECT {mean} FROM clean_feed_logs {by_run}) AS latency_ms_weighted,
               (SELECT count(*) FROM reconciliation {by_day}) AS recon_groups,
               (SELECT count(*) FILTER (reconciliation_status = 'BREACH')
                FROM reconciliation {by_day}) AS breach_groups
        FROM {keys} g"""


VIEWS["kpi_grains"] = " UNION ALL ".join(
    [_grain("holder", "data_holder"), _grain("day", "feed_date"), _grain("all", None)]
)

# Views that only help others; every other view past the mappings answers a query.
_HELPERS = {
    "customer_copies",
    "account_copies",
    "first_transactions",
    "incomplete_days",
    "consent_months",
}


def _with_views(name: str) -> str:
    """The view's query preceded by every view it builds on."""
    needed: dict[str, str] = {}

    def visit(view: str) -> None:
        for word in re.findall(r"\b[a-z_]+\b", VIEWS[view]):
            if word in VIEWS and word != view and word not in needed:
                visit(word)
                needed[word] = VIEWS[word]

    visit(name)
    ctes = ",\n".join(f"{view} AS ({query})" for view, query in needed.items())
    return f"WITH {ctes}\n{VIEWS[name]}" if ctes else VIEWS[name]


ORACLES = {
    name: _with_views(name) for name in VIEWS if name not in MAPPINGS and name not in _HELPERS
}
# The same queries where every transaction with an id is kept.
for _name in ("transaction_volumes", "audit_log", "kpi_rows_removed", "kpi_volume_trend"):
    ORACLES[f"{_name}_keep_all"] = ORACLES[_name].replace(
        VIEWS["clean_transactions"], VIEWS["clean_transactions_keep_all"]
    )
ORACLES["audit_log_from_csv"] = ORACLES["audit_log_keep_all"]
ORACLES["audit_export"] = f"""
    SELECT check_no, check_name, status, rows_affected AS rows_kept, rows_affected AS rows_exported
    FROM ({ORACLES["audit_log"]})"""
ORACLES["layer_tables"] = ORACLES["load_table_rows"]
ORACLES["rebuilt_reconciliation"] = ORACLES["reconciliation"]
ORACLES["replaced_consent_summary"] = ORACLES["consent_summary"]
ORACLES["exported_feed_health"] = ORACLES["feed_health"]
ORACLES["job_audit_log"] = ORACLES["audit_log_keep_all"]
for _name in ("feed_health", "reconciliation", "consent_summary", "transaction_volumes"):
    ORACLES[f"kept_{_name}"] = ORACLES[_name]
ORACLES["feed_health_of_days"] = f"""
    FROM ({ORACLES["feed_health"]}) WHERE feed_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-29'"""
_days = "SELECT * FROM raw_feed_logs WHERE CAST(run_at AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-29'"
ORACLES["checks_of_days"] = " UNION ALL ".join(
    f"(FROM ({ORACLES[f'check_{_name}'].replace('FROM raw_feed_logs', f'FROM ({_days})')}))"
    for _name in ("reconciliation_breach", "stale_feed")
)
ORACLES["bucketed_clean_transactions"] = ORACLES["clean_transactions_keep_all"]
ORACLES["bucketed_transaction_volumes"] = ORACLES["transaction_volumes_keep_all"]
