import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedward.operators import clean, kpi, measures
from helpers import raw, stamp, values
from test_clean import accounts


def logs(spark, *rows, **defaults):
    defaults = {
        "feed_log_id": "F",
        "data_holder": "H1",
        "feed_type": "accounts",
        "run_at": stamp("2026-04-01T10:00:00"),
        "records_expected": 100,
        "records_received": 100,
    } | defaults
    return clean.clean_feed_logs(raw(spark, "feed_logs", *rows, **defaults))


def test_feed_health_ignores_missing_latency(spark):
    df = kpi.feed_health(
        logs(
            spark,
            {"status": "success", "latency_ms": 100},
            {"status": "success", "latency_ms": 201},
            {"status": "partial", "latency_ms": 0},
            {"status": "failed"},
            {"status": "failed", "data_holder": "H2"},
        )
    )
    day = date(2026, 4, 1)
    assert values(df) == [
        ("H1", "accounts", day, 4, 2, 1, 1, 50.0, 151.0, 201.0, 400, 400),
        ("H2", "accounts", day, 1, 0, 1, 0, 0.0, None, None, 100, 100),
    ]


def test_feed_health_groups_by_day(spark):
    df = kpi.feed_health(
        logs(
            spark,
            {"run_at": stamp("2026-04-01T23:59:59.9")},
            {"run_at": stamp("2026-04-02T00:00:00")},
            {"run_at": None},
            status="success",
        )
    )
    assert values(df, "feed_date", "total_runs") == [
        (None, 1),
        (date(2026, 4, 1), 1),
        (date(2026, 4, 2), 1),
    ]


def test_reconciliation_covers_incomplete_runs_only(spark):
    df = kpi.reconciliation(
        logs(
            spark,
            {"status": "partial", "records_received": 95, "data_holder": "exact"},
            {"status": "partial", "records_received": 94, "data_holder": "short"},
            {"status": "failed", "records_expected": 0, "records_received": 0,
             "data_holder": "none"},
            {"status": "partial", "records_received": 120, "data_holder": "over"},
            {"status": "success", "records_received": 1, "data_holder": "success"},
            {"status": "failed", "records_received": 0, "data_holder": "mixed"},
            {"status": "partial", "records_received": 100, "data_holder": "mixed"},
            {"status": "success", "records_received": 100, "data_holder": "mixed"},
        )
    )
    assert values(
        df, "data_holder", "total_expected", "total_gap", "gap_pct", "reconciliation_status"
    ) == [
        ("exact", 100, 5, 5.0, "OK"),
        ("mixed", 200, 100, 50.0, "BREACH"),
        ("none", 0, 0, None, "OK"),
        ("over", 100, -20, -20.0, "OK"),
        ("short", 100, 6, 6.0, "BREACH"),
    ]


def test_label_uses_the_unrounded_ratio(spark):
    df = kpi.reconciliation(
        logs(
            spark,
            {"status": "partial", "records_expected": 100_000, "records_received": 94_999},
        )
    )
    assert values(df, "gap_pct", "reconciliation_status") == [(5.0, "BREACH")]


def consents(spark):
    df = raw(
        spark,
        "consents",
        {"status": "active", "sharing_duration_days": 90},
        {"status": "active", "sharing_duration_days": 365},
        {"status": "revoked"},
        {"status": "expired", "created_at": stamp("2026-02-11T00:00:00")},
        consent_id="K",
        customer_id="C1",
        data_holder="H1",
        created_at=stamp("2026-01-31T12:00:00"),
    )
    parents = clean.clean_customers(raw(spark, "customers", {"customer_id": "C1"}))
    return clean.clean_consents(df, parents)


def test_consent_summary_and_trend(spark):
    summary = kpi.consent_summary(consents(spark))
    assert values(summary) == [
        ("H1", date(2026, 1, 31), 3, 2, 1, 0, 66.7, 228.0),
        ("H1", date(2026, 2, 11), 1, 0, 0, 1, 0.0, None),
    ]
    january, february = date(2026, 1, 1), date(2026, 2, 1)
    assert values(measures.consent_trend(summary)) == [
        (january, "active", 2),
        (january, "expired", 0),
        (january, "revoked", 1),
        (february, "active", 0),
        (february, "expired", 1),
        (february, "revoked", 0),
    ]


def test_transaction_volumes(spark):
    parents = accounts(spark, "A1", "A2").fillna({"account_type": "savings", "data_holder": "H"})
    rows = [("A1", "0.10", "debit"), ("A1", "0.15", "debit"), ("A2", "5", "credit")]
    df = raw(
        spark,
        "transactions",
        *[
            {"transaction_id": f"T{i}", "account_id": a, "amount_aud": m, "transaction_type": t}
            for i, (a, m, t) in enumerate(rows)
        ],
        transaction_date=stamp("2026-03-01T08:00:00"),
    )
    cleaned = clean.clean_transactions(df, parents)
    volumes = kpi.transaction_volumes(cleaned, parents)
    day = date(2026, 3, 1)
    assert values(volumes) == [
        ("savings", "H", day, "credit", 1, 5.0, 5.0),
        ("savings", "H", day, "debit", 2, 0.25, 0.13),
    ]
    assert values(measures.volume_trend(volumes)) == [("savings", day, 3, 5.25)]


@pytest.fixture
def health(spark):
    return kpi.feed_health(
        logs(
            spark,
            {"data_holder": "H1", "status": "success", "latency_ms": 100},
            {"data_holder": "H1", "status": "partial", "latency_ms": 400,
             "run_at": stamp("2026-04-02T10:00:00"), "records_received": 10},
            {"data_holder": "H1", "status": "failed",
             "run_at": stamp("2026-04-02T11:00:00"), "records_received": 0},
            {"data_holder": "H2", "status": "success", "latency_ms": 50},
            {"data_holder": None, "status": "success"},
        )
    )


def test_holder_measures(spark, health):
    assert values(measures.holder_reliability(health)) == [
        (None, 1, 100.0, 100.0),
        ("H1", 3, 50.0, 33.3),
        ("H2", 1, 100.0, 100.0),
    ]
    assert values(measures.status_mix(health)) == [
        (None, 1, 0, 0, 0.0),
        ("H1", 1, 1, 1, 33.3),
        ("H2", 1, 0, 0, 0.0),
    ]


def test_holder_latency_keeps_holders_without_any(spark, health):
    runs = logs(
        spark,
        {"data_holder": "H1", "latency_ms": 100},
        {"data_holder": "H1", "latency_ms": 100},
        {"data_holder": "H1", "latency_ms": 400},
        {"data_holder": None},
        status="success",
    )
    assert values(measures.holder_latency(health, runs)) == [
        (None, None, None),
        ("H1", 250.0, 200.0),
        ("H2", 50.0, None),
    ]


def test_breach_measures(spark, health):
    recon = kpi.reconciliation(
        logs(
            spark,
            {"data_holder": "B", "records_received": 50},
            {"data_holder": "A", "records_received": 50},
            {"data_holder": "A", "records_received": 0, "feed_type": "consents"},
            {"data_holder": "C"},
            status="partial",
        )
    )
    assert values(measures.breach_share(recon, health)) == [(3, 4, 5, 75.0, 60.0)]
    worst = measures.worst_reconciliation(recon, 2).collect()
    assert [(row.data_holder, row.feed_type, row.avg_gap_pct) for row in worst] == [
        ("A", "consents", 100.0),
        ("A", "accounts", 50.0),
    ]


def test_breach_share_without_any_group(spark, health):
    recon = kpi.reconciliation(logs(spark, status="success"))
    assert values(measures.breach_share(recon, health)) == [(0, 0, 5, None, 0.0)]


def test_extremes_break_ties_by_name_and_skip_missing(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("d", 9.0), ("c", 9.0), ("z", None)], "who string, score double"
    )
    assert values(measures.extremes(df, "who", "score")) == [
        ("score", "highest", "c", 9.0),
        ("score", "lowest", "a", 1.0),
    ]
    assert measures.extremes(df.filter("score > 10"), "who", "score").count() == 0


def test_kpi_cards(spark):
    runs = logs(spark, {"latency_ms": 100}, {"latency_ms": 201}, {}, status="success")
    cards = measures.kpi_cards(measures.feed_grains(runs), kpi.consent_summary(consents(spark)))
    assert values(cards) == [
        ("active_consents", 2.0),
        ("avg_latency_ms", 151.0),
        ("breach_groups", 0.0),
        ("success_rate_pct", 100.0),
    ]


def test_amounts_are_judged_and_summed_unrounded(spark):
    from feedward.operators.clean import valid_transactions
    from feedward.plans.audit import row_conditions
    from feedward.operators.checks import count_each
    from feedward.operators.kpi import transaction_volumes
    from helpers import only, raw, stamp, values

    day = stamp("2024-01-05 10:00:00")
    rows = [
        {"transaction_id": str(i), "account_id": "A", "amount_aud": amount, "transaction_date": day}
        for i, amount in enumerate([0.004, 1.005, 1.005, 1e17, 1e19, -1, 0, None, 1e-11, math.nan])
    ]
    table = raw(spark, "transactions", *rows)
    valid = valid_transactions(table, ["transaction_date"])
    kept = values(valid, "transaction_id", "amount_aud")
    assert kept == [("0", 0.004), ("1", 1.005), ("2", 1.005), ("3", 1e17), ("4", 1e19), ("8", 1e-11)]
    condition = row_conditions(day)["raw_transactions"]
    assert only(count_each(table, condition)) == 2
    accounts = raw(spark, "accounts", {"account_id": "A"}, {"account_id": "A"})
    small = valid.filter("transaction_id IN ('1', '2')")
    volumes = ("txn_count", "total_amount_aud")
    assert values(transaction_volumes(small, accounts), *volumes) == [(4, 4.02)]
    assert values(transaction_volumes(small, accounts, matched=False), *volumes) == [(8, 8.04)]


def test_cards_of_empty_tables_are_zero(spark):
    from feedward.operators import measures
    from feedward.operators.clean import clean_feed_logs, valid_consents
    from feedward.operators.kpi import consent_summary
    from helpers import raw, values

    logs = clean_feed_logs(raw(spark, "feed_logs"))
    grains = measures.feed_grains(logs)
    found = dict(values(measures.kpi_cards(grains, consent_summary(valid_consents(raw(spark, "consents"))))))
    assert found["active_consents"] == 0.0 and found["breach_groups"] == 0.0
    assert grains.count() == 0


@pytest.mark.parametrize("customers, copies", [(1, 4000), (4000, 1), (2, 3_000_000)])
def test_volumes_of_an_account_that_repeats_often(spark, customers, copies):
    from pyspark.sql import functions as F

    from feedward.operators.clean import valid_transactions
    from feedward.operators.joins import having_parent

    day = stamp("2024-01-05 10:00:00")
    rows = [
        {"transaction_id": str(i), "account_id": "A", "amount_aud": amount, "transaction_date": day}
        for i, amount in enumerate([0.01, 1234.56, 2.5])
    ]
    valid = valid_transactions(raw(spark, "transactions", *rows), ["transaction_date"])
    one = raw(spark, "accounts", {"account_id": "A", "customer_id": "C"})
    repeated = one.crossJoin(spark.range(copies).select()).select(*one.columns)
    parents = having_parent(repeated, spark.range(customers).select(F.lit("C").alias("customer_id")), "customer_id")
    times = (customers * copies) ** 2
    volumes = kpi.transaction_volumes(valid, parents, matched=False)
    found = values(volumes, "txn_count", "total_amount_aud", "avg_amount_aud")
    assert found == [(3 * times, float(round(123707 * times / 100, 2)), 412.36)]
    assert values(measures.volume_trend(volumes), "txn_count") == [(3 * times,)]


def test_sums_of_any_size_do_not_depend_on_partitions(spark):
    import random
    from fractions import Fraction

    from feedward.operators import sums

    rng = random.Random(3)
    kinds = [
        lambda: rng.choice([0.1, 1234.56, -0.004, 99999999999.99]),
        lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300),
        lambda: rng.choice([1e19, -1e19, 1e-11, 5e-324, 1.7e308, -1.7e308, 2.0**60, 2.0**-1070, 1 / 3]),
    ]
    rows = [(k, kinds[k]() if rng.random() > 0.05 else None) for k in (0, 1, 2) for _ in range(300)]
    rows += [(3, None), (4, 1e19), (4, 1e-11), (4, -1e19), (5, math.inf), (5, 1.0), (6, 1e15), (6, 0.25), (7, -0.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    found = set()
    for parts in (1, 3, 16):
        split = sums.split(df.repartition(parts, "v"), F.col("v"))
        total = sums.by_bin(split, ["k"]).groupBy("k").agg(sums.total().alias("t"))
        found.add(tuple(values(total)))
    (totals,) = found
    totals = dict(totals)
    assert totals[3] is None and totals[4] == 1e-11 and totals[5] == math.inf and totals[6] == 1e15 + 0.25 and totals[7] == 0
    assert totals[0] == float(sum(Fraction(str(v)) for k, v in rows if k == 0 and v is not None))
    exact = float(sum(Fraction(v) for k, v in rows if k == 1 and v is not None))
    assert totals[1] == pytest.approx(exact, rel=1e-15)


def test_huge_and_tiny_amounts_are_counted_and_kept_in_volumes(spark):
    day = stamp("2024-01-05 10:00:00")
    amounts = [1e19, 1e-11, 0.005, 7.25]
    rows = [
        {"transaction_id": str(i), "account_id": "A", "amount_aud": v, "transaction_date": day}
        for i, v in enumerate(amounts)
    ]
    found = clean.valid_transactions(raw(spark, "transactions", *rows), ["transaction_date"])
    one = raw(spark, "accounts", {"account_id": "A"})
    columns = ("txn_count", "total_amount_aud", "avg_amount_aud")
    assert values(kpi.transaction_volumes(found, one), *columns) == [(4, 1e19, 2.5e18)]
    small = found.filter("amount_aud < 1")  # a tie that the tiny amount decides
    assert values(kpi.transaction_volumes(small, one), *columns) == [(2, 0.01, 0.0)]


def test_no_total_is_rounded_before_the_last(spark):
    day = stamp("2024-01-05 10:00:00")
    rows = [
        {"transaction_id": str(i), "account_id": f"A{i}", "amount_aud": 0.0000004, "transaction_date": day}
        for i in range(25_000)
    ]
    found = clean.valid_transactions(raw(spark, "transactions", *rows), dedup="keep_all")
    many = raw(spark, "accounts", *({"account_id": f"A{i}", "account_type": "s"} for i in range(25_000)))
    assert values(kpi.transaction_volumes(found, many), "total_amount_aud") == [(0.01,)]
