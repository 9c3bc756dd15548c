import gzip
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedward import session
from feedward.plans.layers import run_job
from feedward.sources import catalog, writers
from feedward.sources.readers import NULL_TOKENS, POSITION_COLUMNS, load_raw_dir, read_raw
from feedward.sources.schemas import RAW_SCHEMAS, RAW_TABLES
from helpers import values

# The header lines here are the contract of the files.
ACCOUNTS = '''account_id,customer_id,data_holder,account_type,balance_aud,currency,status,open_date,last_updated
A1,C1,ANZ,savings,1234.56,AUD,open,2020-02-29,2024-03-02T01:02:03.456789
A2,C1,ANZ,savings,,AUD,open,2020-02-29,2024-03-02T01:02:03
A3,C1,"Bank, ""Big""",savings,12abc,AUD,open,2024-02-30,soon
A4,NULL,ANZ,savings,abc,AUD,open,2027-01-01,
'''


def test_read_raw_types_by_declared_schema(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    path.write_text(ACCOUNTS)
    df = read_raw(spark, str(path), RAW_SCHEMAS["accounts"])
    assert df.schema.simpleString() == RAW_SCHEMAS["accounts"].simpleString()
    assert values(df, "account_id", "customer_id", "balance_aud", "open_date", "last_updated") == [
        ("A1", "C1", 1234.56, date(2020, 2, 29), datetime(2024, 3, 2, 1, 2, 3, 456789)),
        ("A2", "C1", None, date(2020, 2, 29), datetime(2024, 3, 2, 1, 2, 3)),
        ("A3", "C1", 12.0, None, None),
        ("A4", None, 0.0, date(2027, 1, 1), None),
    ]
    assert df.filter("account_id = 'A3'").first().data_holder == 'Bank, "Big"'


def test_read_raw_matches_columns_by_name(spark, tmp_path):
    path = tmp_path / "feed_logs.csv"
    names = RAW_SCHEMAS["feed_logs"].names[::-1]
    row = {"feed_log_id": "F1", "records_expected": "12", "latency_ms": "4235.0"}
    path.write_text(
        ",".join([*names, "extra"]) + "\n" + ",".join(row.get(n, "") for n in names) + ",x\n"
    )
    df = read_raw(spark, str(path), RAW_SCHEMAS["feed_logs"])
    assert df.columns == RAW_SCHEMAS["feed_logs"].names
    assert values(df, "feed_log_id", "records_expected", "latency_ms") == [("F1", 12, 4235)]


def test_read_raw_null_tokens_and_money(spark, tmp_path):
    path = tmp_path / "t.csv"
    names = RAW_SCHEMAS["transactions"].names
    amounts = [*NULL_TOKENS, "12.30", "1e2", "x"]
    lines = [f'T{i},A1,debit,"{amount}",AUD,m,,,d,s' for i, amount in enumerate(amounts)]
    path.write_text("\n".join([",".join(names), *lines]) + "\n")
    df = read_raw(spark, str(path), RAW_SCHEMAS["transactions"])
    found = [row[0] for row in values(df.filter("amount_aud IS NOT NULL"), "amount_aud")]
    assert sorted(found) == [0.0, 12.3, 100.0]
    assert df.count() == len(amounts)


BROKEN = {
    "short": 'T1,A1\n',
    "long": f"T1{',x' * 10}\n",
    "quoted break": 'T1,A1,debit,1,AUD,m,,,"one\ntwo",s\n',
}


@pytest.mark.parametrize("record", BROKEN.values(), ids=BROKEN)
def test_a_broken_record_stops_every_job(spark, tmp_path, record):
    names = RAW_SCHEMAS["transactions"].names
    good = "T0,A1,debit,1,AUD,m,,,d,s\n"
    (tmp_path / "transactions.csv").write_text(",".join(names) + "\n" + good + record + good)
    tables = load_raw_dir(spark, str(tmp_path), RAW_SCHEMAS)
    df = tables["raw_transactions"]
    jobs = [
        df.collect,
        df.count,
        df.select("transaction_id").collect,
        df.filter("transaction_id = 'T0'").select("status").collect,
        df.filter("amount_aud > 5").count,
        lambda: catalog.assert_total_rows(tables, 3),
        lambda: catalog.table_rows(tables).collect(),
    ]
    for job in jobs:
        with pytest.raises(Exception, match="(?i)malformed"):
            job()


def test_positions_follow_the_file(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("n\n" + "".join(f"{i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_raw(spark, str(path), positions=True)
        assert df.rdd.getNumPartitions() > 5
        rows = df.orderBy(*POSITION_COLUMNS).select("n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [int(row.n) for row in rows] == list(range(20_000))


def test_load_raw_dir_finds_files_and_part_directories(spark, tmp_path):
    (tmp_path / "accounts.csv").write_text(ACCOUNTS)
    spark.range(10).repartition(3).write.csv(str(tmp_path / "numbers.csv"), header=True)
    (tmp_path / "readme.txt").write_text("not a table")
    tables = load_raw_dir(spark, str(tmp_path), RAW_SCHEMAS)
    assert set(tables) == {"raw_accounts", "raw_numbers"}
    assert tables["raw_numbers"].count() == 10
    assert tables["raw_accounts"].schema["balance_aud"].dataType.simpleString() == "double"
    with pytest.raises(AssertionError, match="raw_numbers"):
        catalog.assert_tables(tables, RAW_TABLES)


def test_row_totals(spark):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(4)}
    assert values(catalog.table_rows(tables)) == [("a", 3), ("b", 0), ("c", 4)]
    assert values(catalog.total_rows(tables)) == [(7,)]
    catalog.assert_total_rows(tables, 7)
    with pytest.raises(AssertionError, match="found 7"):
        catalog.assert_total_rows(tables, 8)


def test_writes_replace_and_the_catalog_lists(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS layer_test")
    spark.range(9).write.saveAsTable("layer_test.numbers")
    for rows in (5, 3):
        writers.write_table(spark.range(rows), "layer_test.numbers")
        again = writers.rebuild(spark, spark.range(rows), str(tmp_path / "numbers"))
    assert spark.table("layer_test.numbers").count() == 3
    assert again.count() == 3
    assert catalog.list_tables(spark, "layer_test") == ["numbers"]
    catalog.assert_tables(catalog.list_tables(spark, "layer_test"), ["numbers"])
    before = spark.table("layer_test.numbers")
    writers.write_table(before.union(before), "layer_test.numbers")
    assert (before.count(), spark.table("layer_test.numbers").count()) == (3, 6)
    spark.sql("DROP DATABASE layer_test CASCADE")


def failing(spark):
    return spark.range(100).selectExpr("raise_error('no') AS id", "id AS day")


def test_a_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "numbers")
    with pytest.raises(FileNotFoundError):
        writers.read_layer(spark, path)
    writers.rebuild(spark, spark.range(5), path)
    writers.write_table(spark.range(4), "kept_numbers")
    for _ in range(3):
        with pytest.raises(Exception, match="no"):
            writers.rebuild(spark, failing(spark), path)
        with pytest.raises(Exception, match="no"):
            writers.write_table(failing(spark), "kept_numbers")
    assert writers.read_layer(spark, path).count() == 5
    assert spark.table("kept_numbers").count() == 4
    spark.sql("DROP VIEW kept_numbers")


def test_a_table_can_be_rebuilt_from_itself_under_its_readers(spark, tmp_path):
    path = str(tmp_path / "numbers")
    table = writers.rebuild(spark, spark.range(2), path)
    for rows in (4, 8, 16):
        reader = table
        table = writers.rebuild(spark, table.union(table), path)
        assert (reader.count(), table.count()) == (rows // 2, rows)
    assert writers.read_layer(spark, path).count() == 16
    assert len(list((tmp_path / "numbers").glob("v*"))) == 2


def test_partitioned_layer_prunes(spark, tmp_path):
    df = spark.range(10).selectExpr("date_add(DATE '2026-01-01', CAST(id AS INT)) AS day", "id")
    read = writers.rebuild(spark, df, str(tmp_path / "days"), ["day"])
    assert read.dtypes == df.dtypes
    read = read.filter("day = DATE '2026-01-03'")
    assert read.count() == 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_the_log_is_computed_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    log = spark.createDataFrame([(2, "r", "b"), (1, "r", "a")], "check_no int, run_at string, check_name string")
    log = log.coalesce(1).mapInArrow(counted, log.schema)
    for _ in range(2):
        written = writers.rebuild(spark, log, str(tmp_path / "log"))
        writers.write_audit(written, str(tmp_path / "log.csv"), str(tmp_path / "history"))
    assert runs.value == 4
    assert [r.check_name for r in spark.read.csv(str(tmp_path / "log.csv"), header=True).collect()] == ["a", "b"]
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2


def test_csv_export_round_trip(spark, tmp_path):
    path = tmp_path / "accounts.csv"
    path.write_text(ACCOUNTS)
    df = read_raw(spark, str(path), RAW_SCHEMAS["accounts"])
    writers.export_csv(df, str(tmp_path / "copy.csv"))
    back = read_raw(spark, str(tmp_path / "copy.csv"), RAW_SCHEMAS["accounts"])
    columns = [name for name in df.columns if name != "last_updated"]
    assert values(back, *columns) == values(df, *columns)
    assert back.filter("account_id = 'A1'").first().last_updated == datetime(2024, 3, 2, 1, 2, 3)


RAW = {
    "customers": "customer_id,full_name,email,phone,state,created_at\n"
    "C1,Ann,a@example.com,0400,NSW,2023-05-06T07:08:09.1\n",
    "accounts": "account_id,customer_id,data_holder,account_type,balance_aud,currency,status,"
    "open_date,last_updated\n"
    "A1,C1,ANZ,savings,,AUD,open,2020-02-29,2024-03-02T01:02:03.45\n"
    "A2,C1,ANZ,savings,5,AUD,open,2026-04-21,2024-03-02T01:02:03.45\n",
    "consents": "consent_id,customer_id,data_holder,status,scopes,created_at,expires_at,"
    "revoked_at,sharing_duration_days\n"
    "K1,C1,ANZ,active,a|b,2026-01-01T00:00:00,2026-04-01T00:00:00,,90\n"
    "K2,,ANZ,active,a|b,2026-01-01T00:00:00,2026-04-01T00:00:00,,90\n",
    "transactions": "transaction_id,account_id,transaction_type,amount_aud,currency,"
    "merchant_name,transaction_date,posted_date,description,status\n"
    "T1,A1,debit,20.5,AUD,Shop,2026-03-03T00:00:00,2026-03-03T00:00:00,first,settled\n"
    "T1,A1,debit,10.5,AUD,Shop,2026-03-01T00:00:00,2026-03-01T00:00:00,second,settled\n"
    "T2,A2,debit,10.5,AUD,Shop,2026-03-01T00:00:00,2026-03-01T00:00:00,orphan,settled\n",
    "feed_logs": "feed_log_id,data_holder,feed_type,run_at,status,records_expected,"
    "records_received,latency_ms,error_code,ingestion_version\n"
    "F1,ANZ,accounts,2026-04-20T10:00:00.5,success,100,100,120,,v1.0.0\n"
    "F2,NAB,accounts,2026-04-18T10:00:00.5,partial,100,10,,,v1.0.0\n",
}


def test_job_rebuilds_every_layer(spark, tmp_path):
    raw_dir, out_dir = tmp_path / "raw", tmp_path / "out"
    raw_dir.mkdir()
    for name, text in RAW.items():
        (raw_dir / f"{name}.csv").write_text(text)
    now = datetime(2026, 4, 20, 16, 48, 29)
    for _ in range(2):  # a rerun replaces everything, including its own history entry
        tables = run_job(spark, str(raw_dir), str(out_dir), now, now)
    # File order decides which T1 is first, not the transaction date.
    assert values(tables["clean_transactions"], "transaction_id", "description") == [
        ("T1", "first")
    ]
    assert tables["clean_transactions"].columns == RAW_SCHEMAS["transactions"].names
    log = (out_dir / "export" / "audit_log.csv").glob("part-*.csv")
    lines = "".join(part.read_text() for part in log).splitlines()
    assert lines[0] == "run_at,check_name,table,status,rows_affected,note"
    assert [line.split(",")[1] for line in lines[1:3]] == ["null_balance", "future_open_date"]
    assert len(lines) == 16
    assert spark.read.parquet(str(out_dir / "audit" / "history")).count() == 15
    exported = spark.read.csv(str(out_dir / "export" / "agg_feed_health.csv"), header=True)
    assert exported.count() == 2
    keep_all = run_job(spark, str(raw_dir), str(tmp_path / "all"), now, now, dedup="keep_all")
    assert keep_all["clean_transactions"].count() == 2


def test_line_breaks_and_broken_rows(spark, tmp_path):
    names = RAW_SCHEMAS["transactions"].names
    row = dict.fromkeys(names, "") | {"transaction_id": "T1", "description": '"one\n""two"", three"', "status": "s"}
    lines = [",".join(names), ",".join(row[n] for n in names), ",".join((row | {"description": "x"})[n] for n in names)]
    (tmp_path / "transactions.csv").write_text("\n".join(lines) + "\n")
    loaded = load_raw_dir(spark, str(tmp_path), RAW_SCHEMAS, multi_line=["transactions"])
    found = values(loaded["raw_transactions"], "transaction_id", "description", "status")
    assert found == [("T1", 'one\n"two", three', "s"), ("T1", "x", "s")]
    with pytest.raises(Exception, match="(?i)malformed"):
        load_raw_dir(spark, str(tmp_path), RAW_SCHEMAS)["raw_transactions"].collect()


def test_exports_have_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "CSV_RECORDS", 10)
    writers.export_csv(spark.range(25, numPartitions=1).selectExpr("cast(id as string) || '\nx' as text"), f"{tmp_path}/parts.csv")
    assert len(list((tmp_path / "parts.csv").glob("part-*"))) == 3
    found = read_raw(spark, f"{tmp_path}/parts.csv", multi_line=True)
    assert sorted(row.text for row in found.collect()) == sorted(f"{i}\nx" for i in range(25))


def test_packed_exports_are_smaller_and_read_alike(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "CSV_RECORDS", 400)
    rows = spark.range(1000, numPartitions=1).selectExpr("cast(id as string) as id", "'some \"text\"\nof ' || id as text")
    for packed in (False, True):
        writers.export_csv(rows, f"{tmp_path}/raw_{packed}/t.csv", packed=packed)
    plain, packed = (list((tmp_path / f"raw_{kind}" / "t.csv").glob("part-*")) for kind in (False, True))
    assert len(plain) == len(packed) == 3 and all(part.name.endswith(".csv.gz") for part in packed)
    assert sum(part.stat().st_size for part in packed) * 3 < sum(part.stat().st_size for part in plain)
    found = [load_raw_dir(spark, f"{tmp_path}/raw_{kind}", {}, multi_line=["t"])["raw_t"] for kind in (False, True)]
    assert values(found[0]) == values(found[1]) == values(rows)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}


def test_job_leaves_no_shuffle_files_and_packs_its_tables(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    for name, text in RAW.items():
        (raw_dir / f"{name}.csv").write_text(text)
    now = datetime(2026, 4, 20, 16, 48, 29)
    before = shuffle_files(spark)
    tables = run_job(spark, str(raw_dir), str(tmp_path / "out"), now, now)  # kept: its plans are not garbage
    deadline = time.monotonic() + 30
    while (left := shuffle_files(spark) - before) and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not left
    assert tables["audit_log"].count() == 15
    layers = [*(tmp_path / "out").glob("*/*/v*/**/*.parquet")]
    assert layers and all(path.name.endswith(".zstd.parquet") for path in layers)


def test_job_over_packed_files_gives_the_same_log(spark, tmp_path):
    logs = []
    for packed in (False, True):
        raw_dir = tmp_path / f"raw_{packed}"
        for name, text in RAW.items():
            (raw_dir / f"{name}.csv").mkdir(parents=True)
            data = gzip.compress(text.encode()) if packed else text.encode()
            (raw_dir / f"{name}.csv" / ("part-0.csv" + ".gz" * packed)).write_bytes(data)
        now = datetime(2026, 4, 20, 16, 48, 29)
        out = str(tmp_path / f"out_{packed}")
        logs.append(values(run_job(spark, str(raw_dir), out, now, now, multi_line=["transactions"])["audit_log"]))
    assert len(logs[0]) == 15 and logs[0] == logs[1]


def test_tables_written_in_slices_hold_all_rows_or_stay_as_they_were(spark, tmp_path):
    rows, path = spark.range(30).toDF("id"), str(tmp_path / "t")
    slices = [rows.filter(F.col("id") % 3 == part) for part in range(3)]
    assert values(writers.rebuild(spark, slices[0], path, others=slices[1:])) == values(rows)
    broken = rows.select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        writers.rebuild(spark, slices[0], path, others=[broken])
    assert values(writers.read_layer(spark, path)) == values(rows)


@pytest.mark.parametrize("dedup", ["first", "keep_all"])
def test_job_in_slices_gives_the_same_tables(spark, tmp_path, monkeypatch, dedup):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    for name, text in RAW.items():
        if name == "transactions":
            more = (f"T{i % 30},A{1 + i % 3},debit,{i - 2}.5,AUD,Shop,2026-03-0{1 + i % 5}T00:00:00,,row {i},settled\n" for i in range(100))
            text += "".join(more) + ",A1,debit,3,AUD,Shop,2026-03-03T00:00:00,,no id,settled\n" * 2
        (raw_dir / f"{name}.csv").write_text(text)
    now, found = datetime(2026, 4, 20, 16, 48, 29), []
    for rows in (session.ROWS_PER_CORE, 1):
        monkeypatch.setattr(session, "ROWS_PER_CORE", rows)
        out = str(tmp_path / f"out_{rows}")
        tables = run_job(spark, str(raw_dir), out, now, now, dedup)
        found.append([values(tables[name]) for name in ("clean_transactions", "agg_transaction_volumes", "audit_log")])
    assert session.slices_for(spark, 105, tables["clean_accounts"].count()) > 5
    assert found[0] == found[1] and len(found[0][0]) >= 10
