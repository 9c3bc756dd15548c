"""Every query against SQL in another engine, over whole test tables."""

import datetime
import decimal
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata"))
SCALES = os.environ.get("TEST_SCALES", "sf0.01,skewed").split(",")
TABLES = ("customer", "orders", "lineitem", "events")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


# A third of all rows on one key, another part without a key, for every source.
SKEW = {
    "customer": "SELECT * REPLACE (nullif(c_custkey, 20) AS c_custkey)",
    "orders": """SELECT * REPLACE (
        CASE o_orderkey % 6 WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN NULL ELSE o_custkey END
        AS o_custkey)""",
    # Suppliers are numbered through, which keeps the order within an id total.
    "lineitem": """SELECT * REPLACE (
        CASE row_number() OVER () % 6 WHEN 0 THEN 11 WHEN 1 THEN 11 WHEN 2 THEN NULL
             ELSE l_orderkey END AS l_orderkey,
        row_number() OVER () AS l_suppkey)""",
    "events": """SELECT * REPLACE (
        CASE event_id % 3 WHEN 0 THEN 5 ELSE user_id END AS user_id,
        CASE event_id % 50 WHEN 0 THEN NULL ELSE ts END AS ts)""",
}


def skewed_copy(target):
    for table, query in SKEW.items():
        source, copy = DATA / "sf0.001" / f"{table}.parquet", target / f"{table}.parquet"
        duckdb.execute(f"COPY ({query} FROM '{source}') TO '{copy}' (FORMAT parquet)")
    return target


@pytest.fixture(scope="module", params=SCALES)
def scale(request, tmp_path_factory):
    if request.param == "skewed":
        directory = skewed_copy(tmp_path_factory.mktemp("skewed"))
    else:
        directory = DATA / request.param
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{directory}/{table}.parquet'")
    yield str(directory), con
    con.close()


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        ([normal(row[i]) for i in order] for row in rows), key=lambda row: [str(v) for v in row]
    )


def test_registries_match():
    assert set(driver.feed_queries()) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.feed_queries()))
def test_query_matches_oracle(spark, scale, name):
    directory, con = scale
    df = driver.queries()[name](spark, directory)
    cursor = con.execute(driver.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted_rows(columns, cursor.fetchall())
    actual = sorted_rows(df.columns, df.collect())
    assert len(actual) == len(expected)
    types = {type(v) for row in expected for v in row}
    assert types >= {type(v) for row in actual for v in row}
    assert actual == expected


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.count() == 15
    assert df.columns == [
        "check_no", "run_at", "check_name", "table", "status", "rows_affected", "note",
    ]
