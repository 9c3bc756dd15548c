import subprocess
import sys
from pathlib import Path

import pytest

from feedward import session
from feedward.sources import catalog
from helpers import raw, values

REPO = Path(__file__).resolve().parents[1]


def test_planned_bytes_are_those_of_the_files(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t")
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    table = spark.read.parquet(f"{tmp_path}/t")
    assert session.planned_bytes(table) == size
    assert session.planned_bytes(table.unionByName(table.filter("id > 3"))) == 2 * size


def test_shuffles_are_sized_for_the_block_only(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session.sized_shuffles(spark, 100 * 10**12) as partitions:
        assert spark.conf.get(key) == str(partitions)
        assert 100 * 10**12 / partitions <= session.BYTES_PER_SHUFFLE_PARTITION
        assert 100 * 10**12 / partitions > 0.99 * session.BYTES_PER_SHUFFLE_PARTITION
    assert spark.conf.get(key) == before
    with session.sized_shuffles(spark, 1) as partitions:
        assert str(partitions) == before


def test_shared_dir_is_the_one_the_cluster_names(tmp_path):
    code = f"""
from feedward.session import build_session, shared_dir
spark = build_session("t", "local[1]", spark__checkpoint__dir="{tmp_path}/shared/")
assert shared_dir(spark) == "{tmp_path}/shared", shared_dir(spark)
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=300)


def test_views_answer_plain_sql(spark):
    accounts = raw(spark, "accounts", {"account_id": "A1"}, {"balance_aud": 1.0})
    catalog.register_views({"raw_accounts": accounts})
    assert "raw_accounts" in catalog.list_tables(spark)
    found = spark.sql("SELECT count(*) AS n FROM raw_accounts WHERE balance_aud IS NULL")
    assert values(found) == [(1,)]
    spark.catalog.dropTempView("raw_accounts")


def test_steps_of_the_job_hold_every_table_after_what_it_needs():
    from datetime import date

    from feedward.plans.layers import STEPS
    from feedward.plans.tables import Layers
    from feedward.sources.schemas import RAW_TABLES

    tables = Layers({name: lambda: None for name in RAW_TABLES}, date(2020, 1, 1))
    assert sorted(name for names in STEPS for name in names) == sorted(tables)


def test_calls_run_side_by_side_and_the_first_error_is_raised(spark):
    from threading import Barrier

    from feedward.session import together

    met = Barrier(3, timeout=30)
    assert together(lambda n: met.wait() is not None and n * 2, {"a": (1,), "b": (2,), "c": (3,)}) == {"a": 2, "b": 4, "c": 6}
    with pytest.raises(ZeroDivisionError):
        together(lambda n: 1 // n, {"a": (1,), "b": (0,)})
    assert together(print, {}) == {}


def test_packed_text_counts_for_what_it_holds(spark, tmp_path):
    text = spark.range(20_000).selectExpr("'some words, then ' || md5(cast(id as string)) AS text").coalesce(1)
    text.write.text(f"{tmp_path}/plain")
    text.write.text(f"{tmp_path}/packed", compression="gzip")
    plain, packed = (spark.read.text(f"{tmp_path}/{name}") for name in ("plain", "packed"))
    assert session.text_bytes(plain) == session.planned_bytes(plain)
    assert session.planned_bytes(packed) < session.text_bytes(plain)
    assert session.text_bytes(packed) >= session.text_bytes(plain)


def test_settings_of_chained_jobs_hold_for_the_block_only(spark):
    before = {key: spark.conf.get(key) for key in session.CHAINED}
    with pytest.raises(ValueError), session.chained_jobs(spark):
        assert {key: spark.conf.get(key) for key in before} == session.CHAINED
        raise ValueError
    assert {key: spark.conf.get(key) for key in before} == before


def test_slices_grow_with_the_rows_and_shrink_with_the_cores(spark):
    most = session.ROWS_PER_CORE * spark.sparkContext.defaultParallelism
    assert [session.slices_for(spark, rows, 0) for rows in (0, most, most + 1, 7 * most)] == [1, 1, 2, 7]
    assert [session.slices_for(spark, 7 * most, parents * most) for parents in (1, 2, 3, 8)] == [7, 3, 2, 1]
