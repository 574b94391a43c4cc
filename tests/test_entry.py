
import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.check_oracle import _rows, type_mismatches

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["window_end", "rank", "user_id", "count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    # corpus queries that SQL cannot express are tested in tests/llm
    core = {k for k in entry_mod.queries() if not k.startswith("op") and k != "pipeline"}
    assert core <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["events", "orders", "lineitem", "documents", "embeddings", "pages", "labels"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert type_mismatches(df.dtypes, rel.columns, rel.types) == []
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", ["hot_items_report", "login_fail_pairs", "scan_access_log",
                                  "event_time_seconds", "running_unique_visitors"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "Australia/Lord_Howe")
    try:
        df = entry_mod.queries()[name](spark, SF)
        got = _rows(df.columns, df.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    rel = duck.sql(entry_mod.oracle_sql()[name])
    assert got == _rows(rel.columns, rel.fetchall())
