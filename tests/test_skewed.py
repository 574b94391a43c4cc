"""The keyed queries on a skewed variant of ``events`` (every third event
re-keyed to one user, so one key holds a third of the rows) still match
their SQL oracle: the block and bucket splitting of hot keys is exact."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tools.check_oracle import _rows

SF = "/root/testdata/sf0.01"
KEYED = ["hot_items_counts", "hot_items_topn", "running_unique_visitors", "login_fail_pairs",
         "order_results", "tx_interval_join", "tx_reconcile", "tx_unmatched_receipts"]


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1))
                        .otherwise(F.col("user_id")))
    hot.coalesce(1).write.parquet(os.path.join(d, "events.parquet"))
    return d


@pytest.mark.parametrize("name", KEYED)
def test_keyed_queries_on_a_hot_key(spark, skewed_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{skewed_dir}/events.parquet/*.parquet')")
    df = entry_mod.queries()[name](spark, skewed_dir)
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())
