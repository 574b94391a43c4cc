import os

import pytest
from pyspark.sql import functions as F

from log_data import DATA, lines_df
from trailmark.sources import logs


def test_shipped_log_shapes(logs):
    o, r, lg = logs["order"], logs["receipt"], logs["login"]
    assert o.count() == 79 and r.count() == 40 and lg.count() == 48
    creates = o.where(F.col("event_type") == "create")
    assert creates.count() == 39
    # empty txId stays an empty string, never NULL
    assert creates.where(F.col("tx_id") == "").count() == 39
    assert o.where(F.col("tx_id").isNull()).count() == 0
    assert o.where(F.col("event_type") == "pay").select("tx_id").distinct().count() == 40
    assert lg.where(F.col("event_type") == "fail").count() == 9
    assert lg.select("user_id").distinct().count() == 25
    assert dict(zip(o.columns, [t for _, t in o.dtypes]))["order_id"] == "bigint"


def test_seq_follows_file_order(logs):
    rows = logs["order"].orderBy("seq").select("order_id", "event_type", "ts_s").collect()
    assert tuple(rows[0]) == (34729, "create", 1558430842)
    assert tuple(rows[2]) == (34729, "pay", 1558430844)


def test_padded_and_extra_fields_accepted(spark):
    df = logs.parse_behavior_lines(lines_df(spark, [" 1 , 2,3 , pv ,  1511658000 ",
                                                    "4,5,6,buy,1511658001,extra"]))
    assert [tuple(r) for r in df.collect()] == [(1, 2, 3, "pv", 1511658000),
                                                (4, 5, 6, "buy", 1511658001)]


@pytest.mark.parametrize("line", ["1,2,3,pv", "x1,2,3,pv,1511658000"])
def test_bad_lines_fail_the_job(spark, line):
    df = logs.parse_behavior_lines(lines_df(spark, ["1,2,3,pv,1511658000", line]))
    with pytest.raises(Exception):
        df.collect()


def test_access_log(spark):
    df = logs.parse_access_lines(lines_df(spark, [
        "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/"]))
    r = df.collect()[0]
    assert r.ip == "83.149.9.216" and r.user_id == "-" and r.method == "GET"
    assert r.url == "/presentations/logstash-monitorama-2013/"
    assert r.event_ms == 1431857103000


def test_read_log_text_files(spark):
    df = logs.read_log(spark, "receipt", os.path.join(DATA, "receipt_log.csv"))
    first = df.orderBy("seq").first()
    assert (first.tx_id, first.pay_channel, first.ts_s) == ("ewr342as4", "wechat", 1558430845)


def test_seq_follows_file_names_and_lines(spark, tmp_path):
    # a short file named first and a long one second: Spark packs splits by size,
    # the seq still orders by file, then by line
    (tmp_path / "a.csv").write_text("1,fail-a,x,1\n")
    (tmp_path / "b.csv").write_text("".join(f"2,e{i},x,{i}\n" for i in range(200)))
    df = logs.read_log(spark, "login", str(tmp_path))
    ordered = [r.ip for r in df.orderBy("seq").collect()]
    assert ordered == ["fail-a"] + [f"e{i}" for i in range(200)]
