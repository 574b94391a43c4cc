import pytest
from pyspark.sql import functions as F

from trailmark.functions.hashing import poly_hash
from trailmark.operators import topn, uniques, windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").cache()


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("size,slide,block", [
    ("1 hour", "5 minutes", 16), ("10 minutes", "5 seconds", 16), ("1 hour", "7 minutes", 1),
    ("10 minutes", "10 minutes", 16), ("2 hours", "45 minutes", 1)])
def test_sweep_equals_window_function(events, size, slide, block):
    for keys in (["user_id"], ["user_id", "event_type"], []):
        a = windows.window_counts(events, keys=keys, ts="ts", size=size, slide=slide,
                                  block_factor=block)
        b = windows.window_counts_by_window_fn(events, keys=keys, ts="ts", size=size, slide=slide)
        assert _same(a, b)


def test_pane_method_equals_sweep(events):
    a = windows.window_counts(events, keys="user_id", ts="ts", size="1 hour", slide="5 minutes")
    b = windows.window_counts(events, keys="user_id", ts="ts", size="1 hour", slide="5 minutes",
                              method="pane")
    assert _same(a, b)


def test_window_boundaries(spark):
    # 3600 s is a boundary: the row belongs to the window starting there
    df = spark.createDataFrame([(1, 3600_000), (1, 3599_999)], "k long, ms long")
    got = sorted(tuple(r) for r in windows.window_counts(
        df, keys="k", ts="ms", unit="ms", size="1 hour").collect())
    assert got == [(1, 3600_000, 1), (1, 7200_000, 1)]
    slid = windows.window_counts(df, keys="k", ts="ms", unit="ms", size="10 minutes",
                                 slide="5 minutes")
    ends = {r.window_end: r["count"] for r in slid.collect()}
    assert ends[3600_000] == 1 and ends[3900_000] == 2 and ends[4200_000] == 1
    assert len(ends) == 3


def test_topn_ties_and_few_keys(spark):
    counts = spark.createDataFrame([(10, 5, 3), (10, 4, 3), (10, 9, 1), (10, 1, 7), (20, 2, 1)],
                                   "window_end long, item long, count long")
    got = [tuple(r) for r in topn.top_n(counts, key="item", n=3)
           .orderBy("window_end", "rank").collect()]
    assert got == [(10, 1, 1, 7), (10, 2, 4, 3), (10, 3, 5, 3), (20, 1, 2, 1)]


def test_reports(spark):
    best = spark.createDataFrame([(1511661600000, 1, 42, 7), (1511661600000, 2, 7, 3)],
                                 "window_end long, rank long, item_id long, count long")
    rep = topn.ranked_report(best, key="item_id", style="items").first().report
    assert rep == "时间: 2017-11-26 02:00:00.0\nno1: 商品ID=42浏览量=7\nno2: 商品ID=7浏览量=3\n"
    urls = best.withColumnRenamed("item_id", "url")
    rep = topn.ranked_report(urls, key="url", style="urls").first().report
    assert rep == ("时间: 2017-11-26 02:00:00.0\nNO1: URL=42 count=7\nNO2: URL=7 count=3\n"
                   + "+" * 36)


def test_hash_constant(spark):
    r = spark.range(1).select(poly_hash(F.lit("123456789")).alias("h"),
                              poly_hash(F.lit("")).alias("e")).first()
    assert r.h == 127877917 and r.e == 0


def test_unique_counts(spark):
    df = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (1, 3700)], "u long, ts_s long")
    got = sorted(tuple(r) for r in uniques.unique_count(df, user="u", ts="ts_s",
                                                         size="1 hour").collect())
    assert got == [(3600_000, 2), (7200_000, 1)]
    got = sorted(tuple(r) for r in uniques.bitmap_unique_count(df, user="u", ts="ts_s",
                                                                size="1 hour").collect())
    assert got == [(3600_000, 2), (7200_000, 1)]


def test_running_unique(spark):
    df = spark.createDataFrame([(1, 10, 0), (1, 20, 1), (2, 20, 2), (3, 5000, 3), (2, 30, 4)],
                               "u long, ts_s long, seq long")
    out = uniques.running_unique_count(df, user="u", ts="ts_s", size="1 hour", seq="seq",
                                       keep=["seq"])
    got = sorted((r.seq, r.uv_count) for r in out.collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 1), (4, 2)]


def test_truncated_average(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, -3), (2, -4)], "k long, v long")
    got = dict((r.k, r.avg) for r in uniques.truncated_average(df, key="k", value="v").collect())
    assert got == {1: 1.0, 2: -3.0}


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("1 hour", "7 minutes"),
                                        ("30 minutes", "30 minutes")])
def test_window_aggregate_generic(events, size, slide):
    got = windows.window_aggregate(events, keys="user_id", ts="ts", size=size, slide=slide,
                                   aggs={"count": F.count(F.lit(1)),
                                         "value_sum": F.round(F.sum("value"), 6)})
    counts = windows.window_counts(events, keys="user_id", ts="ts", size=size, slide=slide)
    assert _same(got.select("user_id", "window_end", "count"), counts)
    fn = windows.window_counts_by_window_fn(events, keys="user_id", ts="ts", size=size,
                                            slide=slide)
    assert _same(got.select("user_id", "window_end", "count"), fn)


def test_java_timestamp_text(spark):
    from trailmark.functions.time import java_timestamp_text
    df = spark.createDataFrame([(0,), (1500,), (1230,), (1001,), (1511661600000,)], "ms long")
    got = [r.t for r in df.select(java_timestamp_text(F.col("ms")).alias("t")).collect()]
    assert got == ["1970-01-01 00:00:00.0", "1970-01-01 00:00:01.5", "1970-01-01 00:00:01.23",
                   "1970-01-01 00:00:01.001", "2017-11-26 02:00:00.0"]


def test_bad_parameters_rejected(events):
    from trailmark.operators import patterns
    with pytest.raises(ValueError):
        windows.window_counts(events, keys="user_id", ts="ts", size="0 seconds")
    with pytest.raises(ValueError):
        topn.top_n(events, key="user_id", n=0, value="value", group="event_type")
    with pytest.raises(ValueError):
        patterns.strict_next(events, key="user_id", ts="ts", seq="event_id",
                             first=F.lit(True), second=F.lit(True), within="0 seconds")


def test_arithmetic_hash_equals_text_hash(spark):
    from trailmark.functions.hashing import poly_hash_of_long
    vals = [0, 7, 10, 99, 100, 123456789, 10**18, 9223372036854775807, -1, -4567,
            -9223372036854775808]
    df = spark.createDataFrame([(v,) for v in vals], "x long").union(
        spark.range(0, 50000).select((F.col("id") * 104729 + 3).alias("x")))
    bad = df.where(poly_hash(F.col("x").cast("string")) != poly_hash_of_long(F.col("x")))
    assert bad.count() == 0


def test_hot_urls_job_report(spark):
    from log_data import lines_df
    from trailmark.plans import jobs
    from trailmark.sources import logs
    rows = ["1.1.1.1 - - 17/05/2015:10:05:01 +0000 GET /a",
            "1.1.1.2 - - 17/05/2015:10:05:02 +0000 GET /b",
            "1.1.1.3 - - 17/05/2015:10:05:03 +0000 GET /a",
            "1.1.1.4 - - 17/05/2015:10:05:03 +0000 GET /c"]
    access = logs.parse_access_lines(lines_df(spark, rows))
    reports = {r.window_end: r.report for r in jobs.hot_urls(access, n=2).collect()}
    # window [10:05:00 - 10 min + 5 s, 10:05:05) holds all four rows
    rep = reports[1431857105000]
    assert rep == ("时间: 2015-05-17 10:05:05.0\nNO1: URL=/a count=2\nNO2: URL=/b count=1\n"
                   + "+" * 36)
    assert len(reports) == 120  # all rows share one 5 s pane: 120 windows


def test_window_aggregate_accepts_a_user_aggregate(events):
    """The reference's AggregateFunction slot: a grouped-aggregate pandas UDF."""
    import pandas as pd

    @F.pandas_udf("double")
    def mean_value(v: pd.Series) -> float:
        return float(v.mean())

    got = windows.window_aggregate(events, keys="user_id", ts="ts", size="1 hour",
                                   slide="30 minutes",
                                   aggs={"m": F.round(mean_value("value"), 6)})
    want = windows.window_aggregate(events, keys="user_id", ts="ts", size="1 hour",
                                    slide="30 minutes", aggs={"m": F.round(F.avg("value"), 6)})
    assert _same(got, want)
