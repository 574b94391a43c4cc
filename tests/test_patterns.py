from pyspark.sql import functions as F

from trailmark.operators import patterns
from trailmark.plans import jobs


def test_login_fail_golden(logs):
    got = sorted(tuple(r) for r in jobs.login_fail(logs["login"]).collect())
    assert got == [(1035, 1558430842, 1558430843, "1035连续登陆失败两次"),
                   (1035, 1558430843, 1558430844, "1035连续登陆失败两次")]


def test_order_timeout_golden(logs):
    res = jobs.order_timeout(logs["order"]).cache()
    assert res.count() == 39
    paid = res.where(F.col("result_msg") == "payed successfully")
    assert paid.count() == 37
    assert sorted(r.order_id for r in res.where(F.col("result_msg") == "timeout").collect()) \
        == [34756, 34767]
    assert res.where(F.col("order_id") == 34768).count() == 0
    gaps = paid.select("order_id", (F.col("pay_ts_s") - F.col("create_ts_s")).alias("g"))
    top = gaps.orderBy(F.col("g").desc()).first()
    assert (top.order_id, top.g) == (34766, 151)
    # same-second pay later in the file matches
    assert res.where((F.col("order_id") == 34747)).first().result_msg == "payed successfully"


def test_order_timeout_60s(logs):
    res = jobs.order_timeout(logs["order"], within="60 seconds")
    assert sorted(r.order_id for r in res.where(F.col("result_msg") == "timeout").collect()) \
        == [34756, 34763, 34764, 34765, 34766, 34767]


def _ev(spark, rows):
    return spark.createDataFrame(rows, "k long, kind string, ts_s long, seq long")


def _strict(df, within="2 seconds"):
    out = patterns.strict_next(df, key="k", ts="ts_s", seq="seq", first=F.col("kind") == "fail",
                               second=F.col("kind") == "fail", within=within, carry=["ts_s"])
    return sorted((r.first_ts_s, r.second_ts_s) for r in out.collect())


def test_strict_next_boundaries(spark):
    assert _strict(_ev(spark, [(1, "fail", 100, 0), (1, "fail", 101, 1)])) == [(100, 101)]
    assert _strict(_ev(spark, [(1, "fail", 100, 0), (1, "fail", 102, 1)])) == []
    assert _strict(_ev(spark, [(1, "fail", 100, 0), (1, "success", 100, 1),
                               (1, "fail", 101, 2)])) == []
    assert _strict(_ev(spark, [(1, "fail", 100, 0), (1, "fail", 100, 1)])) == [(100, 100)]
    # out of file order: taken as after sorting by time
    assert _strict(_ev(spark, [(1, "fail", 101, 0), (1, "success", 105, 1),
                               (1, "fail", 100, 2)])) == [(100, 101)]
    # other keys never interleave
    assert _strict(_ev(spark, [(1, "fail", 100, 0), (2, "fail", 100, 1),
                               (1, "fail", 101, 2)])) == [(100, 101)]


def _followed(df, within="15 minutes"):
    out = patterns.followed_by(df, key="k", ts="ts_s", seq="seq",
                               first=F.col("kind") == "create", second=F.col("kind") == "pay",
                               within=within, carry=["ts_s", "seq"])
    return sorted((r.first_seq, r.status, r.second_seq) for r in out.collect())


def test_followed_by_boundaries(spark):
    assert _followed(_ev(spark, [(1, "create", 0, 0), (1, "pay", 899, 1)])) == \
        [(0, "matched", 1)]
    assert _followed(_ev(spark, [(1, "create", 0, 0), (1, "pay", 900, 1)])) == \
        [(0, "timeout", None)]
    assert _followed(_ev(spark, [(1, "create", 0, 0), (1, "pay", 5, 1), (1, "pay", 6, 2)])) == \
        [(0, "matched", 1)]
    assert _followed(_ev(spark, [(1, "create", 0, 0), (1, "create", 3, 1),
                                 (1, "pay", 6, 2)])) == [(0, "matched", 2), (1, "matched", 2)]
    assert _followed(_ev(spark, [(1, "pay", 0, 0), (1, "create", 3, 1)])) == \
        [(1, "timeout", None)]
    # other events in between are skipped
    assert _followed(_ev(spark, [(1, "create", 0, 0), (1, "view", 1, 1),
                                 (1, "pay", 2, 2)])) == [(0, "matched", 2)]
