"""Streaming forms on the shipped logs: files appear in a folder, a last
file holds a far-future sentinel row of another key that moves the
watermark and flushes every open window, timer and pattern."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import functions as F

from log_data import DATA
from trailmark.sources import logs, sinks
from trailmark.streaming import matching as sm
from trailmark.streaming import patterns as sp
from trailmark.streaming import watermarks as wm
from trailmark.streaming import windows as sw


def _folder(*files):
    d = tempfile.mkdtemp(prefix="tm-in-")
    for i, (name, lines) in enumerate(files):
        with open(os.path.join(d, f"{i:03d}-{name}"), "w") as f:
            f.write("\n".join(lines) + "\n")
    return d


def _read(name):
    with open(os.path.join(DATA, name)) as f:
        return [x for x in f.read().splitlines() if x.strip()]


def _run(spark, df, mode="append", foreach=None):
    name = "q" + uuid.uuid4().hex[:8]
    ck = tempfile.mkdtemp(prefix="tm-ck-")
    q = sinks.write_stream(df, name, fmt="memory", output_mode=mode, checkpoint=ck,
                           foreach_batch=foreach)
    q.processAllAvailable()
    q.stop()
    return name


def _with_seq(df):
    # streams have no line order; ties of equal seconds are broken by
    # event kind (create before pay), the order of the shipped logs
    return df.withColumn("seq", F.when(F.col("event_type") == "create", 0).otherwise(1)) \
        if "event_type" in df.columns else df.withColumn("seq", F.lit(0))


def test_stream_login_fail(spark):
    lines = _read("login_log.csv") + ["1,0.0.0.0,success,1558500000"]
    d = _folder(("login", lines))
    src = _with_seq(logs.read_log_stream(spark, "login", d, maxFilesPerTrigger=1))
    ev = wm.bounded_out_of_order(src, "ts_s", "5 seconds")
    out = sp.stream_strict_next(ev, key="user_id", seq="seq",
                                first=F.col("event_type") == "fail",
                                second=F.col("event_type") == "fail", within="2 seconds")
    # one more empty batch after the data so the advanced watermark fires timers
    name = _run(spark, out)
    got = sorted((r.user_id, r.first_t // 1000, r.second_t // 1000)
                 for r in spark.table(name).collect())
    # 1035's three fails at 842..844 arrive before the 5 s bound passes
    assert (1035, 1558430842, 1558430843) in got and (1035, 1558430843, 1558430844) in got
    assert all(u == 1035 for u, _, _ in got)


def test_stream_order_timeout(spark):
    lines = _read("order_log.csv") + ["1,create,,1558500000"]
    d = _folder(("orders", lines))
    src = _with_seq(logs.read_log_stream(spark, "order", d))
    ev = wm.ascending(src, "ts_s")
    out = sp.stream_order_results(sp.stream_followed_by(
        ev, key="order_id", seq="seq", first=F.col("event_type") == "create",
        second=F.col("event_type") == "pay", within="15 minutes", carry=["tx_id"]))
    name = _run(spark, out)
    rows = spark.table(name).where(F.col("order_id") != 1).collect()
    paid = [r for r in rows if r.result_msg == "payed successfully"]
    timeouts = sorted(r.order_id for r in rows if r.result_msg == "timeout")
    assert len(paid) == 37 and timeouts == [34756, 34767]


def test_stream_reconcile_one_to_one(spark):
    pays = _folder(("orders", _read("order_log.csv") + ["9,pay,zz-sentinel,1558500000"]))
    recs = _folder(("receipts", _read("receipt_log.csv") + ["zz-sentinel2,wechat,1558500000"]))
    p = wm.ascending(_with_seq(logs.read_log_stream(spark, "order", pays))
                     .where(F.col("tx_id") != ""), "ts_s")
    r = wm.ascending(_with_seq(logs.read_log_stream(spark, "receipt", recs)), "ts_s")
    out = sp.stream_reconcile_one_to_one(p, r, key="tx_id", seq="seq", bound="5 seconds",
                                         pay_carry=["order_id"], receipt_carry=["pay_channel"])
    name = _run(spark, out)
    res = spark.table(name).where(~F.col("tx_id").startswith("zz")).cache()
    counts = {r.status: r["count"] for r in res.groupBy("status").count().collect()}
    assert counts == {"matched": 5, "unmatched_pay": 35, "unmatched_receipt": 35}


def test_stream_interval_join(spark):
    pays = _folder(("orders", _read("order_log.csv")))
    recs = _folder(("receipts", _read("receipt_log.csv")))
    p = wm.with_event_time(logs.read_log_stream(spark, "order", pays)
                           .where(F.col("tx_id") != ""), "ts_s", delay="10 seconds")
    r = wm.with_event_time(logs.read_log_stream(spark, "receipt", recs), "ts_s",
                           delay="10 seconds")
    out = sm.stream_interval_join(p, r, left_key="tx_id", right_key="tx_id",
                                  left_carry=["ts_s"], right_carry=["ts_s"])
    name = _run(spark, out)
    got = sorted(r.pay_key for r in spark.table(name).collect())
    assert got == sorted(["sd76f87d6", "3hu3k2432", "435kjb45d", "3243hr9h9", "329d09f9f"])


def _behavior_lines(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    secs = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    rows = ev.select(F.concat_ws(",", "user_id", "event_id", F.lit(1),
                                 F.when(F.col("event_type") == "view", "pv")
                                 .otherwise(F.col("event_type")), secs).alias("v"),
                     secs.alias("s")).orderBy("s").collect()
    return [r.v for r in rows]


def test_stream_hot_items_equals_batch(spark):
    from trailmark.plans import jobs
    lines = _behavior_lines(spark)
    d = _folder(("behavior", lines + ["0,0,0,pv,1800000000"]))
    src = logs.read_log_stream(spark, "behavior", d)
    views = wm.ascending(src.where(F.col("behavior") == "pv"), "ts_s")
    counts = sw.stream_window_counts(views, keys="item_id", size="1 hour", slide="5 minutes")
    table = "hot" + uuid.uuid4().hex[:6]

    def sink(df, batch_id):
        df.write.mode("append").saveAsTable(table) if batch_id >= 0 else None

    try:
        _run(spark, counts, foreach=sw.top_n_each_batch(counts, key="item_id", n=3, sink=sink))
        got = spark.table(table)
        batch = jobs.hot_items(logs.parse_behavior_lines(
            spark.createDataFrame([(x,) for x in lines], "value string")), report=False)
        assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_stream_unique_visitors(spark):
    from trailmark.plans import jobs
    lines = _behavior_lines(spark)
    d = _folder(("behavior", lines + ["0,0,0,pv,1800000000"]))
    views = wm.ascending(logs.read_log_stream(spark, "behavior", d)
                         .where(F.col("behavior") == "pv"), "ts_s")
    name = _run(spark, sw.stream_unique_count(views, user="user_id", size="1 hour"))
    got = spark.table(name)
    batch = jobs.unique_visitors(logs.parse_behavior_lines(
        spark.createDataFrame([(x,) for x in lines], "value string")))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_upsert_sink(spark):
    out = tempfile.mkdtemp(prefix="tm-up-")
    run = sinks.upsert_by_window(out)
    run(spark.createDataFrame([(1, 5), (2, 7)], "window_end long, uv_count long"), 0)
    run(spark.createDataFrame([(2, 9)], "window_end long, uv_count long"), 1)
    got = sorted(tuple(r) for r in spark.read.parquet(out)
                 .select("window_end", "uv_count").collect())
    assert got == [(1, 5), (2, 9)]
    shutil.rmtree(out, ignore_errors=True)


def test_late_rows_drop_only_closed_windows(spark):
    def line(t, url):
        import datetime as dt
        s = dt.datetime.fromtimestamp(t, dt.timezone.utc).strftime("%d/%m/%Y:%H:%M:%S")
        return f"1.1.1.1 - - {s} +0000 GET {url}"
    d = tempfile.mkdtemp(prefix="tm-late-")
    src = logs.read_log_stream(spark, "access", d, maxFilesPerTrigger=1)
    ev = wm.with_event_time(src, "event_ms", unit="ms", delay="1 seconds", lateness="1 minutes")
    counts = sw.stream_window_counts(ev, keys="url", size="10 minutes", slide="5 seconds")
    name = "late" + uuid.uuid4().hex[:6]
    q = sinks.write_stream(counts, name, fmt="memory", output_mode="update",
                           checkpoint=tempfile.mkdtemp(prefix="tm-ck-"))
    try:
        with open(os.path.join(d, "000"), "w") as f:
            f.write(line(1000, "/a") + "\n")
        q.processAllAvailable()
        with open(os.path.join(d, "001"), "w") as f:
            f.write(line(950, "/b") + "\n" + line(900, "/c") + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    per_url = {r.url: r["n"] for r in spark.table(name).groupBy("url")
               .agg(F.countDistinct("window_end").alias("n")).collect()}
    # watermark after the first batch: 1000 s - 61 s = 939 s
    assert per_url["/a"] == 120 and per_url["/b"] == 120
    assert per_url["/c"] == 120 - 7  # windows ending 905..935 s were closed


def test_stream_page_views_and_bitmap(spark):
    from trailmark.plans import jobs
    lines = _behavior_lines(spark)
    d = _folder(("behavior", lines + ["0,0,0,pv,1800000000"]))
    views = wm.ascending(logs.read_log_stream(spark, "behavior", d)
                         .where(F.col("behavior") == "pv"), "ts_s")
    pv = spark.table(_run(spark, sw.stream_page_views(views, size="1 hour")))
    bm = spark.table(_run(spark, sw.stream_unique_count(views, user="user_id", size="1 hour",
                                                        bitmap=True)))
    parsed = logs.parse_behavior_lines(spark.createDataFrame([(x,) for x in lines],
                                                             "value string"))
    want_pv = jobs.page_views(parsed)
    want_bm = jobs.unique_visitors_bitmap(parsed, running=False)
    assert pv.exceptAll(want_pv).count() == 0 and want_pv.exceptAll(pv).count() == 0
    assert bm.exceptAll(want_bm).count() == 0 and want_bm.exceptAll(bm).count() == 0


def test_stream_full_outer_reconcile(spark):
    pays = _folder(("orders", _read("order_log.csv") + ["9,pay,zz1,1558500000"]))
    recs = _folder(("receipts", _read("receipt_log.csv") + ["zz2,wechat,1558500000"]))
    p = wm.with_event_time(logs.read_log_stream(spark, "order", pays)
                           .where(F.col("tx_id") != ""), "ts_s", delay="10 seconds")
    r = wm.with_event_time(logs.read_log_stream(spark, "receipt", recs), "ts_s",
                           delay="10 seconds")
    out = sm.stream_reconcile(p, r, left_key="tx_id", right_key="tx_id",
                              left_carry=["order_id"], right_carry=["pay_channel"])
    res = spark.table(_run(spark, out))
    res = res.where(~F.coalesce(F.col("pay_key"), F.col("receipt_key")).startswith("zz"))
    counts = {x.status: x["count"] for x in res.groupBy("status").count().collect()}
    assert counts == {"matched": 5, "unmatched_pay": 35, "unmatched_receipt": 35}


def test_refining_top_n_reranks_late_windows_completely(spark):
    import datetime as dt

    def line(t, url):
        s = dt.datetime.fromtimestamp(t, dt.timezone.utc).strftime("%d/%m/%Y:%H:%M:%S")
        return f"1.1.1.1 - - {s} +0000 GET {url}"
    d = tempfile.mkdtemp(prefix="tm-ref-")
    table = tempfile.mkdtemp(prefix="tm-tab-") + "/t"
    src = logs.read_log_stream(spark, "access", d, maxFilesPerTrigger=1)
    ev = wm.with_event_time(src, "event_ms", unit="ms", delay="1 seconds", lateness="1 minutes")
    counts = sw.stream_window_counts(ev, keys="url", size="10 minutes", slide="5 seconds")
    out_name = "ref" + uuid.uuid4().hex[:6]
    results = []

    def sink(df, batch_id):
        results.append((batch_id, [tuple(r) for r in df.collect()]))
    q = sinks.write_stream(counts, out_name, output_mode="update",
                           checkpoint=tempfile.mkdtemp(prefix="tm-ck-"),
                           foreach_batch=sw.refining_top_n_each_batch(
                               key="url", n=2, table=table, sink=sink))
    try:
        with open(os.path.join(d, "000"), "w") as f:
            f.write("\n".join([line(1000, "/a"), line(1000, "/a"), line(1001, "/b")]) + "\n")
        q.processAllAvailable()
        with open(os.path.join(d, "001"), "w") as f:
            f.write("\n".join([line(990, "/c"), line(990, "/c"), line(991, "/c")]) + "\n")
        q.processAllAvailable()
    finally:
        q.stop()
    last = dict(((r[0], r[1]), (r[2], r[3])) for r in results[-1][1])
    # window ending 1005 s: /c (3, late) ranks first, /a (2) second; /b is pushed out
    assert last[(1005_000, 1)] == ("/c", 3) and last[(1005_000, 2)] == ("/a", 2)


def test_stream_bitmap_count_upserted_per_window(spark):
    from trailmark.plans import jobs
    lines = _behavior_lines(spark)
    half = len(lines) // 2
    d = tempfile.mkdtemp(prefix="tm-up-in-")
    out = tempfile.mkdtemp(prefix="tm-up-out-") + "/uv"
    src = logs.read_log_stream(spark, "behavior", d, maxFilesPerTrigger=1)
    views = wm.ascending(src.where(F.col("behavior") == "pv"), "ts_s")
    counts = sw.stream_unique_count(views, user="user_id", size="1 hour", bitmap=True)
    q = sinks.write_stream(counts, "uvup" + uuid.uuid4().hex[:6], output_mode="update",
                           checkpoint=tempfile.mkdtemp(prefix="tm-ck-"),
                           foreach_batch=sinks.upsert_by_window(out))
    try:
        for i, chunk in enumerate([lines[:half], lines[half:]]):
            with open(os.path.join(d, f"{i:03d}"), "w") as f:
                f.write("\n".join(chunk) + "\n")
            q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(out).select("window_end", "uv_count")
    parsed = logs.parse_behavior_lines(spark.createDataFrame([(x,) for x in lines],
                                                             "value string"))
    want = jobs.unique_visitors_bitmap(parsed, running=False)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_strict_next_orders_rows_across_batches(spark):
    d = tempfile.mkdtemp(prefix="tm-ooo-")
    src = logs.read_log_stream(spark, "login", d, maxFilesPerTrigger=1)
    ev = wm.bounded_out_of_order(src, "ts_s", "5 seconds")
    out = sp.stream_strict_next(ev, key="user_id", first=F.col("event_type") == "fail",
                                second=F.col("event_type") == "fail", within="2 seconds")
    name = "ooo" + uuid.uuid4().hex[:6]
    q = sinks.write_stream(out, name, fmt="memory", checkpoint=tempfile.mkdtemp(prefix="tm-ck-"))
    batches = [["7,ip,fail,100", "7,ip,fail,104"],
               ["7,ip,fail,103"],            # 4 s behind, inside the 5 s bound: not late
               ["7,ip,fail,90"],             # behind the watermark (99 s): late, dropped
               ["8,ip,success,1000"]]        # sentinel of another key: flushes
    try:
        for i, rows in enumerate(batches):
            with open(os.path.join(d, f"{i:03d}"), "w") as f:
                f.write("\n".join(rows) + "\n")
            q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.first_t // 1000, r.second_t // 1000) for r in spark.table(name).collect())
    assert got == [(103, 104)]


def test_stream_running_unique_per_event_equals_batch(spark):
    from trailmark.operators import uniques
    lines = _behavior_lines(spark)
    third = len(lines) // 3
    d = tempfile.mkdtemp(prefix="tm-run-")
    seen = tempfile.mkdtemp(prefix="tm-seen-") + "/seen"
    src = logs.read_log_stream(spark, "behavior", d, maxFilesPerTrigger=1)
    views = src.where(F.col("behavior") == "pv")
    table = "run" + uuid.uuid4().hex[:6]

    def sink(df, batch_id):
        df.write.mode("append").saveAsTable(table)
    q = sinks.write_stream(views, "q" + table, checkpoint=tempfile.mkdtemp(prefix="tm-ck-"),
                           foreach_batch=sw.running_unique_each_batch(
                               seen_table=seen, user="user_id", ts="ts_s", seq="item_id",
                               keep=["item_id"], sink=sink))
    try:
        for i, chunk in enumerate([lines[:third], lines[third:2 * third], lines[2 * third:]]):
            with open(os.path.join(d, f"{i:03d}"), "w") as f:
                f.write("\n".join(chunk) + "\n")
            q.processAllAvailable()
        got = spark.table(table)
        parsed = logs.parse_behavior_lines(spark.createDataFrame([(x,) for x in lines],
                                                                 "value string"))
        want = uniques.running_unique_count(parsed.where(F.col("behavior") == "pv"),
                                            user="user_id", ts="ts_s", size="1 hour",
                                            seq="item_id", keep=["item_id"])
        assert got.count() == want.count()
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        q.stop()
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_stream_running_unique_drops_rows_of_closed_windows(spark):
    """All rows drive the watermark, also those that do not count; a row of a
    closed window gives no row and no count, a replayed batch counts once."""
    seen = tempfile.mkdtemp(prefix="tm-seen-") + "/seen"
    got = []
    run = sw.running_unique_each_batch(seen_table=seen, user="user_id", ts="ts_s", seq="seq", keep=["seq"], forget="1 day",
                                       only=F.col("behavior") == "pv", sink=lambda df, i: got.append(
                                           sorted((r.seq, r.uv_count) for r in df.collect())))
    batch = lambda rows: spark.createDataFrame(rows, "user_id long, ts_s long, behavior string, seq long")
    hour = 3600
    batches = [
        [(1, 10, "pv", 1), (2, 20, "pv", 2), (1, 30, "pv", 3)],
        [(3, 40, "pv", 4), (4, hour, "buy", 5)],             # the second closes nothing: 1 ms too early
        [(5, 50, "pv", 6), (9, 2 * hour, "buy", 7)],         # now the watermark is at 2 h less 1 ms
        [(6, 60, "pv", 8), (6, hour + 5, "pv", 9), (6, 2 * hour + 1, "pv", 10)],  # the first hour is closed
        [(7, 70, "pv", 11), (7, 60 * hour, "pv", 12)],
        [(8, 80, "pv", 13), (8, 3 * hour, "pv", 14)],
        [(None, None, "pv", 15)],
    ]
    for i, rows in enumerate(batches):
        run(batch(rows), i)
        if i == 1:
            run(batch(rows), i)
    assert got[:6] == [[(1, 1), (2, 2), (3, 2)], [(4, 3)], [(4, 3)], [(6, 4)], [(9, 1), (10, 1)], [(12, 1)]]
    assert got[6:] in ([], [[]])  # two days back: all closed


def test_one_timer_a_key(spark):
    """Open starts of one key time out at their own deadlines, over triggers."""
    d, name = tempfile.mkdtemp(prefix="tm-timer-"), "timer" + uuid.uuid4().hex[:6]
    src = wm.ascending(logs.read_log_stream(spark, "order", d, seq="seq", maxFilesPerTrigger=1), "ts_s")
    found = sp.stream_followed_by(src, key="order_id", seq="seq", first=F.col("event_type") == "create",
                                  second=F.col("event_type") == "pay", within="10 seconds")
    q = sinks.write_stream(found.select("order_id", "status", "first_t", "second_t"), name, fmt="memory",
                           checkpoint=tempfile.mkdtemp(prefix="tm-ck-"))
    try:
        for i, chunk in enumerate([["1,create,,100", "1,create,,104", "1,other,,105"], ["1,create,,109", "2,other,,111"],
                                   ["1,pay,x,112", "2,create,,113"], ["9,other,,130"], ["9,other,,131"]]):
            with open(os.path.join(d, f"{i:03d}"), "w") as f:
                f.write("\n".join(chunk) + "\n")
            q.processAllAvailable()
        got = sorted((r.order_id, r.status, r.first_t // 1000, r.second_t and r.second_t // 1000) for r in spark.table(name).collect())
    finally:
        q.stop()
    assert got == [(1, "matched", 104, 112), (1, "matched", 109, 112), (1, "timeout", 100, None), (2, "timeout", 113, None)]


def test_stream_job_plans(spark):
    from trailmark.plans import streams
    d = _folder(("login", _read("login_log.csv") + ["1,0.0.0.0,success,1558500000"]))
    df, each = streams.login_fail(spark, d)
    assert each is None
    got = sorted(tuple(r) for r in spark.table(_run(spark, df)).collect())
    assert got == [(1035, 1558430842, 1558430843, "1035连续登陆失败两次"),
                   (1035, 1558430843, 1558430844, "1035连续登陆失败两次")]


def _split_run(spark, make, folders_and_parts):
    """Run a stream whose files arrive one part per trigger."""
    name = "q" + uuid.uuid4().hex[:8]
    q = sinks.write_stream(make(), name, fmt="memory", checkpoint=tempfile.mkdtemp(prefix="tm-ck-"))
    try:
        for i in range(max(len(parts) for _, parts in folders_and_parts)):
            for folder, parts in folders_and_parts:
                if i < len(parts):
                    with open(os.path.join(folder, f"{i:03d}"), "w") as f:
                        f.write("\n".join(parts[i]) + "\n")
            q.processAllAvailable()
        left = q.lastProgress["stateOperators"][-1]["numRowsTotal"] if q.lastProgress["stateOperators"] else 0
    finally:
        q.stop()
    return spark.table(name), left


def test_equal_seconds_over_triggers(spark):
    """A row at the newest time of the trigger before is not late."""
    from trailmark.plans import streams
    orders, receipts = tempfile.mkdtemp(prefix="tm-o-"), tempfile.mkdtemp(prefix="tm-r-")
    parts = [["1,create,,1000"], ["1,pay,tx1,1000"], ["9,pay,zz,9999999"]]
    got, _ = _split_run(spark, lambda: streams.order_timeout(spark, orders)[0], [(orders, parts)])
    assert [(r.order_id, r.result_msg) for r in got.collect()] == [(1, "payed successfully")]
    orders = tempfile.mkdtemp(prefix="tm-o-")
    got, _ = _split_run(spark, lambda: streams.tx_match(spark, orders, receipts)[0],
                        [(orders, parts), (receipts, [["x,w,1"], ["tx1,w,1000"], ["yy,w,9999999"]])])
    assert ("tx1", "matched") in {(r.tx_id, r.status) for r in got.collect()}


def test_strict_next_state_is_released(spark):
    from trailmark.plans import streams
    d = tempfile.mkdtemp(prefix="tm-l-")
    parts = [[f"{u},x,{'fail' if u % 2 else 'success'},1000" for u in range(300)], ["-1,x,success,900000"],
             ["-1,x,success,1800000"]]
    got, left = _split_run(spark, lambda: streams.login_fail(spark, d)[0], [(d, parts)])
    assert got.count() == 0 and left <= 4  # the last row only: its buffer, timer and mark
