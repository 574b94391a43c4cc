"""The reference's nine jobs as Structured Streaming plans over folders (or
any streaming DataFrame of lines), with the reference's watermarks:
ascending time for behaviour and order logs, 1 s out of order plus 1 min
allowed lateness for the access log, 5 s out of order for the login log.

Each function returns ``(stream_df, foreach_batch)``: start ``stream_df``
with ``foreach_batch`` when it is not None (the per-window top-N and
reports), else with any sink; output modes: append, except page views,
unique visitors and refining hot URLs (update: the newest count per window
on every trigger).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.text import login_fail_message
from trailmark.sources import logs
from trailmark.streaming import matching as sm
from trailmark.streaming import patterns as sp
from trailmark.streaming import watermarks as wm
from trailmark.streaming import windows as sw

Sink = Callable[[DataFrame, int], None]


def _read(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Lines with ``seq``, their arrival order: it breaks ties of equal seconds."""
    return logs.read_log_stream(spark, kind, path, seq="seq")


def _views(spark, path):
    """All rows drive the watermark; views are picked behind it."""
    return wm.where_behind(wm.ascending(_read(spark, "behavior", path), "ts_s"), F.col("behavior") == "pv")


def hot_items(spark, path, *, n: int = 3, sink: Sink, report: bool = True):
    """J-A: views per item, 1 h every 5 min, top ``n`` per closed window."""
    counts = sw.stream_window_counts(_views(spark, path), keys="item_id", size="1 hour",
                                     slide="5 minutes", panes=True)
    return counts, sw.top_n_each_batch(counts, key="item_id", n=n,
                                       report="items" if report else None, sink=sink)


def hot_urls(spark, path, *, n: int = 5, sink: Sink, report: bool = True, table: str | None = None):
    """J-B: hits per URL, 10 min every 5 s, 1 s out of order, 1 min lateness.

    With a ``table`` (a path for its state) a window is ranked when its
    counts change and again for every late row, as the reference re-fires
    it; start it in update mode.  Without, a window is ranked once, when it
    is final."""
    src = wm.with_event_time(_read(spark, "access", path), "event_ms", unit="ms",
                             delay="1 second", lateness="1 minute")
    counts = sw.stream_window_counts(src, keys="url", size="10 minutes", slide="5 seconds",
                                     panes=table is None)
    style = "urls" if report else None
    if table:
        return counts, sw.refining_top_n_each_batch(key="url", n=n, table=table, report=style, sink=sink,
                                                    keep="12 minutes")
    return counts, sw.top_n_each_batch(counts, key="url", n=n, report=style, sink=sink)


def page_views(spark, path):
    """J-C: views per hour (update mode)."""
    return sw.stream_page_views(_views(spark, path)), None


def unique_visitors(spark, path, *, bitmap: bool = False):
    """J-D: distinct users (or bit offsets) per hour (update mode)."""
    return sw.stream_unique_count(_views(spark, path), user="user_id", bitmap=bitmap), None


def running_unique_visitors(spark, path, *, table: str, sink: Sink):
    """J-E: one row per view with the bitmap count so far.  ``table`` is the
    path of the offsets seen; windows older than a day leave it.  All rows
    drive the watermark, rows of closed windows are dropped."""
    return wm.ascending(_read(spark, "behavior", path), "ts_s"), sw.running_unique_each_batch(
        seen_table=table, only=F.col("behavior") == "pv", user="user_id", ts="ts_s", seq=F.col("seq"), keep=["user_id", "ts_s", "seq"],
        forget="1 day", sink=sink)


def login_fail(spark, path, *, within="2 seconds"):
    """J-F: Warning rows for two adjacent fails of a user within the bound."""
    src = wm.bounded_out_of_order(_read(spark, "login", path), "ts_s", "5 seconds")
    pairs = sp.stream_strict_next(src, key="user_id", seq="seq", first=F.col("event_type") == "fail",
                                  second=F.col("event_type") == "fail", within=within)
    return pairs.select("user_id",
                        (F.col("first_t") / 1000).cast("long").alias("first_fail_time"),
                        (F.col("second_t") / 1000).cast("long").alias("last_fail_time"),
                        login_fail_message(F.col("user_id")).alias("warn_message")), None


def order_timeout(spark, path, *, within="15 minutes"):
    """J-G: one row per create: ``payed successfully`` or ``timeout`` (at the
    deadline)."""
    src = wm.ascending(_read(spark, "order", path), "ts_s")
    out = sp.stream_followed_by(src, key="order_id", seq="seq", first=F.col("event_type") == "create",
                                second=F.col("event_type") == "pay", within=within)
    return sp.stream_order_results(out), None


def _pays_receipts(spark, orders_path, receipts_path):
    pays = wm.where_behind(wm.ascending(_read(spark, "order", orders_path), "ts_s"), F.col("tx_id") != "")
    return pays, wm.ascending(_read(spark, "receipt", receipts_path), "ts_s")


def tx_match(spark, orders_path, receipts_path, *, bound="5 seconds"):
    """J-H: consuming one-to-one reconciliation with status."""
    pays, recs = _pays_receipts(spark, orders_path, receipts_path)
    return sp.stream_reconcile_one_to_one(pays, recs, key="tx_id", seq="seq", bound=bound,
                                          pay_carry=["order_id"],
                                          receipt_carry=["pay_channel"]), None


def tx_interval_join(spark, orders_path, receipts_path, *, lower="-5 seconds",
                     upper="5 seconds"):
    """J-I: all (pay, receipt) pairs of a txId within the band."""
    pays, recs = _pays_receipts(spark, orders_path, receipts_path)
    return sm.stream_interval_join(pays, recs, left_key="tx_id", right_key="tx_id",
                                   lower=lower, upper=upper, left_carry=["order_id"],
                                   right_carry=["pay_channel"]), None
