"""The operators applied to the driver's ``events`` table.

Mapping (survey section 7.4): item / user / order key -> ``user_id``,
behaviour -> ``event_type``, ``pv`` -> ``'view'``, arrival order ->
``event_id`` (unique, follows ``ts``).  Event time is ``ts``
(TIMESTAMP_NTZ, microseconds); all times are returned as epoch integers
(window ends in ms, event times in us) so results compare exactly with
any other engine.  Every query reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions import time as tf
from trailmark.functions.time import epoch_micros
from trailmark.operators import filters, matching, one_to_one, panes, patterns, topn, uniques, windows
from trailmark.sources import logs

VIEW = "view"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _us(df: DataFrame) -> DataFrame:
    """Add ``ts_us`` (epoch microseconds of ``ts``)."""
    return df.withColumn("ts_us", epoch_micros(df, "ts"))


def _seconds(df: DataFrame):
    us = epoch_micros(df, "ts")
    return ((us - F.pmod(us, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


# --- J-A hot items: views, 1 h every 5 min, top 3 ---------------------------------

HOT_ITEMS = dict(size="1 hour", slide="5 minutes", n=3)
HOT_URLS = dict(size="10 minutes", slide="5 seconds", n=5)


def hot_items_counts(spark, sf_dir):
    ev = filters.filter_behavior(events(spark, sf_dir), VIEW, col="event_type")
    return windows.window_counts(ev, keys="user_id", ts="ts", size=HOT_ITEMS["size"],
                                 slide=HOT_ITEMS["slide"])


def hot_items_topn(spark, sf_dir):
    return topn.top_n(hot_items_counts(spark, sf_dir), key="user_id", n=HOT_ITEMS["n"])


def hot_items_report(spark, sf_dir):
    return topn.ranked_report(hot_items_topn(spark, sf_dir), key="user_id", style="items")


# --- J-B hot URLs: all rows, 10 min every 5 s, top 5 -------------------------------

def hot_urls_counts(spark, sf_dir):
    return windows.window_counts(events(spark, sf_dir), keys="user_id", ts="ts",
                                 size=HOT_URLS["size"], slide=HOT_URLS["slide"])


def hot_urls_topn(spark, sf_dir):
    return topn.top_n(hot_urls_counts(spark, sf_dir), key="user_id", n=HOT_URLS["n"])


def hot_urls_report(spark, sf_dir):
    return topn.ranked_report(hot_urls_topn(spark, sf_dir), key="user_id", style="urls")


# --- J-C / J-D / J-E page views and unique visitors --------------------------------

def _views(spark, sf_dir):
    return filters.filter_behavior(events(spark, sf_dir), VIEW, col="event_type")


def page_views(spark, sf_dir):
    return windows.keyed_window_sum(_views(spark, sf_dir), ts="ts", size="1 hour", label="pv")


def unique_visitors(spark, sf_dir):
    return uniques.unique_count(_views(spark, sf_dir), user="user_id", ts="ts", size="1 hour")


def unique_visitors_bitmap(spark, sf_dir):
    return uniques.bitmap_unique_count(_views(spark, sf_dir), user="user_id", ts="ts",
                                       size="1 hour")


def running_unique_visitors(spark, sf_dir):
    return uniques.running_unique_count(_views(spark, sf_dir), user="user_id", ts="ts",
                                        size="1 hour", seq="event_id", keep=["event_id"])


def truncated_average(spark, sf_dir):
    ev = events(spark, sf_dir)
    return uniques.truncated_average(ev.select("user_id", _seconds(ev).alias("ts_s")),
                                     key="user_id", value="ts_s", out="avg_ts_s")


def _spread(spark, sf_dir, size, slide):
    aggs = {"n": panes.count_of(), "first_event_id": panes.min_of("event_id"), "last_event_id": panes.max_of("event_id")}
    return windows.window_aggregate(events(spark, sf_dir), keys="event_type", ts="ts", size=size, slide=slide,
                                    aggs=aggs)


def window_aggregate_sliding(spark, sf_dir):
    """Any aggregates per key and sliding window, 1 h every 15 min."""
    return _spread(spark, sf_dir, "1 hour", "15 minutes")


def window_aggregate_gaps(spark, sf_dir):
    """The same with a slide above the size: most rows lie in no window."""
    return _spread(spark, sf_dir, "10 minutes", "30 minutes")


def window_aggregate_dense(spark, sf_dir):
    """Sum, minimum, maximum and mean per event type, 10 min every 5 s: 120 windows
    overlap a row, which is aggregated once."""
    aggs = {"n": panes.count_of(), "id_sum": panes.sum_of("event_id"), "least": panes.min_of("value"),
            "most": panes.max_of("value"), "id_mean": panes.avg_of("event_id")}
    return windows.window_aggregate(events(spark, sf_dir), keys="event_type", ts="ts", size=HOT_URLS["size"],
                                    slide=HOT_URLS["slide"], aggs=aggs)


# --- J-F login failures: error followed directly by error, < 1 h -------------------

def login_fail_pairs(spark, sf_dir):
    ev = _us(events(spark, sf_dir))
    pairs = patterns.strict_next(ev, key="user_id", ts="ts", seq="event_id",
                                 first=F.col("event_type") == "error",
                                 second=F.col("event_type") == "error",
                                 within="1 hour", carry=["ts_us"])
    return patterns.login_fail_alerts(pairs, user="user_id", first_time="first_ts_us",
                                      last_time="second_ts_us")


# --- J-G order timeout: signup followed by purchase, < 24 h ------------------------

def _order_outcomes(spark, sf_dir):
    ev = _us(events(spark, sf_dir))
    out = patterns.followed_by(ev, key="user_id", ts="ts", seq="event_id",
                               first=F.col("event_type") == "signup",
                               second=F.col("event_type") == "purchase",
                               within="24 hours", carry=["event_id", "ts_us"],
                               prefixes=("create_", "pay_"))
    return patterns.order_results(out).select(
        F.col("user_id").alias("order_id"), "create_event_id", F.col("create_ts_us").alias("create_time"),
        "pay_event_id", F.col("pay_ts_us").alias("pay_time"), "result_msg")


def order_results(spark, sf_dir):
    return _order_outcomes(spark, sf_dir)


def order_paid(spark, sf_dir):
    return _order_outcomes(spark, sf_dir).where(F.col("result_msg") == "payed successfully")


def order_timeout(spark, sf_dir):
    return _order_outcomes(spark, sf_dir).where(F.col("result_msg") == "timeout")


# --- J-H / J-I pay vs receipt: click vs purchase, same user, +-60 min --------------

def _tx_sides(spark, sf_dir):
    ev = _us(events(spark, sf_dir)).select("event_id", "user_id", "ts", "ts_us", "event_type")
    pays = ev.where(F.col("event_type") == "click")
    receipts = ev.where(F.col("event_type") == "purchase")
    return pays, receipts


_TX = dict(left_key="user_id", right_key="user_id", left_ts="ts", right_ts="ts",
           lower="-60 minutes", upper="60 minutes", left_carry=["event_id", "ts_us"],
           right_carry=["event_id", "ts_us"], key_out="user_id")


def tx_interval_join(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    return matching.interval_join(pays, receipts, **_TX)


def tx_reconcile(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    return matching.reconcile(pays, receipts, **_TX)


def tx_match_one_to_one(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    how = {k: v for k, v in _TX.items() if k not in ("lower", "upper")}
    return one_to_one.reconcile_one_to_one(pays, receipts, bound="60 minutes", left_seq="event_id", right_seq="event_id", **how)


# Each single output of the reconciliation has its own one-join plan.

def tx_matched(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    return matching.interval_join(pays, receipts, **_TX).withColumn(
        "status", F.lit(matching.MATCHED))


def tx_unmatched_pays(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    return matching.unmatched(pays, receipts, side="left", **_TX)


def tx_unmatched_receipts(spark, sf_dir):
    pays, receipts = _tx_sides(spark, sf_dir)
    return matching.unmatched(pays, receipts, side="right", **_TX)


# --- P1 / P2 / E1 / E2 -------------------------------------------------------------

def filter_views(spark, sf_dir):
    ev = _us(events(spark, sf_dir))
    return filters.filter_behavior(ev, VIEW, col="event_type").select(
        "event_id", "user_id", "event_type", "value", "ts_us")


def _tx_ids(ev: DataFrame):
    return F.when(F.col("event_type") == "purchase",
                  F.concat(F.lit("tx"), F.col("event_id").cast("string"))).otherwise(F.lit(""))


def filter_nonempty_key(spark, sf_dir):
    ev = events(spark, sf_dir)
    return filters.filter_nonempty_key(ev.select("event_id", _tx_ids(ev).alias("tx_id")), "tx_id")


def event_time_seconds(spark, sf_dir):
    ev = events(spark, sf_dir)
    s = ev.select("event_id", _seconds(ev).alias("ts_s"))
    return s.select("event_id", "ts_s",
                    F.unix_millis(tf.event_time_seconds("ts_s")).alias("event_time_ms"))


def event_time_millis(spark, sf_dir):
    ev = events(spark, sf_dir)
    us = epoch_micros(ev, "ts")
    ms = ev.select("event_id", ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("long")
                   .alias("ts_ms"))
    return ms.select("event_id", "ts_ms",
                     F.unix_micros(tf.event_time_millis("ts_ms")).alias("event_time_us"))


# --- S1, S3-S6: log lines rendered from events, parsed back -----------------------
# Fields are padded with spaces and tabs around the separators (the access
# log, whose separator is the space, with tabs), and trailing empty fields
# follow, so the parsers' trimming is exercised on every row of every kind.

def _lines(df: DataFrame, *cols, sep: str = "\t, ", end: str = " \t,,") -> DataFrame:
    return df.select(F.concat(F.concat_ws(sep, *[c.cast("string") for c in cols]), F.lit(end)).alias("value"))


def scan_behavior_log(spark, sf_dir):
    ev = events(spark, sf_dir)
    lines = _lines(ev, F.col("user_id"), F.col("event_id"), F.length("props"),
                   F.col("event_type"), _seconds(ev))
    return logs.parse_behavior_lines(lines)


def scan_access_log(spark, sf_dir):
    ev = events(spark, sf_dir)
    lines = _lines(
        ev, F.concat(F.lit("192.168.0."), F.col("user_id").cast("string"), F.lit("\t")),
        F.concat(F.lit("\tu"), F.col("user_id").cast("string")), F.lit("-"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.upper("event_type"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"), F.lit("\t")),
        sep=" ", end="  ")
    return logs.parse_access_lines(lines)


def scan_login_log(spark, sf_dir):
    ev = events(spark, sf_dir)
    kind = F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success"))
    lines = _lines(ev, F.col("user_id"), F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
                   kind, _seconds(ev))
    return logs.parse_login_lines(lines)


def scan_order_log(spark, sf_dir):
    ev = events(spark, sf_dir)
    kind = F.when(F.col("event_type") == "purchase", F.lit("pay")).otherwise(F.lit("create"))
    lines = _lines(ev, F.col("user_id"), kind, _tx_ids(ev), _seconds(ev))
    return logs.parse_order_lines(lines)


def scan_receipt_log(spark, sf_dir):
    ev = events(spark, sf_dir)
    channel = F.when(F.col("value") < 25, F.lit("wechat")).otherwise(F.lit("alipay"))
    lines = _lines(ev, F.concat(F.lit("tx"), F.col("event_id").cast("string")), channel,
                   _seconds(ev))
    return logs.parse_receipt_lines(lines)


QUERIES = {
    "hot_items_counts": hot_items_counts,
    "hot_items_topn": hot_items_topn,
    "hot_items_report": hot_items_report,
    "hot_urls_counts": hot_urls_counts,
    "hot_urls_topn": hot_urls_topn,
    "hot_urls_report": hot_urls_report,
    "page_views": page_views,
    "unique_visitors": unique_visitors,
    "unique_visitors_bitmap": unique_visitors_bitmap,
    "running_unique_visitors": running_unique_visitors,
    "truncated_average": truncated_average,
    "window_aggregate_sliding": window_aggregate_sliding,
    "window_aggregate_gaps": window_aggregate_gaps,
    "window_aggregate_dense": window_aggregate_dense,
    "login_fail_pairs": login_fail_pairs,
    "order_paid": order_paid,
    "order_timeout": order_timeout,
    "order_results": order_results,
    "tx_interval_join": tx_interval_join,
    "tx_reconcile": tx_reconcile,
    "tx_match_one_to_one": tx_match_one_to_one,
    "tx_matched": tx_matched,
    "tx_unmatched_pays": tx_unmatched_pays,
    "tx_unmatched_receipts": tx_unmatched_receipts,
    "filter_views": filter_views,
    "filter_nonempty_key": filter_nonempty_key,
    "event_time_seconds": event_time_seconds,
    "event_time_millis": event_time_millis,
    "scan_behavior_log": scan_behavior_log,
    "scan_access_log": scan_access_log,
    "scan_login_log": scan_login_log,
    "scan_order_log": scan_order_log,
    "scan_receipt_log": scan_receipt_log,
}
