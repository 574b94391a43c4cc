"""The reference's nine jobs as batch plans over parsed log records.

Inputs are the DataFrames of :mod:`trailmark.sources.logs` (with the
arrival ``seq`` column); times are epoch seconds (``ts_s``) except the
access log's ``event_ms``.  Each function returns the job's output
DataFrame(s); the streaming forms are in :mod:`trailmark.streaming`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators import filters, matching, patterns, topn, uniques, windows
from trailmark.operators.durations import duration_micros
from trailmark.operators.one_to_one import reconcile_one_to_one


def hot_items(behavior: DataFrame, *, n: int = 3, size="1 hour", slide="5 minutes",
              behavior_value: str = "pv", report: bool = True) -> DataFrame:
    """J-A: top ``n`` items by view count per sliding window."""
    views = filters.filter_behavior(behavior, behavior_value)
    counts = windows.window_counts(views, keys="item_id", ts="ts_s", unit="s", size=size,
                                   slide=slide)
    best = topn.top_n(counts, key="item_id", n=n)
    return topn.ranked_report(best, key="item_id", style="items") if report else best


def hot_urls(access: DataFrame, *, n: int = 5, size="10 minutes", slide="5 seconds",
             report: bool = True) -> DataFrame:
    """J-B: top ``n`` URLs by hits per sliding window (batch: every row counts;
    lateness only matters for the streaming form)."""
    counts = windows.window_counts(access, keys="url", ts="event_ms", unit="ms", size=size,
                                   slide=slide)
    best = topn.top_n(counts, key="url", n=n)
    return topn.ranked_report(best, key="url", style="urls") if report else best


def page_views(behavior: DataFrame, *, size="1 hour", behavior_value: str = "pv") -> DataFrame:
    """J-C: views per tumbling window (``pv``, window_end, count)."""
    return windows.keyed_window_sum(filters.filter_behavior(behavior, behavior_value),
                                    ts="ts_s", size=size, label="pv")


def unique_visitors(behavior: DataFrame, *, size="1 hour",
                    behavior_value: str = "pv") -> DataFrame:
    """J-D: exact distinct users per tumbling window."""
    return uniques.unique_count(filters.filter_behavior(behavior, behavior_value),
                                user="user_id", ts="ts_s", size=size)


def unique_visitors_bitmap(behavior: DataFrame, *, size="1 hour", behavior_value: str = "pv",
                           running: bool = True) -> DataFrame:
    """J-E: distinct bit offsets per window; ``running=True`` gives the
    reference's one-row-per-event running count, else the final count."""
    views = filters.filter_behavior(behavior, behavior_value)
    if running:
        return uniques.running_unique_count(views, user="user_id", ts="ts_s", size=size,
                                            seq="seq", keep=["user_id", "ts_s", "seq"])
    return uniques.bitmap_unique_count(views, user="user_id", ts="ts_s", size=size)


def login_fail(login: DataFrame, *, within="2 seconds") -> DataFrame:
    """J-F: two adjacent ``fail`` events of a user less than ``within`` apart."""
    pairs = patterns.strict_next(login, key="user_id", ts="ts_s", seq="seq",
                                 first=F.col("event_type") == "fail",
                                 second=F.col("event_type") == "fail",
                                 within=within, carry=["ts_s", "ip"])
    return patterns.login_fail_alerts(pairs, user="user_id", first_time="first_ts_s",
                                      last_time="second_ts_s")


def order_timeout(orders: DataFrame, *, within="15 minutes") -> DataFrame:
    """J-G: every ``create`` with its outcome: ``payed successfully`` when a
    ``pay`` of the order follows within the bound, else ``timeout``."""
    out = patterns.followed_by(orders, key="order_id", ts="ts_s", seq="seq",
                               first=F.col("event_type") == "create",
                               second=F.col("event_type") == "pay",
                               within=within, carry=["ts_s", "tx_id"],
                               prefixes=("create_", "pay_"))
    return patterns.order_results(out)


def _tx_kwargs(lower, upper):
    return dict(left_key="tx_id", right_key="tx_id", left_ts="ts_s", right_ts="ts_s",
                lower=lower, upper=upper, left_carry=["order_id", "ts_s"],
                right_carry=["pay_channel", "ts_s"], key_out="tx_id")


def tx_match(orders: DataFrame, receipts: DataFrame, *, lower="-5 seconds",
             upper="5 seconds", one_to_one: bool = False) -> DataFrame:
    """J-H: pays reconciled with receipts: ``status`` matched /
    unmatched_pay / unmatched_receipt.  With ``one_to_one`` (and the same
    bound on both sides) every row is used at most once, as the reference's
    keyed state does; both take a ``seq`` column for equal seconds."""
    pays = filters.filter_nonempty_key(orders, "tx_id")
    if one_to_one:
        how = _tx_kwargs(lower, upper)
        if duration_micros(how.pop("lower")) != -duration_micros(how.pop("upper")):
            raise ValueError("one_to_one needs the same bound on both sides")
        return reconcile_one_to_one(pays, receipts, bound=upper, left_seq="seq", right_seq="seq", **how)
    return matching.reconcile(pays, receipts, **_tx_kwargs(lower, upper))


def tx_interval_join(orders: DataFrame, receipts: DataFrame, *, lower="-5 seconds",
                     upper="5 seconds") -> DataFrame:
    """J-I: all (pay, receipt) pairs of a txId within the band."""
    pays = filters.filter_nonempty_key(orders, "tx_id")
    return matching.interval_join(pays, receipts, **_tx_kwargs(lower, upper))
