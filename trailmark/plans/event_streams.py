"""The stream operators applied to the driver's ``events`` table.

``events`` is read as a stream (``availableNow``: everything there, then
the batches that the advanced watermark still causes) into a table in the
shared checkpoint folder, which is returned.  The SQL of each query keeps
what the final watermark has closed; ``{wm}`` in it is that watermark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.time import epoch_micros
from trailmark.operators import topn
from trailmark.plans.events import events
from trailmark.plans.oracle_sql import ORACLE_SQL as BATCH_SQL
from trailmark.session import scratch_path
from trailmark.sources import sinks
from trailmark.streaming import matching as sm
from trailmark.streaming import patterns as sp
from trailmark.streaming import watermarks as wm
from trailmark.streaming import windows as sw


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


TRIGGERS = 3


def _source_in_parts(spark: SparkSession, sf_dir: str, place: str) -> DataFrame:
    """``events`` cut at two times into files, one for each trigger."""
    rows = events(spark, sf_dir)
    us = epoch_micros(rows, "ts")
    low, high = rows.select(F.min(us), F.max(us)).first()
    step = ((high or 0) - (low or 0)) // TRIGGERS + 1
    for i in range(TRIGGERS):
        own = rows.where((us >= (low or 0) + i * step) & (us < (low or 0) + (i + 1) * step))
        own.coalesce(1).write.mode("append").parquet(f"{place}/in")
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false")
            .parquet(f"{place}/in"))


def _of_type(stream: DataFrame, kind: str) -> DataFrame:
    """Events of one type; all events drive the watermark."""
    return wm.where_behind(wm.ascending(stream, "ts"), F.col("event_type") == kind)


def _place(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _run(df: DataFrame, place: str, *, mode: str = "append", each_batch=None) -> None:
    """Run the stream until all there is has been read, results in ``place/out``."""
    out = f"{place}/out"
    sink = {"foreach_batch": each_batch} if each_batch else {"fmt": "parquet", "path": out}
    query = sinks.write_stream(df, f"q{uuid.uuid4().hex}", output_mode=mode, checkpoint=f"{place}/query",
                               trigger={"availableNow": True}, **sink)
    query.awaitTermination()


def _result(spark: SparkSession, place: str, schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.read.schema(schema).parquet(f"{place}/out").select(*names)


def stream_hot_items_topn(spark, sf_dir):
    """W1, A1, T1 on a stream: views per user, 1 h every 5 min, top 3."""
    place = _place(spark, "hot-items")
    views = _of_type(_source(spark, sf_dir), "view")
    counts = sw.stream_window_counts(views, keys="user_id", size="1 hour", slide="5 minutes", panes=True)
    _run(counts, place, each_batch=sw.top_n_each_batch(counts, key="user_id", n=3,
                                                       sink=sinks.append_batches(f"{place}/out")))
    return _result(spark, place, "window_end long, rank long, user_id long, count long")


def stream_unique_visitors(spark, sf_dir):
    """A3 and S8 on a stream: users per hour, the newest count of a window
    replaces the one before."""
    place = _place(spark, "unique")
    views = _of_type(_source(spark, sf_dir), "view")
    counts = sw.stream_unique_count(views, user="user_id")
    _run(counts, place, mode="update", each_batch=sinks.upsert_by_window(f"{place}/out"))
    return _result(spark, place, "window_end long, uv_count long")


def stream_running_unique(spark, sf_dir):
    """A5 on a stream: one row per view with the bitmap count so far."""
    place = _place(spark, "running")
    views = wm.ascending(_source_in_parts(spark, sf_dir, place), "ts")
    each = sw.running_unique_each_batch(only=F.col("event_type") == "view", seen_table=f"{place}/seen", user="user_id", ts="ts", seq=F.col("event_id"),
                                        keep=["event_id"], sink=sinks.append_batches(f"{place}/out"))
    _run(views, place, each_batch=each)
    return _result(spark, place, "window_end long, event_id long, uv_count long")


HELD_BACK, DELAY, LATENESS = 10, "1 second", "1 minute"


def stream_late_counts(spark, sf_dir):
    """E4 to E6 on a stream: the first half of the time comes first, but for
    every tenth event of it, which comes with the second half.  Late events
    count in windows that are still open within delay and lateness and are
    dropped from closed ones."""
    place = _place(spark, "late")
    rows = events(spark, sf_dir).select("event_id", "ts")
    us = epoch_micros(rows, "ts")
    low, high = rows.select(F.min(us), F.max(us)).first()
    half = ((low or 0) + (high or 0)) // 2
    early = (us < half) & (F.col("event_id") % HELD_BACK != 0)
    for part in (rows.where(early), rows.where(~early)):  # two triggers of one query
        part.write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in")
        timed = wm.with_event_time(stream, "ts", delay=DELAY, lateness=LATENESS)
        _run(sw.stream_window_counts(timed, keys=[], size="10 minutes"), place)
    return _result(spark, place, "window_end long, count long")


def stream_login_fail(spark, sf_dir):
    """C1, ST1 to ST3 on a stream: error directly followed by error, < 1 h."""
    place = _place(spark, "login")
    source = wm.bounded_out_of_order(_source_in_parts(spark, sf_dir, place), "ts", "5 seconds")
    is_error = F.col("event_type") == "error"
    pairs = sp.stream_strict_next(source, key="user_id", seq="event_id", first=is_error, second=is_error,
                                  within="1 hour")
    _run(pairs.select("user_id", "first_t", "second_t"), place)
    return _result(spark, place, "user_id long, first_t long, second_t long")


def stream_order_results(spark, sf_dir):
    """C3 to C6, ST1 to ST3 on a stream: signup followed by purchase, < 24 h."""
    place = _place(spark, "order")
    source = wm.ascending(_source_in_parts(spark, sf_dir, place), "ts")
    found = sp.stream_followed_by(source, key="user_id", seq="event_id", first=F.col("event_type") == "signup",
                                  second=F.col("event_type") == "purchase", within="24 hours")
    _run(sp.stream_order_results(found).select("user_id", "first_t", "second_t", "result_msg"), place)
    return _result(spark, place, "user_id long, first_t long, second_t long, result_msg string")


def _sides(spark, sf_dir):
    return _of_type(_source(spark, sf_dir), "click"), _of_type(_source(spark, sf_dir), "purchase")


_BAND = dict(left_key="user_id", right_key="user_id", lower="-60 minutes", upper="60 minutes",
             left_carry=["event_id"], right_carry=["event_id"])


def stream_tx_interval_join(spark, sf_dir):
    """J1, J2 on a stream: click and purchase of a user within 60 min."""
    place = _place(spark, "join")
    _run(sm.stream_interval_join(*_sides(spark, sf_dir), **_BAND).select("pay_event_id", "receipt_event_id"), place)
    return _result(spark, place, "pay_event_id long, receipt_event_id long")


def stream_tx_reconcile(spark, sf_dir):
    """J3 to J6 on a stream: the same as full outer join with a status."""
    place = _place(spark, "reconcile")
    found = sm.stream_reconcile(*_sides(spark, sf_dir), **_BAND)
    _run(found.select("pay_event_id", "receipt_event_id", "status"), place)
    return _result(spark, place, "pay_event_id long, receipt_event_id long, status string")


def stream_tx_match(spark, sf_dir):
    """J3 on a stream with its own form of state (ST2): click and purchase of
    a user within 60 min, each row used at most once."""
    place = _place(spark, "match")
    source = _source_in_parts(spark, sf_dir, place)
    pays, receipts = _of_type(source, "click"), _of_type(source, "purchase")
    found = sp.stream_reconcile_one_to_one(pays, receipts, key="user_id", seq="event_id", bound="60 minutes",
                                           pay_carry=["event_id"], receipt_carry=["event_id"])
    number = lambda c: F.get_json_object(c, "$.event_id").cast("long")
    _run(found.select(number("pay_payload").alias("pay_event_id"), number("receipt_payload").alias("receipt_event_id"),
                      "status"), place)
    return _result(spark, place, "pay_event_id long, receipt_event_id long, status string")


QUERIES = {f.__name__: f for f in (
    stream_hot_items_topn, stream_unique_visitors, stream_running_unique, stream_late_counts, stream_login_fail,
    stream_order_results, stream_tx_interval_join, stream_tx_reconcile, stream_tx_match)}

# Watermarks are in milliseconds: the newest event's, less the delay.
_MS = "(epoch_us(ts::timestamp) // 1000)"


def _watermark(delay_ms: int) -> str:
    return f"(SELECT max({_MS}) - {delay_ms} FROM events)"


ORACLE_SQL = {
    "stream_hot_items_topn": f"""
        WITH w AS (
            SELECT user_id, unnest(generate_series({_MS} // 300000 * 300000 + 300000,
                                                   {_MS} // 300000 * 300000 + 3600000, 300000)) AS window_end
            FROM events WHERE event_type = 'view'),
        c AS (SELECT window_end, user_id, count(*) AS count FROM w GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, user_id) AS rank FROM c)
        SELECT window_end, rank, user_id, count FROM r WHERE rank <= 3 AND window_end <= {_watermark(1)}""",
    "stream_unique_visitors": f"""
        SELECT {_MS} // 3600000 * 3600000 + 3600000 AS window_end, count(DISTINCT user_id) AS uv_count
        FROM events WHERE event_type = 'view' GROUP BY 1""",
    "stream_late_counts": f"""
        WITH bounds AS (SELECT (min(epoch_us(ts::timestamp)) + max(epoch_us(ts::timestamp))) // 2 AS half FROM events),
        e AS (SELECT {_MS} AS t, {_MS} // 600000 * 600000 + 600000 AS window_end,
                     epoch_us(ts::timestamp) < half AND event_id % {HELD_BACK} <> 0 AS early,
                     epoch_us(ts::timestamp) < half AS first_half FROM events, bounds),
        m AS (SELECT max(t) FILTER (early) - 61000 AS first_wm, max(t) - 61000 AS last_wm FROM e)
        SELECT window_end, count(*) AS count FROM e, m
        WHERE (early OR window_end > first_wm) AND window_end <= last_wm GROUP BY window_end""",
    "stream_login_fail": f"""
        WITH e AS (SELECT user_id, event_type, {_MS} AS t,
                          lead({_MS}) OVER o AS second_t, lead(event_type) OVER o AS second_type
                   FROM events WINDOW o AS (PARTITION BY user_id ORDER BY {_MS}, event_id))
        SELECT user_id, t AS first_t, second_t FROM e
        WHERE event_type = 'error' AND second_type = 'error' AND second_t - t < 3600000
          AND second_t <= {_watermark(5000)}""",
    "stream_order_results": f"""
        WITH e AS (SELECT user_id, event_type, {_MS} AS t, row_number() OVER (ORDER BY {_MS}, event_id) AS at FROM events),
        s AS (SELECT a.user_id, a.t AS first_t, a.at, min(b.at) AS next_at FROM e a LEFT JOIN e b
              ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.at > a.at
              WHERE a.event_type = 'signup' GROUP BY ALL),
        r AS (SELECT s.user_id, first_t, CASE WHEN e.t - first_t < 86400000 THEN e.t END AS second_t
              FROM s LEFT JOIN e ON e.at = next_at)
        SELECT user_id, first_t, second_t,
               CASE WHEN second_t IS NULL THEN 'timeout' ELSE 'payed successfully' END AS result_msg
        FROM r WHERE coalesce(second_t, first_t + 86400000) <= {_watermark(1)}""",
    # a row stays alone once the watermark has passed all it could meet
    "stream_tx_match": f"""
        SELECT pay_event_id, receipt_event_id, status FROM ({BATCH_SQL["tx_match_one_to_one"]})
        WHERE status = 'matched' AND greatest(pay_ts_us, receipt_ts_us) // 1000 <= {_watermark(1)}
           OR status <> 'matched' AND coalesce(pay_ts_us, receipt_ts_us) // 1000 + 3600000 <= {_watermark(1)}""",
    "stream_running_unique": BATCH_SQL["running_unique_visitors"],
    # rows without partner are final when the watermark has passed all they could meet
    "stream_tx_reconcile": f"""
        WITH p AS (SELECT event_id, user_id, ts, {_MS} AS t FROM events WHERE event_type = 'click'),
        r AS (SELECT event_id, user_id, ts, {_MS} AS t FROM events WHERE event_type = 'purchase'),
        j AS (SELECT p.event_id AS pay_event_id, p.t AS pay_t, r.event_id AS receipt_event_id, r.t AS receipt_t
              FROM p FULL JOIN r ON p.user_id = r.user_id
              AND r.ts BETWEEN p.ts - INTERVAL 60 MINUTE AND p.ts + INTERVAL 60 MINUTE)
        SELECT pay_event_id, receipt_event_id, CASE WHEN receipt_t IS NULL THEN 'unmatched_pay'
               WHEN pay_t IS NULL THEN 'unmatched_receipt' ELSE 'matched' END AS status
        FROM j WHERE (pay_t IS NOT NULL AND receipt_t IS NOT NULL)
           OR coalesce(pay_t, receipt_t) + 3600000 < {_watermark(1)}""",
    "stream_tx_interval_join": """
        SELECT p.event_id AS pay_event_id, r.event_id AS receipt_event_id FROM events p JOIN events r
        ON p.user_id = r.user_id AND p.event_type = 'click' AND r.event_type = 'purchase'
        AND r.ts BETWEEN p.ts - INTERVAL 60 MINUTE AND p.ts + INTERVAL 60 MINUTE""",
}
