"""Streaming window counts, top-N and unique counts.

Streams use ``F.window`` on the watermarked event-time column: the window
struct carries the watermark, so window state is evicted once a window is
final.  (The batch sweep of :mod:`trailmark.operators.windows` needs the
whole history of a key and has no streaming form.)
"""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.hashing import DEFAULT_CAP, DEFAULT_SEED
from trailmark.functions.time import epoch_micros
from trailmark.operators import topn
from trailmark.operators.durations import duration_micros, spark_interval
from trailmark.operators.uniques import user_offset
from trailmark.session import child_names, delete_path, path_exists, written_once
from trailmark.sources.sinks import append_batches
from trailmark.streaming.watermarks import EVENT_TIME, window_end_millis


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys or [])


def stream_window_counts(events: DataFrame, *, keys, size, slide=None,
                         event_time: str = EVENT_TIME, count_col: str = "count",
                         panes: bool = False) -> DataFrame:
    """Count per key and (sliding or tumbling) window of a watermarked stream.

    Output ``keys..., window_end, count``; in append mode each window is
    emitted once, after the watermark passes its end; in update mode every
    trigger re-emits the windows that changed.

    ``panes=True`` (append mode only, where Spark chains aggregations)
    counts each row once, in its pane of ``gcd(size, slide)``, and adds up
    the panes of a window, instead of counting every row in all
    ``size / slide`` windows that hold it.
    """
    keys = _keys(keys)
    slide = slide if slide is not None else size
    pane_us = gcd(duration_micros(size), duration_micros(slide))
    if panes and pane_us < duration_micros(size):
        pane = F.window(event_time, spark_interval(f"{pane_us} us"))
        events = (events.groupBy(pane.alias("pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
                  .select(F.window_time("pane").alias(event_time), *keys, "_n"))
        counted = F.sum("_n")
    else:
        counted = F.count(F.lit(1))
    w = F.window(event_time, spark_interval(size), spark_interval(slide))
    return (events.groupBy(w.alias("window"), *keys).agg(counted.alias(count_col))
            .select(*keys, window_end_millis("window").alias("window_end"), count_col))


def stream_page_views(events: DataFrame, *, size="1 hour", label: str = "pv",
                      event_time: str = EVENT_TIME) -> DataFrame:
    """A2 on a stream: views per tumbling window, labelled ``pv``."""
    counts = stream_window_counts(events, keys=[], size=size, event_time=event_time)
    return counts.select(F.lit(label).alias("key"), "window_end", "count")


def stream_unique_count(events: DataFrame, *, user: str, size="1 hour", bitmap: bool = False,
                        seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP,
                        event_time: str = EVENT_TIME, out: str = "uv_count") -> DataFrame:
    """A3 / A4 on a stream: distinct users (or bit offsets) per window.

    ``count(DISTINCT)`` is refused on streams; the exact form deduplicates
    (window, user) - state keyed by both, evicted with the window - and
    then counts rows per window.  In update mode each trigger emits the
    window's count so far (the bitmap job's running count, one row per
    window and trigger instead of per event).
    """
    ident = user_offset(events, user, seed, cap) if bitmap else F.col(user)
    w = F.window(event_time, spark_interval(size))
    dedup = (events.select(w.alias("window"), ident.alias("_u"))
             .dropDuplicates(["window", "_u"]))
    return (dedup.groupBy("window").agg(F.count(F.lit(1)).alias(out))
            .select(window_end_millis("window").alias("window_end"), out))


def top_n_each_batch(counts: DataFrame, *, key: str, n: int, report: str | None = None,
                     sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """T1-T3 on a stream, as a ``foreachBatch`` function.

    Ranking functions are refused on streams.  With the window counts in
    append mode, every window arrives complete in exactly one micro-batch,
    so the batch top-N (and report) of that micro-batch is final.  The
    returned function calls ``sink(result, batch_id)``.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        best = topn.top_n(batch, key=key, n=n)
        if report:
            best = topn.ranked_report(best, key=key, style=report)
        sink(best, batch_id)
    return run


def refining_top_n_each_batch(*, key: str, n: int, table: str, report: str | None = None,
                              sink: Callable[[DataFrame, int], None],
                              window_col: str = "window_end",
                              count_col: str = "count",
                              keep=None, part="10 minutes") -> Callable[[DataFrame, int], None]:
    """T2 under allowed lateness (E5), as a ``foreachBatch`` function for
    window counts in **update** mode.

    Update mode re-emits only the (window, key) counts a trigger changed, so
    ranking a micro-batch alone would rank only the late keys (the
    reference's quirk).  Here the latest count of every key is kept in a
    parquet table at ``table``, partitioned by ``part`` (stretches of window
    ends).  Each trigger reads the stretches it touched (a literal range of
    the partition column), merges its changes, replaces those stretches by
    dynamic partition overwrite and re-ranks exactly the windows it touched,
    completely.  The merged rows are written to the shared folder before the
    overwrite, since they are read from the same table.  Stretches that end
    more than ``keep`` before the newest window (at least size + delay +
    lateness) cannot change any more and leave the table.
    """
    part_ms = duration_micros(part) // 1000
    part_of = ((F.col(window_col) - F.pmod(F.col(window_col), F.lit(part_ms))).cast("long")).alias("part")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with written_once(batch.select(window_col, key, count_col)) as changed:
            first, newest = changed.select(F.min(window_col), F.max(window_col)).first()
            if newest is None:
                return
            merged = changed.select("*", part_of)
            if path_exists(spark, table):  # the first trigger has no table yet
                parts = F.broadcast(merged.select("part").distinct()) if newest - first < 1000 * part_ms \
                    else merged.select("part").distinct()
                old = (spark.read.parquet(table).where(F.col("part").between(first - part_ms, newest))
                       .join(parts, "part", "left_semi"))
                merged = (old.join(changed, [window_col, key], "left_anti")
                          .select(*merged.columns).unionByName(merged))
            with written_once(merged) as merged:
                (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("part").parquet(table))
                touched = merged.join(changed.select(window_col).distinct(), window_col, "left_semi")
                best = topn.top_n(touched, key=key, n=n, group=window_col, value=count_col)
                if report:
                    best = topn.ranked_report(best, key=key, style=report, group=window_col,
                                              value=count_col)
                sink(best, batch_id)
            if keep is not None:
                _expire(spark, table, "part", newest - duration_micros(keep) // 1000 - part_ms)
    return run


def _expire(spark, table: str, window_col: str, before: int) -> None:
    """Delete the partitions whose value lies before ``before`` (ms)."""
    for name in child_names(spark, table):
        column, _, value = name.partition("=")
        if column == window_col and value.lstrip("-").isdigit() and int(value) < before:
            delete_path(spark, f"{table}/{name}")


def _newest_before(spark, path: str, batch_id: int) -> int | None:
    if not path_exists(spark, path):
        return None
    return (spark.read.schema("newest long, batch_id long").parquet(path).where(F.col("batch_id") < batch_id)
            .agg(F.max("newest")).first()[0])


def _keep_newest(spark, path: str, batch_id: int, newest: int) -> None:
    append_batches(path)(spark.createDataFrame([(newest,)], "newest long"), batch_id)
    _expire(spark, path, "batch_id", batch_id - 1)


def running_unique_each_batch(*, seen_table: str, user: str, ts: str, size="1 hour",
                              seq=None, unit: str = "s", seed: int = DEFAULT_SEED,
                              cap: int = DEFAULT_CAP, keep=(), out: str = "uv_count",
                              sink: Callable[[DataFrame, int], None],
                              forget=None, only: Column | None = None, delay="1 ms") -> Callable[[DataFrame, int], None]:
    """A5 on a stream, one row per event (the bitmap job's output), as a
    ``foreachBatch`` function over the raw events.

    The per-window bitmap becomes a table at ``seen_table`` of the bit
    offsets already seen per window (partitioned by window).  Each
    micro-batch: first occurrences in the batch (partial ``min``), minus the
    offsets seen in earlier batches (anti join on the touched windows); the
    count before the batch is the number of seen offsets per window; each
    event gets that count plus the batch's new offsets up to it, in
    (time, ``seq``) order - the batch operator with a carried prior.  Rows
    are tagged with the batch id and earlier-batch rows only are read, so a
    replayed batch is counted once.  Events of a batch come after those of
    earlier batches (arrival order across batches, as the reference).
    Windows that end more than ``forget`` before the newest one leave the
    table.

    ``only`` picks the events that count while all rows drive the watermark,
    which stands ``delay`` behind the newest time of the earlier batches:
    events whose window it has closed are late and give no row (E6).  The
    newest time is kept beside the table, for the last batches only.
    """
    from trailmark.operators.uniques import event_offsets, running_with_prior

    size_us = duration_micros(size)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        order = seq if seq is not None else F.monotonically_increasing_id()
        times = f"{seen_table}.newest"
        before = _newest_before(spark, times, batch_id)
        here = batch.select(F.max(epoch_micros(batch, ts, unit))).first()[0]
        if here is None and before is None:
            return
        closed = (before - duration_micros(delay)) // 1000 if before is not None else None
        batch = batch if only is None else batch.where(only)
        _keep_newest(spark, times, batch_id, max(x for x in (before, here) if x is not None))
        with written_once(event_offsets(batch, user=user, ts=ts, size_us=size_us, seq=order,
                                        unit=unit, seed=seed, cap=cap, keep=keep)
                          .where(F.lit(True) if closed is None else F.col("window_end") > closed)) as rows:
            first, newest = rows.select(F.min("window_end"), F.max("window_end")).first()
            if newest is None:
                return
            seen = None
            if path_exists(spark, seen_table):  # the first batch has seen nothing yet
                # a literal range of the partition column prunes the windows read
                seen = (spark.read.schema("_h long, batch_id long, window_end long").parquet(seen_table)
                        .where(F.col("window_end").between(first, newest) & (F.col("batch_id") < batch_id))
                        .join(rows.select("window_end").distinct(), "window_end", "left_semi")
                        .select("window_end", "_h").distinct())
            result, new = running_with_prior(rows, seen, size_us=size_us, keep=keep, out=out)
            sink(result, batch_id)
            (new.select("_h", F.lit(batch_id).cast("long").alias("batch_id"), "window_end")
             .repartition("window_end")  # one file for a window and batch
             .write.mode("append").partitionBy("window_end").parquet(seen_table))
        if forget is not None:
            _expire(spark, seen_table, "window_end", newest - duration_micros(forget) // 1000)
    return run
