"""Time windows and window aggregates.

Windows are ``[start, end)``, aligned to the epoch, and only non-empty
windows produce rows; the window is exposed as ``window_end`` in epoch ms.

Sliding counts (``size / slide`` windows per row: 12 for 1 h / 5 min, 120
for 10 min / 5 s) are computed with a *sweep over window starts* instead of
expanding rows into windows:

* a row in pane ``p`` (panes are ``g = gcd(size, slide)`` wide) is counted by
  the windows starting in ``[p + g - size, p]``, so it contributes ``+1`` at
  the first such start and ``-1`` one slide after the last one;
* the deltas are summed per (key, start) - a partial aggregation, so a hot
  key is combined map-side;
* a running sum over the starts of a key gives the count of every run of
  windows between two breakpoints, and each run is expanded into its
  windows once, directly into output rows.

No aggregation ever touches the expanded rows (the ``F.window`` plan
aggregates 120 rows per input row).  The running sum is partitioned by
(key, time block): a block is at least ``size + slide`` long, so a run of
non-empty windows spans at most two blocks.  Each row's range of window
starts is clipped to the (at most two) blocks it meets, so every
(key, block) is self-contained: a hot key is split over its blocks, a
block holds at most ``2 x block / pane`` breakpoints whatever the row
count, and the input is scanned once.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions.time import epoch_micros
from trailmark.operators.durations import duration_micros
from trailmark.operators.panes import Mergeable, pane_aggregate

WINDOW_END = "window_end"


def micros_to_millis(us: Column) -> Column:
    """Integer ms of an integer us column (floor).  The dividend is made a
    multiple of 1000 first, so the division is exact below 2^53 us."""
    return ((us - F.pmod(us, F.lit(1000))) / F.lit(1000)).cast("long")


def _floor_to(t: Column, width: int) -> Column:
    return t - F.pmod(t, F.lit(width))


def tumbling_end_micros(t: Column, size_us: int) -> Column:
    """End (exclusive, epoch us) of the tumbling window holding ``t``."""
    return _floor_to(t, size_us) + F.lit(size_us)


def with_window_end(df: DataFrame, *, ts: str, size, unit: str = "s",
                    out: str = WINDOW_END) -> DataFrame:
    """Attach the end (epoch ms) of the tumbling window of each row."""
    size_us = duration_micros(size)
    return df.withColumn(out, micros_to_millis(
        tumbling_end_micros(epoch_micros(df, ts, unit), size_us)))


def _pane_window_ends(pane: Column, pane_us: int, size_us: int, slide_us: int) -> Column:
    """Array of window ends (epoch us) of all sliding windows that contain
    the pane ``[pane, pane + pane_us)``; empty when none does (slide > size)."""
    a = pane + F.lit(pane_us - size_us)
    first_start = a + F.pmod(-a, F.lit(slide_us))
    last_start = _floor_to(pane, slide_us)
    return F.when(first_start <= last_start,
                  F.sequence(first_start + F.lit(size_us), last_start + F.lit(size_us),
                             F.lit(slide_us)))


def window_counts(df: DataFrame, *, keys, ts: str, size, slide=None, unit: str = "s",
                  count_col: str = "count", method: str = "sweep",
                  block_factor: int = 16) -> DataFrame:
    """W1-W5 + A1: ``count(*)`` per key and time window.

    ``keys`` may be empty (global window, W4): grouping on the window alone
    stays parallel through partial aggregation.  Returns
    ``keys..., window_end (epoch ms), count``.  ``method`` picks the sliding
    plan: ``sweep`` (default, see module doc) or ``pane`` (count per pane,
    then expand pane counts into windows and aggregate again).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = _check_sizes(size, slide)
    t = epoch_micros(df, ts, unit)
    base = df.select(*[F.col(k) for k in keys], t.alias("_t"))
    if slide_us == size_us:
        out = (base.groupBy(*keys, tumbling_end_micros(F.col("_t"), size_us).alias("_end"))
               .agg(F.count(F.lit(1)).alias(count_col)))
    elif method == "sweep":
        out = _sweep_counts(base, keys, size_us, slide_us, count_col, block_factor)
    else:
        pane_us = gcd(size_us, slide_us)
        panes = (base.groupBy(*keys, _floor_to(F.col("_t"), pane_us).alias("_pane"))
                 .agg(F.count(F.lit(1)).alias("_n")))
        ends = _pane_window_ends(F.col("_pane"), pane_us, size_us, slide_us)
        out = (panes.select(*keys, F.explode(ends).alias("_end"), "_n")
               .groupBy(*keys, "_end")
               .agg(F.sum("_n").alias(count_col)))
    return out.select(*keys, micros_to_millis(F.col("_end")).alias(WINDOW_END), count_col)


def _check_sizes(size, slide):
    size_us = duration_micros(size)
    slide_us = duration_micros(slide) if slide is not None else size_us
    if size_us <= 0 or slide_us <= 0:
        raise ValueError(f"window size and slide must be positive: {size!r}, {slide!r}")
    return size_us, slide_us


def _sweep_counts(base: DataFrame, keys, size_us: int, slide_us: int, count_col: str,
                  block_factor: int) -> DataFrame:
    g = gcd(size_us, slide_us)
    pane = _floor_to(F.col("_t"), g)
    a = pane + F.lit(g - size_us)
    lo = a + F.pmod(-a, F.lit(slide_us))                      # first window start
    hi = _floor_to(pane, slide_us) + F.lit(slide_us)          # one slide past the last
    # blocks: whole slides, at least size + slide long, so [lo, hi) meets <= 2 blocks
    block_us = -(-(block_factor * (size_us + slide_us)) // slide_us) * slide_us
    b_lo = _floor_to(lo, block_us)
    b_hi = _floor_to(hi - F.lit(1), block_us)
    split = b_hi != b_lo
    # points: +1 at lo; +1 at the second block's start when [lo, hi) is split
    # (the first block's end closes the first part); -1 at hi.  A flat array
    # of longs exploded with its position keeps the expansion in generated
    # code (arrays of structs under a CASE were 4x slower).
    x = base.where(lo < hi).select(*keys, split.alias("_split"),
                                   F.posexplode(F.array(lo, b_hi, hi)).alias("_p", "_s"))
    d = (F.when(F.col("_p") == 0, F.lit(1))
         .when(F.col("_p") == 1, F.when(F.col("_split"), F.lit(1)).otherwise(F.lit(0)))
         .otherwise(F.lit(-1)))
    # the block of a point: its own for starts, the one holding hi - 1 for ends
    at = F.col("_s") - F.when(F.col("_p") == 2, F.lit(1)).otherwise(F.lit(0))
    deltas = (x.select(*keys, _floor_to(at, block_us).alias("_blk"), "_s", d.alias("_d"))
              .where(F.col("_d") != 0)
              .groupBy(*keys, "_blk", "_s").agg(F.sum("_d").alias("_d")))
    # The runs expand into ~size/slide rows per delta: far more output than the
    # shuffled input.  An explicit partition count keeps AQE from coalescing
    # this exchange by its (small) input size, which would leave the expansion
    # to a few tasks; the count is the session's shuffle parallelism.
    parts = int(deltas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deltas = deltas.repartition(parts, *keys, "_blk")
    in_blk = Window.partitionBy(*keys, "_blk").orderBy("_s")
    runs = deltas.select(
        *keys, "_s",
        F.sum("_d").over(in_blk.rowsBetween(Window.unboundedPreceding, 0)).alias(count_col),
        F.coalesce(F.lead("_s").over(in_blk), F.col("_blk") + F.lit(block_us)).alias("_nx"))
    return (runs.where((F.col(count_col) > 0) & (F.col("_nx") > F.col("_s")))
            .select(*keys, F.explode(F.sequence(F.col("_s"), F.col("_nx") - F.lit(slide_us),
                                                F.lit(slide_us))).alias("_st"), count_col)
            .select(*keys, (F.col("_st") + F.lit(size_us)).alias("_end"), count_col))


def window_counts_by_window_fn(df: DataFrame, *, keys, ts: str, size, slide=None,
                               unit: str = "s", count_col: str = "count") -> DataFrame:
    """Same result as :func:`window_counts` through ``F.window`` (one row per
    window per input row).  Kept as the reference plan for tests and for
    streaming, where the window struct carries the watermark."""
    from trailmark.functions.time import as_event_timestamp
    from trailmark.operators.durations import spark_interval
    keys = [keys] if isinstance(keys, str) else list(keys)
    slide = slide if slide is not None else size
    w = F.window(as_event_timestamp(df, ts, unit), spark_interval(size), spark_interval(slide))
    return (df.groupBy(*keys, w.alias("_w")).agg(F.count(F.lit(1)).alias(count_col))
            .select(*keys, F.unix_millis(F.col("_w.end")).alias(WINDOW_END), count_col))


def keyed_window_sum(df: DataFrame, *, ts: str, size, value: Column | None = None,
                     label: str = "pv", unit: str = "s", key_col: str = "key",
                     out: str = "count") -> DataFrame:
    """A2 + P3: the page-view job, ``("pv", 1)`` summed per tumbling window.

    The reference keys every row by the constant ``"pv"`` (one task); here
    the constant is only a label and the grouping is on the window, so the
    sum is partial per partition.  The sum is BIGINT (the reference's is
    32-bit).
    """
    size_us = duration_micros(size)
    v = (value if value is not None else F.lit(1)).cast("long")
    t = epoch_micros(df, ts, unit)
    return (df.select(tumbling_end_micros(t, size_us).alias("_end"), v.alias("_v"))
            .groupBy("_end").agg(F.sum("_v").alias(out))
            .select(F.lit(label).alias(key_col),
                    micros_to_millis(F.col("_end")).alias(WINDOW_END), out))


def window_aggregate(df: DataFrame, *, keys, ts: str, size, slide=None, aggs: dict,
                     unit: str = "s") -> DataFrame:
    """The reference's generic ``aggregate(AggregateFunction, WindowFunction)``:
    any aggregates per key and window.

    ``aggs`` maps output names to aggregates over the input columns.  With
    mergeable states of :mod:`trailmark.operators.panes` (``{"low":
    panes.min_of("value")}``) every row is aggregated once, in its pane, and
    the windows are put together from pane states.  Where any of them is an
    aggregate Column instead (``F.median("value")``, a grouped pandas UDF), of
    which Spark offers no mergeable state, each row is assigned to every
    window that holds it (``size / slide`` copies).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us, slide_us = _check_sizes(size, slide)
    t = epoch_micros(df, ts, unit)
    if all(isinstance(a, Mergeable) for a in aggs.values()):
        found = pane_aggregate(df.withColumn("_t", t), keys=keys, t="_t", size_us=size_us, slide_us=slide_us,
                               aggs=aggs, end="_end")
        return found.select(*keys, micros_to_millis(F.col("_end")).alias(WINDOW_END), *aggs)
    if any(isinstance(a, Mergeable) for a in aggs.values()):
        raise ValueError("mergeable states and aggregate columns cannot be mixed")
    first_end = _floor_to(t, slide_us) + F.lit(slide_us)
    # ends e with e - size <= t < e, on the slide grid offset by size
    lo = t + F.lit(1)
    first = lo + F.pmod(F.lit(size_us) - lo, F.lit(slide_us)) if size_us % slide_us else first_end
    # with a slide above the size a row may lie in no window
    ends = F.when(first <= t + F.lit(size_us), F.sequence(first, t + F.lit(size_us), F.lit(slide_us)))
    rows = df.withColumn("_end", F.explode(ends))
    return (rows.groupBy(*keys, "_end").agg(*[c.alias(n) for n, c in aggs.items()])
            .select(*keys, micros_to_millis(F.col("_end")).alias(WINDOW_END), *aggs.keys()))
