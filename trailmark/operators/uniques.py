"""Distinct counts per window and the truncated average (A3-A6, F-hash).

``count(DISTINCT x)`` grouped by window is planned by Spark as two
aggregations: first on (window, x) - partial, then shuffled on both
columns, so one busy window is spread over all tasks - then a count per
window.  Nothing holds a window's users in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.functions.hashing import DEFAULT_CAP, DEFAULT_SEED, poly_hash, poly_hash_of_long
from trailmark.functions.time import epoch_micros
from trailmark.operators.durations import duration_micros
from trailmark.operators.windows import WINDOW_END, micros_to_millis, tumbling_end_micros

SLICES, ROWS_PER_RANGE, RANGES_PER_PARTITION = 60, 100_000, 8
_SUB = 1 << 32  # a place is slice * _SUB + range inside the slice
_MARK, _CARRY, _EVENT = 0, 1, 2  # in this order inside a slice


def _windowed(df: DataFrame, ts: str, size, unit: str, *cols: Column) -> DataFrame:
    end = micros_to_millis(tumbling_end_micros(epoch_micros(df, ts, unit), duration_micros(size)))
    return df.select(end.alias(WINDOW_END), *cols)


def unique_count(df: DataFrame, *, user: str, ts: str, size, unit: str = "s",
                 out: str = "uv_count") -> DataFrame:
    """A3: exact number of distinct users per tumbling window."""
    return (_windowed(df, ts, size, unit, F.col(user).alias("_u"))
            .groupBy(WINDOW_END).agg(F.count_distinct("_u").alias(out)))


def bitmap_offset(user: Column, seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP,
                  integral: bool = False) -> Column:
    """Bit offset of a user id in the reference's per-window bitmap: the hash
    of its decimal text.  ``integral=True`` (a BIGINT / INT id) computes it
    in plain arithmetic, which stays in generated code."""
    if integral:
        return poly_hash_of_long(user, seed, cap)
    return poly_hash(user.cast("string"), seed, cap)


def user_offset(df: DataFrame, user: str, seed: int = DEFAULT_SEED,
                cap: int = DEFAULT_CAP) -> Column:
    """:func:`bitmap_offset` of ``df[user]``, arithmetic for integral ids."""
    integral = isinstance(df.schema[user].dataType, (T.LongType, T.IntegerType, T.ShortType))
    return bitmap_offset(F.col(user), seed, cap, integral=integral)


def bitmap_unique_count(df: DataFrame, *, user: str, ts: str, size, unit: str = "s",
                        seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP,
                        out: str = "uv_count") -> DataFrame:
    """A4: distinct *bit offsets* per window - the count the reference reads
    back from its bitmap.  Hash collisions undercount exactly as the bitmap
    does (ids 0..99 999 are collision-free; 0..9 999 999 lose 0.3 %)."""
    return (_windowed(df, ts, size, unit, user_offset(df, user, seed, cap).alias("_h"))
            .groupBy(WINDOW_END).agg(F.count_distinct("_h").alias(out)))


def running_unique_count(df: DataFrame, *, user: str, ts: str, size, seq: str,
                         unit: str = "s", seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP,
                         keep=(), out: str = "uv_count", sub_blocks: int = SLICES,
                         rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """A5: one row per event with the window's distinct count so far.

    Events are taken in (time, ``seq``) order inside their window; an event
    raises the count when its bit offset is new to the window (the
    reference's fire-per-element trigger).  Returns
    ``window_end, keep..., uv_count``.

    Plan, free of hot groups: every window is cut into ``sub_blocks`` time
    slices, and slices are cut further into ranges of (time, ``seq``) at
    bounds drawn from the events themselves: those whose hash falls below a
    limit, so that about ``RANGES_PER_PARTITION`` times the session's shuffle
    partitions are drawn from all events, and none closer than about
    ``rows_per_range``.  A burst is thereby cut by rank however short it is,
    down to events of equal time and ``seq``.  The drawing is part of the
    plan and the same in every reading.  The bounds are few whatever the
    input (their number is the one above, give or take its square root) and
    broadcast for that reason.

    A partial ``min`` gives the first place (slice and range) of each
    (window, offset); the events, one mark row per (window, offset) in its
    first place and one carry row per place (the offsets first seen in
    earlier places: a prefix sum over the small table of places) are shuffled
    together once, on (window, place).  There the event behind a mark is the
    first of its offset, and a running sum from the carry is the count.  Nothing is
    joined back to the events, so nothing depends on row ids being the same
    in two readings.
    """
    size_us = duration_micros(size)
    rows = event_offsets(df, user=user, ts=ts, size_us=size_us, seq=seq, unit=unit, seed=seed,
                         cap=cap, keep=keep)
    return running_with_prior(rows, None, size_us=size_us, keep=keep, out=out, sub_blocks=sub_blocks,
                              rows_per_range=rows_per_range)[0]


def event_offsets(df: DataFrame, *, user: str, ts: str, size_us: int, seq, unit: str = "s",
                  seed: int = DEFAULT_SEED, cap: int = DEFAULT_CAP, keep=()) -> DataFrame:
    """Events as (window_end, _t, _seq, _h bit offset, keep...)."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    t = epoch_micros(df, ts, unit)
    order = F.col(seq) if isinstance(seq, str) else seq
    return df.select(micros_to_millis(tumbling_end_micros(t, size_us)).alias(WINDOW_END),
                     t.alias("_t"), order.alias("_seq"),
                     user_offset(df, user, seed, cap).alias("_h"), *keep)


def _with_places(rows: DataFrame, size_us: int, sub_blocks: int, rows_per_range: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their ``_place``, and the places (``window_end, _place``)
    that ranges add to the slices."""
    width = max(size_us // sub_blocks, 1)
    since = F.col("_t") - (F.col(WINDOW_END) * F.lit(1000) - F.lit(size_us))
    rows = rows.withColumn("_slice", (since - F.pmod(since, F.lit(width))) / F.lit(width))
    rows = rows.withColumn("_slice", F.col("_slice").cast("long"))
    ranges = RANGES_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.least(F.lit(1.0 / rows_per_range), F.lit(float(ranges)) / F.greatest(number, F.lit(1)))
    # 52 bits of the hash as a fraction
    drawn = F.shiftrightunsigned(F.xxhash64(WINDOW_END, "_t", "_seq"), 12) / F.lit(float(1 << 52)) < share
    at = F.struct("_t", "_seq")
    bounds = (rows.where(drawn).groupBy(WINDOW_END, "_slice").agg(F.sort_array(F.collect_set(at)).alias("_bounds"))
              .withColumn("_step", F.ceil(F.sqrt(F.size("_bounds"))).cast("int")))
    extra = bounds.select(WINDOW_END, F.posexplode("_bounds").alias("_i", "_b"), "_slice").select(
        WINDOW_END, (F.col("_slice") * F.lit(_SUB) + F.col("_i") + F.lit(1)).alias("_place"))
    # looked up in two steps: among every _step-th bound, then between two of those
    heads = F.transform(F.sequence(F.lit(1), F.size("_bounds"), F.col("_step")), lambda i: F.element_at("_bounds", i))
    bounds = bounds.withColumn("_heads", heads)
    below = lambda found: F.size(F.filter(found, lambda b: b <= at))
    head = F.greatest(below(F.col("_heads")) - F.lit(1), F.lit(0)) * F.col("_step")
    sub = head + below(F.slice("_bounds", head + F.lit(1), F.col("_step")))
    placed = rows.join(F.broadcast(bounds), [WINDOW_END, "_slice"], "left").select(
        *rows.columns, (F.col("_slice") * F.lit(_SUB) + F.coalesce(sub, F.lit(0))).alias("_place")).drop("_slice")
    return placed, extra


def running_with_prior(rows: DataFrame, seen: DataFrame | None, *, size_us: int, keep=(), out: str = "uv_count",
                       sub_blocks: int = SLICES,
                       rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """The running counts of ``rows`` (as :func:`event_offsets` makes them)
    on top of the offsets ``seen`` before (``window_end, _h``, distinct), and
    the offsets (``window_end, _h``) that are new."""
    keep = [keep] if isinstance(keep, str) else list(keep)
    events, extra = _with_places(rows, size_us, sub_blocks, rows_per_range)
    firsts = events.groupBy(WINDOW_END, "_h").agg(F.min("_place").alias("_place"))
    # windows with events, their places, and the offsets first seen in each
    last = (size_us - 1) // max(size_us // sub_blocks, 1)
    every = (firsts.select(WINDOW_END).distinct()
             .select(WINDOW_END, (F.explode(F.sequence(F.lit(0), F.lit(last).cast("long")))).alias("_place"))
             .select(WINDOW_END, (F.col("_place") * F.lit(_SUB)).alias("_place"))
             .unionByName(extra).withColumn("_n", F.lit(0).cast("long")))
    if seen is not None:
        firsts = firsts.join(seen.select(WINDOW_END, "_h"), [WINDOW_END, "_h"], "left_anti")
        prior = (seen.groupBy(WINDOW_END).agg(F.count(F.lit(1)).alias("_n"))
                 .select(WINDOW_END, F.lit(-1).cast("long").alias("_place"), "_n"))  # before any place
        every = every.unionByName(prior)
    counts = firsts.groupBy(WINDOW_END, "_place").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(WINDOW_END).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    carry = (every.unionByName(counts).groupBy(WINDOW_END, "_place").agg(F.sum("_n").alias("_n"))
             .select(WINDOW_END, "_place", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_add")))
    marks = firsts.select(WINDOW_END, "_place", "_h", F.lit(_MARK).alias("_kind"))
    carries = carry.select(WINDOW_END, "_place", F.lit(_CARRY).alias("_kind"), "_add")
    together = (events.withColumn("_kind", F.lit(_EVENT))
                .unionByName(marks, allowMissingColumns=True)
                .unionByName(carries, allowMissingColumns=True)
                .repartition(WINDOW_END, "_place"))
    same = Window.partitionBy(WINDOW_END, "_place", "_h").orderBy("_kind", "_t", "_seq")
    new = (F.col("_kind") == _EVENT) & (F.lag("_kind").over(same) == _MARK)
    flagged = (together.withColumn("_add", F.when(new, F.lit(1)).otherwise(F.coalesce("_add", F.lit(0))).cast("long"))
               .where(F.col("_kind") != _MARK))
    running = (Window.partitionBy(WINDOW_END, "_place").orderBy("_kind", "_t", "_seq")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    result = (flagged.withColumn(out, F.sum("_add").over(running)).where(F.col("_kind") == _EVENT)
              .select(WINDOW_END, *keep, F.col(out).cast("long").alias(out)))
    return result, firsts.select(WINDOW_END, "_h")


def truncated_average(df: DataFrame, *, key, value: str, out: str = "avg") -> DataFrame:
    """Per key, ``sum(value) / count`` in integer arithmetic (truncated
    toward zero), returned as DOUBLE - the reference's ``Long / Int``."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys)
            .agg(F.sum(F.col(value).cast("long")).alias("_s"), F.count(F.lit(1)).alias("_c"))
            .select(*keys, F.expr("_s div _c").cast("double").alias(out)))
