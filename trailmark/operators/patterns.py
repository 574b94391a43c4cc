"""Event patterns per key (C1-C6): strict-next and followed-by with a
``within`` bound, plus the alert / result projections.

Rules (decided in the survey, matching the reference's pattern library):
* events of a key are taken in (event time, ``seq``) order; ``seq`` breaks
  ties of equal timestamps in arrival order;
* ``within(d)`` is exclusive: a match needs ``last - first < d``;
* strict-next: the *very next* event of the key must satisfy the second
  condition; every qualifying event starts its own match (three fails in a
  row give two alerts);
* followed-by: other events in between are skipped; each start event takes
  the first later event that satisfies the second condition; a start with
  no such event inside the bound times out; a second event without a start
  gives nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions.text import (
    ORDER_PAID_MESSAGE,
    ORDER_TIMEOUT_MESSAGE,
    login_fail_message,
)
from trailmark.functions.time import epoch_micros
from trailmark.operators.durations import duration_micros
from trailmark.operators.ordered import BLOCK_FACTOR, block_size, floor_to, with_lookahead

FOLLOWED_FACTOR = 0.25
STRETCH = 64  # blocks of a key that are looked up together
MATCHED = "matched"
TIMEOUT = "timeout"


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def strict_next(df: DataFrame, *, key, ts: str, seq: str, first: Column, second: Column,
                within, unit: str = "s", carry=None, prefixes=("first_", "second_"),
                block_factor: float = BLOCK_FACTOR) -> DataFrame:
    """Pairs (e, next(e)) per key where ``first(e)``, ``second(next(e))``
    and ``t(next) - t(e) < within``.

    Partitioned by (key, time block) with a look-ahead of ``within`` into the
    next block (see :mod:`trailmark.operators.ordered`): the successor of a
    block's last row is the first row of the next block when it is close
    enough to matter.  ``carry`` names the columns of each event to return
    (default: all but the key), prefixed by ``prefixes``.
    """
    keys = _cols(key)
    carry = [c for c in (carry or df.columns) if c not in keys]
    p1, p2 = prefixes
    within_us = duration_micros(within)
    if within_us <= 0:
        raise ValueError(f"within must be positive: {within!r}")
    # an event without a time cannot be placed in the order: it takes no part
    rows = df.select(*keys, *carry, epoch_micros(df, ts, unit).alias("_t"),
                     F.col(seq).alias("_seq"), first.alias("_is1"), second.alias("_is2")) \
        .where(F.col("_t").isNotNull())
    rows = with_lookahead(rows, t="_t", horizon_us=within_us,
                          block_us=block_size(within_us, block_factor))
    w = Window.partitionBy(*keys, "_blk").orderBy("_t", "_seq")
    nxt = {c: F.lead(c).over(w) for c in [*carry, "_t", "_is2"]}
    paired = rows.select(*keys, "_own", "_is1", "_t",
                         *[F.col(c).alias(p1 + c) for c in carry],
                         *[nxt[c].alias(p2 + c) for c in carry],
                         nxt["_t"].alias("_t2"), nxt["_is2"].alias("_n2"))
    return (paired.where(F.col("_own") & F.col("_is1") & F.col("_n2")
                         & (F.col("_t2") - F.col("_t") < F.lit(within_us)))
            .select(*keys, *[p1 + c for c in carry], *[p2 + c for c in carry]))


def login_fail_alerts(pairs: DataFrame, *, user: str = "user_id",
                      first_time: str = "first_ts_s", last_time: str = "second_ts_s") -> DataFrame:
    """Warning(userId, firstFailTime, lastFailTime, "<userId>连续登陆失败两次")."""
    return pairs.select(F.col(user), F.col(first_time).alias("first_fail_time"),
                        F.col(last_time).alias("last_fail_time"),
                        login_fail_message(F.col(user)).alias("warn_message"))


def followed_by(df: DataFrame, *, key, ts: str, seq: str, first: Column, second: Column,
                within, unit: str = "s", carry=None, prefixes=("first_", "second_"),
                status_col: str = "status", block_factor: float = FOLLOWED_FACTOR) -> DataFrame:
    """Every start event with its outcome.

    One row per event satisfying ``first``: ``status = 'matched'`` with the
    first later event satisfying ``second`` when it lies within the bound,
    else ``status = 'timeout'`` and NULL ``second_*`` columns.

    Partitioned by (key, time block), with blocks shorter than the bound.  A
    partial aggregate finds the first ``second`` event of every block; over
    that small summary each block is told the first one of the next block
    that has any.  The summary is looked up in stretches of ``STRETCH``
    blocks, with the blocks that start within the bound behind a stretch
    copied into it (no later one can matter), so a key's blocks are never in
    one group either.  A start searches its own block and then the told
    event: no event is copied ahead, however long the bound is.  The search is one ordered
    pass: in *descending* order, the nearest later ``second`` event is the
    last non-null value of a growing frame ending one row before the current
    one, which Spark evaluates incrementally (a following-unbounded frame
    would be quadratic).
    """
    keys = _cols(key)
    carry = [c for c in (carry or df.columns) if c not in keys]
    p1, p2 = prefixes
    within_us = duration_micros(within)
    if within_us <= 0:
        raise ValueError(f"within must be positive: {within!r}")
    # an event without a time cannot be placed in the order: it takes no part
    rows = df.select(*keys, *carry, epoch_micros(df, ts, unit).alias("_t"),
                     F.col(seq).alias("_seq"), first.alias("_is1"), second.alias("_is2")) \
        .where(F.col("_t").isNotNull())
    # other events are skipped by followed-by: they never reach the shuffle
    rows = rows.where(F.col("_is1") | F.col("_is2"))
    block_us = block_size(within_us, block_factor)
    rows = rows.withColumn("_blk", floor_to(F.col("_t"), block_us))
    found = F.struct(F.col("_t").alias("_t"), *[F.col(c).alias(c) for c in carry])
    earliest = F.min_by(F.when(F.col("_is2"), found), F.when(F.col("_is2"), F.struct("_t", "_seq")))
    summary = (rows.groupBy(*keys, F.col("_blk").alias("_at"))
               .agg(earliest.alias("_cand"), F.max(F.coalesce("_is1", F.lit(False))).alias("_starts")))
    summary = with_lookahead(summary, t="_at", horizon_us=within_us, block_us=STRETCH * block_us)
    later = (Window.partitionBy(*keys, "_blk").orderBy(F.col("_at").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    ahead = (summary.withColumn("_cand", F.last("_cand", ignorenulls=True).over(later))
             .where(F.col("_own") & F.col("_starts") & F.col("_cand").isNotNull())
             .select(*keys, F.col("_at").alias("_blk"), "_cand"))
    # the told event stands behind all of its block: its row sorts first
    rows = (rows.withColumn("_cand", F.when(F.col("_is2"), found)).withColumn("_told", F.lit(False))
            .unionByName(ahead.withColumn("_told", F.lit(True)), allowMissingColumns=True)
            .repartition(*keys, "_blk"))
    w = (Window.partitionBy(*keys, "_blk").orderBy(F.col("_told").desc(), F.col("_t").desc(), F.col("_seq").desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    nearest = (rows.withColumn("_nx", F.last("_cand", ignorenulls=True).over(w))
               .where(~F.col("_told") & F.col("_is1")))
    ok = F.col("_nx").isNotNull() & (F.col("_nx._t") - F.col("_t") < F.lit(within_us))
    return nearest.select(
        *keys, *[F.col(c).alias(p1 + c) for c in carry],
        *[F.when(ok, F.col("_nx." + c)).alias(p2 + c) for c in carry],
        F.when(ok, F.lit(MATCHED)).otherwise(F.lit(TIMEOUT)).alias(status_col))


def order_results(outcomes: DataFrame, *, order_id: str = "order_id",
                  status_col: str = "status", out: str = "result_msg") -> DataFrame:
    """OrderResult(orderId, "payed successfully" | "timeout")."""
    msg = F.when(F.col(status_col) == MATCHED, F.lit(ORDER_PAID_MESSAGE)) \
        .otherwise(F.lit(ORDER_TIMEOUT_MESSAGE))
    return outcomes.withColumn(out, msg)


def split_outcomes(outcomes: DataFrame, status_col: str = "status"):
    """The two outputs of the pattern as two filtered views of one result."""
    return (outcomes.where(F.col(status_col) == MATCHED),
            outcomes.where(F.col(status_col) == TIMEOUT))
