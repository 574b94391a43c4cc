"""Stream-stream interval join and reconciliation (J1-J6 on streams).

Both inputs carry watermarks; the band condition on event time lets Spark
evict joined state once the watermark passes ``t + upper``.  Inner for the
interval join; full outer for reconciliation, where a row without partner
is emitted (NULL on the other side) once the watermark proves no partner
can still arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators.durations import duration_micros
from trailmark.operators.matching import MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT
from trailmark.streaming.watermarks import EVENT_TIME


def _sides(left, right, left_key, right_key, left_carry, right_carry, prefixes, event_time):
    lp, rp = prefixes
    L = left.select(F.col(left_key).alias(lp + "key"), F.col(event_time).alias(lp + "time"),
                    *[F.col(c).alias(lp + c) for c in left_carry])
    R = right.select(F.col(right_key).alias(rp + "key"), F.col(event_time).alias(rp + "time"),
                     *[F.col(c).alias(rp + c) for c in right_carry])
    return L, R


def _band(L, R, prefixes, lower, upper):
    lp, rp = prefixes
    lo, hi = duration_micros(lower), duration_micros(upper)
    return F.expr(
        f"{lp}key = {rp}key AND {rp}time >= {lp}time + INTERVAL {lo} MICROSECONDS "
        f"AND {rp}time <= {lp}time + INTERVAL {hi} MICROSECONDS")


def stream_interval_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                         lower="-5 seconds", upper="5 seconds", left_carry=(), right_carry=(),
                         prefixes=("pay_", "receipt_"), event_time: str = EVENT_TIME) -> DataFrame:
    """All pairs of equal key with ``t_r - t_l`` in ``[lower, upper]``."""
    L, R = _sides(left, right, left_key, right_key, left_carry, right_carry, prefixes, event_time)
    return L.join(R, _band(L, R, prefixes, lower, upper), "inner")


def stream_reconcile(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                     lower="-5 seconds", upper="5 seconds", left_carry=(), right_carry=(),
                     prefixes=("pay_", "receipt_"), event_time: str = EVENT_TIME) -> DataFrame:
    """Full outer interval join with a ``status`` column."""
    lp, rp = prefixes
    L, R = _sides(left, right, left_key, right_key, left_carry, right_carry, prefixes, event_time)
    # a marker per side, not the key, tells whose row is there: keys may be NULL
    L, R = L.withColumn("_left", F.lit(True)), R.withColumn("_right", F.lit(True))
    j = L.join(R, _band(L, R, prefixes, lower, upper), "full_outer")
    status = (F.when(F.col("_left").isNull(), F.lit(UNMATCHED_RIGHT))
              .when(F.col("_right").isNull(), F.lit(UNMATCHED_LEFT))
              .otherwise(F.lit(MATCHED)))
    return j.withColumn("status", status).drop("_left", "_right")
