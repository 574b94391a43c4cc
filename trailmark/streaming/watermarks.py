"""Event time and watermarks for streams.

* E3 ascending timestamps: watermark = max event time less 1 ms, so rows at
  the newest time are not late in a later micro-batch;
* E4 bounded out-of-orderness: watermark = max event time - bound;
* E5 allowed lateness: a window is kept open ``lateness`` past the bound;
  append mode then emits the final count once, update mode re-emits the
  refined count for every late row (the reference's re-firing);
* E6 rows behind the watermark are dropped by Spark's stateful operators.

Spark advances the watermark once per micro-batch (not per row), so
lateness is decided per batch; rows of one batch are never late relative
to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.time import as_event_timestamp
from trailmark.operators.durations import duration_micros, spark_interval

EVENT_TIME = "event_time"


def with_event_time(df: DataFrame, ts: str, *, unit: str = "s", delay="0 seconds",
                    lateness="0 seconds", out: str = EVENT_TIME) -> DataFrame:
    """Attach a TIMESTAMP event-time column ``out`` from ``ts`` (seconds,
    milliseconds, or a timestamp) and declare the watermark
    ``max(out) - (delay + lateness)``."""
    total = duration_micros(delay) + duration_micros(lateness)
    return (df.withColumn(out, as_event_timestamp(df, ts, unit))
            .withWatermark(out, spark_interval(f"{total} us")))


def ascending(df: DataFrame, ts: str, *, unit: str = "s", out: str = EVENT_TIME) -> DataFrame:
    """Timestamps assumed ascending; watermark 1 ms before the max seen."""
    return with_event_time(df, ts, unit=unit, delay="1 ms", out=out)


def bounded_out_of_order(df: DataFrame, ts: str, bound, *, unit: str = "s",
                         out: str = EVENT_TIME) -> DataFrame:
    """Watermark ``bound`` behind the max event time."""
    return with_event_time(df, ts, unit=unit, delay=bound, out=out)


def where_behind(df: DataFrame, condition: Column, *, event_time: str = EVENT_TIME) -> DataFrame:
    """Rows of ``df`` that satisfy ``condition``, while all rows drive the
    watermark.  The condition is made to depend on the event time: a plain
    filter would be moved in front of the watermark by the optimizer."""
    return df.where(F.when(F.col(event_time).isNotNull(), condition))


def window_end_millis(window_col: str = "window") -> F.Column:
    """W5 on a stream: the window struct's end as epoch ms."""
    return F.unix_millis(F.col(f"{window_col}.end"))
