"""Event-time column helpers.

Operators do window and band arithmetic on epoch integers: exact,
independent of the session zone, and inside whole-stage codegen.  Window
ends are exposed as epoch milliseconds (BIGINT), the reference's
representation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

MICROS = {"us": 1, "ms": 1_000, "s": 1_000_000}


def epoch_micros(df: DataFrame, col: str, unit: str = "s") -> Column:
    """Epoch microseconds of ``df[col]``.

    TIMESTAMP -> ``unix_micros``; TIMESTAMP_NTZ -> difference to the NTZ
    epoch (independent of the session zone); integral -> scaled by ``unit``
    (``s``, ``ms`` or ``us``).
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return c.cast("long") * F.lit(MICROS[unit])
    raise TypeError(f"column {col!r} of type {dtype} is not an event time")


def event_time_seconds(col: str | Column) -> Column:
    """Epoch seconds -> event-time TIMESTAMP (the reference's ``ts * 1000``)."""
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)


def event_time_millis(col: str | Column) -> Column:
    """Epoch milliseconds -> event-time TIMESTAMP."""
    return F.timestamp_millis(F.col(col) if isinstance(col, str) else col)


def as_event_timestamp(df: DataFrame, col: str, unit: str = "s") -> Column:
    """A TIMESTAMP (with zone) column usable by ``withWatermark``.

    Watermarks refuse TIMESTAMP_NTZ and a plain cast depends on the session
    zone; going through epoch microseconds is exact in any zone.
    """
    return F.timestamp_micros(epoch_micros(df, col, unit))


def millis_to_ntz(ms: Column) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ holding the UTC wall time."""
    return F.timestamp_add("MILLISECOND", ms, _epoch_ntz())


def parse_log_time(text: Column, pattern: str = "dd/MM/yyyy:HH:mm:ss",
                   zone: str = "UTC") -> Column:
    """wall-clock text -> epoch ms, read in ``zone`` (the reference uses
    the JVM zone; fixed to UTC by default)."""
    ntz = F.to_timestamp_ntz(text, F.lit(pattern))
    if zone != "UTC":
        ntz = F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz)
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), ntz)


def java_timestamp_text(ms: Column) -> Column:
    """epoch ms -> ``java.sql.Timestamp`` text in UTC, e.g.
    ``2017-11-26 09:05:00.0``: fraction without trailing zeros, at least one
    digit."""
    frac = F.pmod(ms, F.lit(1000))
    frac_txt = F.when(frac == 0, F.lit("0")).otherwise(
        F.regexp_replace(F.lpad(frac.cast("string"), 3, "0"), "0+$", ""))
    return F.concat(F.date_format(millis_to_ntz(ms), "yyyy-MM-dd HH:mm:ss"),
                    F.lit("."), frac_txt)
