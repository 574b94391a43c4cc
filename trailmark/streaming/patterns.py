"""Keyed event patterns and strict reconciliation on streams (C1, C3-C6,
J3 one-to-one, ST1-ST3) with ``transformWithState``.

One processor per key holds two list states:

* ``buf`` - rows not yet behind the watermark.  Input order inside a
  stream is not event-time order, so rows wait until the watermark passes
  them and are then fed to the pattern sorted by (time, seq), as the
  reference's pattern library does.  Rows already behind the watermark on
  arrival are late and dropped (E6).
* ``pend`` - open partial matches waiting for a partner or their deadline.

A key has one timer (event time): at its earliest buffered row or, when
that comes first, at its earliest deadline.  When the watermark passes it the
key is visited once: the visit feeds every buffered row up to the watermark,
expires what waits longer than the bound and sets the next timer, which then
lies behind the watermark.

Rows enter as (t ms, seq, tag, payload) where ``payload`` is JSON of the
carried columns; outputs carry the payloads of both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from trailmark.functions.text import ORDER_PAID_MESSAGE, ORDER_TIMEOUT_MESSAGE
from trailmark.operators.durations import duration_micros
from trailmark.streaming.watermarks import EVENT_TIME, where_behind

DUE_SCHEMA = StructType([StructField("at", LongType())])
ROW_SCHEMA = StructType([StructField("t", LongType()), StructField("seq", StringType()),
                         StructField("tag", IntegerType()), StructField("payload", StringType())])

TAG_OTHER, TAG_FIRST, TAG_SECOND = 0, 1, 2


class _OrderedPattern(StatefulProcessor):
    """Buffers rows until the watermark, feeds them in (t, seq) order."""

    bound_ms: int = 0
    names: tuple = ()

    def row(self, *values) -> Row:
        return Row(**dict(zip(self.names, values)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", ROW_SCHEMA)
        self.pend = handle.getListState("pend", ROW_SCHEMA)
        self.due = handle.getValueState("due", DUE_SCHEMA)  # when the key's timer expires

    # --- subclass hooks ---------------------------------------------------------
    def feed(self, key, row, pend: list, out: list) -> None:
        raise NotImplementedError

    def expire(self, key, watermark: int, pend: list, out: list) -> None:
        """Drop / report pending entries whose deadline has passed."""

    def deadline(self, row) -> int | None:
        return None

    # --- engine -----------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        fresh = []
        for r in rows:
            t = int(r["t"])
            if wm >= 0 and t <= wm:
                continue  # late
            fresh.append((t, r["seq"], int(r["tag"]), r["payload"]))
        if fresh:
            self.buf.appendList(fresh)
            first = min(r[0] for r in fresh)
            due = self.due.get()[0] if self.due.exists() else None
            if due is None or first < due:
                self._set_timer(first, due)
        return iter([])

    def _set_timer(self, at: int, before: int | None) -> None:
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(at)
        self.due.update((at,))

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        wm = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        buf = list(self.buf.get()) if self.buf.exists() else []
        pend = list(self.pend.get()) if self.pend.exists() else []
        ready = sorted((r for r in buf if r[0] <= wm), key=lambda r: (r[0], r[1]))
        keep = [r for r in buf if r[0] > wm]
        out: list = []
        for r in ready:
            self.feed(key, r, pend, out)
        self.expire(key, wm, pend, out)
        self.buf.clear()
        if keep:
            self.buf.put(keep)
        self.pend.clear()
        if pend:
            self.pend.put(pend)
        times = [r[0] for r in keep] + [d for p in pend if (d := self.deadline(p)) is not None]
        if times:
            self._set_timer(min(times), None)
        else:
            self.due.clear()  # nothing waits: the key leaves no state behind
        return iter(out)

    def close(self) -> None:
        pass


class StrictNextProcessor(_OrderedPattern):
    """``first`` immediately followed by ``second`` within the bound.
    ``pend`` holds the previous row of the key while it may still be a
    ``first``: at most one entry, dropped at its deadline."""

    def __init__(self, within):
        self.bound_ms = duration_micros(within) // 1000

    def deadline(self, row):
        return row[0] + self.bound_ms if row[2] & TAG_FIRST else None

    def feed(self, key, row, pend, out):
        if pend:
            prev = pend[0]
            if row[2] & TAG_SECOND and row[0] - prev[0] < self.bound_ms:
                out.append(self.row(*key, prev[0], prev[3], row[0], row[3]))
        pend[:] = [row] if row[2] & TAG_FIRST else []

    def expire(self, key, watermark, pend, out):
        pend[:] = [p for p in pend if p[0] + self.bound_ms > watermark]


class FollowedByProcessor(_OrderedPattern):
    """Each ``first`` takes the first later ``second`` within the
    bound, else times out at its deadline.  ``pend`` holds open starts."""

    def __init__(self, within):
        self.bound_ms = duration_micros(within) // 1000

    def deadline(self, row):
        return row[0] + self.bound_ms if row[2] & TAG_FIRST else None

    def _timeouts(self, key, until, pend, out):
        still = []
        for p in pend:
            if p[0] + self.bound_ms <= until:
                out.append(self.row(*key, "timeout", p[0], p[3], None, None))
            else:
                still.append(p)
        pend[:] = still

    def feed(self, key, row, pend, out):
        self._timeouts(key, row[0], pend, out)
        if row[2] & TAG_SECOND:
            for p in pend:
                out.append(self.row(*key, "matched", p[0], p[3], row[0], row[3]))
            pend[:] = []
        if row[2] & TAG_FIRST:
            pend.append(row)

    def expire(self, key, watermark, pend, out):
        self._timeouts(key, watermark, pend, out)


class ReconcileProcessor(_OrderedPattern):
    """J3 one-to-one: a pay (tag 1) and a receipt (tag 2) of a key match when
    ``|dt| <= bound``; each match consumes the oldest waiting row of the
    other side; rows waiting past the bound are reported unmatched."""

    def __init__(self, bound):
        self.bound_ms = duration_micros(bound) // 1000

    def deadline(self, row):
        return row[0] + self.bound_ms

    def _expire(self, key, until, pend, out, inclusive):
        still = []
        for p in pend:
            late = p[0] + self.bound_ms <= until if inclusive else p[0] + self.bound_ms < until
            if late:
                status = "unmatched_pay" if p[2] == TAG_FIRST else "unmatched_receipt"
                pay = (p[0], p[3]) if p[2] == TAG_FIRST else (None, None)
                rec = (p[0], p[3]) if p[2] == TAG_SECOND else (None, None)
                out.append(self.row(*key, status, *pay, *rec))
            else:
                still.append(p)
        pend[:] = still

    def feed(self, key, row, pend, out):
        self._expire(key, row[0], pend, out, inclusive=False)
        other = next((p for p in pend if p[2] != row[2]), None)
        if other is None:
            pend.append(row)
            return
        pend.remove(other)
        pay, rec = (other, row) if other[2] == TAG_FIRST else (row, other)
        out.append(self.row(*key, "matched", pay[0], pay[3], rec[0], rec[3]))

    def expire(self, key, watermark, pend, out):
        self._expire(key, watermark, pend, out, inclusive=True)


def _tagged(df: DataFrame, *, key, seq, tag, carry, event_time: str) -> DataFrame:
    """``seq`` breaks ties of equal event times: a column name or Column,
    either a number (a Kafka offset, an event id) or text that sorts (the
    arrival of a log line), or None - then equal times keep the order in
    which the processor received them."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = F.to_json(F.struct(*[F.col(c) for c in carry])) if carry else F.lit(None)
    order = F.lit("") if seq is None else (F.col(seq) if isinstance(seq, str) else seq)
    if seq is not None and not isinstance(df.select(order.alias("seq")).schema["seq"].dataType, StringType):
        # numbers as text of one length, moved up so that all are positive
        order = F.lpad((order.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return df.select(*keys, F.col(event_time),
                     F.unix_millis(F.col(event_time)).alias("t"), order
                     .alias("seq"), tag.cast("int").alias("tag"), payload.cast("string")
                     .alias("payload"))


def _out_schema(df: DataFrame, keys, fields) -> StructType:
    return StructType([df.schema[k] for k in keys] + fields)


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _run(tagged: DataFrame, keys, processor, fields, output_mode="append") -> DataFrame:
    # transformWithState needs the RocksDB state store; a new query takes the
    # session's setting (a restarted one keeps what its checkpoint recorded)
    conf = tagged.sparkSession.conf
    if conf.get("spark.sql.streaming.stateStore.providerClass", "") != _ROCKSDB:
        conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    schema = _out_schema(tagged, keys, fields)
    processor.names = tuple(schema.fieldNames())
    return (tagged.groupBy(*keys)
            .transformWithState(processor, schema, output_mode, "EventTime"))


def stream_strict_next(events: DataFrame, *, key, seq=None, first, second, within,
                       carry=(), event_time: str = EVENT_TIME) -> DataFrame:
    """C1 on a watermarked stream: ``key..., first_t, first_payload, second_t,
    second_payload`` (times in epoch ms, payloads JSON of ``carry``)."""
    keys = [key] if isinstance(key, str) else list(key)
    tag = (F.when(first, TAG_FIRST).otherwise(0) + F.when(second, TAG_SECOND).otherwise(0))
    tagged = _tagged(events, key=keys, seq=seq, tag=tag, carry=list(carry), event_time=event_time)
    return _run(tagged, keys, StrictNextProcessor(within),
                [StructField("first_t", LongType()), StructField("first_payload", StringType()),
                 StructField("second_t", LongType()), StructField("second_payload", StringType())])


def stream_followed_by(events: DataFrame, *, key, seq=None, first, second, within,
                       carry=(), event_time: str = EVENT_TIME) -> DataFrame:
    """C3/C4/C6 on a watermarked stream: one row per start event with
    ``status`` matched / timeout (emitted at the deadline)."""
    keys = [key] if isinstance(key, str) else list(key)
    tag = (F.when(first, TAG_FIRST).otherwise(0) + F.when(second, TAG_SECOND).otherwise(0))
    tagged = _tagged(events, key=keys, seq=seq, tag=tag, carry=list(carry), event_time=event_time)
    # other events are skipped by followed-by: they drive the watermark, but reach no key's state
    tagged = where_behind(tagged, F.col("tag") != 0, event_time=event_time)
    return _run(tagged, keys, FollowedByProcessor(within),
                [StructField("status", StringType()), StructField("first_t", LongType()),
                 StructField("first_payload", StringType()), StructField("second_t", LongType()),
                 StructField("second_payload", StringType())])


def stream_order_results(outcomes: DataFrame) -> DataFrame:
    """The order job's messages on the stream outcome rows."""
    return outcomes.withColumn("result_msg", F.when(F.col("status") == "matched",
                                                    F.lit(ORDER_PAID_MESSAGE))
                               .otherwise(F.lit(ORDER_TIMEOUT_MESSAGE)))


def stream_reconcile_one_to_one(pays: DataFrame, receipts: DataFrame, *, key: str, seq=None,
                                bound="5 seconds", pay_carry=(), receipt_carry=(),
                                event_time: str = EVENT_TIME) -> DataFrame:
    """J3 with the reference's consuming semantics: the tagged union of both
    streams, keyed by ``key``; ``status`` matched / unmatched_pay /
    unmatched_receipt, payload JSON per side."""
    p = _tagged(pays, key=key, seq=seq, tag=F.lit(TAG_FIRST), carry=list(pay_carry),
                event_time=event_time)
    r = _tagged(receipts, key=key, seq=seq, tag=F.lit(TAG_SECOND), carry=list(receipt_carry),
                event_time=event_time)
    return _run(p.unionByName(r), [key], ReconcileProcessor(bound),
                [StructField("status", StringType()), StructField("pay_t", LongType()),
                 StructField("pay_payload", StringType()), StructField("receipt_t", LongType()),
                 StructField("receipt_payload", StringType())])
