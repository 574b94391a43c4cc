"""Text-log sources (S1, S3-S6): batch and streaming readers plus the
line parsers they share.

Parsing follows the reference exactly: split on ``,`` (or a space for the
access log) without quoting and without trailing empty fields, trim spaces
and control characters of each field, integral fields must parse - a bad or short line fails the job, there is no error routing.
Extra fields are ignored.  Empty fields stay empty strings (the CSV reader
would turn the empty ``tx_id`` of ``create`` rows into NULL).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.time import parse_log_time

BEHAVIOR_FIELDS = ["user_id", "item_id", "category_id", "behavior", "ts_s"]
ACCESS_FIELDS = ["ip", "user_id", "event_ms", "method", "url"]
LOGIN_FIELDS = ["user_id", "ip", "event_type", "ts_s"]
ORDER_FIELDS = ["order_id", "event_type", "tx_id", "ts_s"]
RECEIPT_FIELDS = ["tx_id", "pay_channel", "ts_s"]


# Fixed value: what the reference trims, all characters up to the space
_TRIMMED = "".join(map(chr, range(33)))


def _fields(value: Column, sep: str, needed: int) -> Column:
    # trailing empty fields do not count, as in the reference's split
    parts = F.split(F.rtrim(value, F.lit(sep)), sep, -1)
    return F.when(F.size(parts) >= needed, parts).otherwise(
        F.raise_error(F.concat(F.lit(f"log line has fewer than {needed} fields: "), value)))


def _long(field: Column) -> Column:
    v = _str(field)
    # a try_cast takes whole numbers only, whatever the ANSI mode; too large a number fails too
    return F.coalesce(v.try_cast("long"), F.raise_error(F.concat(F.lit("not an integer: "), v)))


def _str(field: Column) -> Column:
    return F.btrim(field, F.lit(_TRIMMED))


def parse_behavior_lines(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """``userId,itemId,categoryId,behavior,timestamp(s)``."""
    p = _fields(F.col(value), ",", 5)
    return lines.select(_long(p[0]).alias("user_id"), _long(p[1]).alias("item_id"),
                        _long(p[2]).alias("category_id"), _str(p[3]).alias("behavior"),
                        _long(p[4]).alias("ts_s"), *keep)


def parse_access_lines(lines: DataFrame, value: str = "value", zone: str = "UTC",
                       keep=()) -> DataFrame:
    """S3: space-separated access log; fields 0 ip, 1 user, 3 time
    (``dd/MM/yyyy:HH:mm:ss`` in ``zone``), 5 method, 6 url."""
    p = _fields(F.col(value), " ", 7)
    t = parse_log_time(p[3], zone=zone)
    t = F.coalesce(t, F.raise_error(F.concat(F.lit("bad time: "), p[3])))
    return lines.select(_str(p[0]).alias("ip"), _str(p[1]).alias("user_id"),
                        t.alias("event_ms"), _str(p[5]).alias("method"), _str(p[6]).alias("url"),
                        *keep)


def parse_login_lines(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """``userId,ip,eventType,eventTime(s)``."""
    p = _fields(F.col(value), ",", 4)
    return lines.select(_long(p[0]).alias("user_id"), _str(p[1]).alias("ip"),
                        _str(p[2]).alias("event_type"), _long(p[3]).alias("ts_s"), *keep)


def parse_order_lines(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """``orderId,eventType,txId,eventTime(s)``; txId is ``""`` on create."""
    p = _fields(F.col(value), ",", 4)
    return lines.select(_long(p[0]).alias("order_id"), _str(p[1]).alias("event_type"),
                        _str(p[2]).alias("tx_id"), _long(p[3]).alias("ts_s"), *keep)


def parse_receipt_lines(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """``txId,payChannel,eventTime(s)``."""
    p = _fields(F.col(value), ",", 3)
    return lines.select(_str(p[0]).alias("tx_id"), _str(p[1]).alias("pay_channel"),
                        _long(p[2]).alias("ts_s"), *keep)


_PARSERS = {
    "behavior": parse_behavior_lines,
    "access": parse_access_lines,
    "login": parse_login_lines,
    "order": parse_order_lines,
    "receipt": parse_receipt_lines,
}


def with_line_seq(lines: DataFrame, out: str = "seq") -> DataFrame:
    """Arrival order of lines, used to break ties of equal timestamps.

    A struct (file path, start of the file split, position in the read):
    files in name order, lines in file order even when a file is split or
    several files are packed into one task (Spark packs splits by size, so
    the position alone would not follow the files).  Must be applied to the
    DataFrame returned by the text reader, before any shuffle.
    """
    return lines.withColumn(out, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("pos")))


def read_log(spark: SparkSession, kind: str, path, *, seq: str | None = "seq") -> DataFrame:
    """Batch read of a text log of ``kind`` (behavior, access, login, order,
    receipt); adds the arrival ``seq`` column unless ``seq=None``."""
    lines = spark.read.text(path)
    if not seq:
        return _PARSERS[kind](lines)
    return _PARSERS[kind](with_line_seq(lines, seq), keep=[seq])


def read_log_stream(spark: SparkSession, kind: str, path, *, seq: str | None = None, **options) -> DataFrame:
    """Streaming read of a folder of text logs of ``kind``.  ``seq`` names a
    column to add with the arrival order as text that sorts: the file's time
    and name (files are taken in time order), then the place of the line."""
    lines = spark.readStream.options(**options).text(path)
    if not seq:
        return _PARSERS[kind](lines)
    placed = lines.select("value", F.unix_millis("_metadata.file_modification_time").alias("at"),
                          F.col("_metadata.file_path").alias("file"),
                          F.col("_metadata.file_block_start").alias("start"))
    # row ids are refused on streams: lines are numbered where they are read
    placed = placed.mapInArrow(_numbered, "value string, at long, file string, start long, line long")
    digits = lambda c: F.lpad(F.col(c).cast("string"), 20, "0")
    arrival = F.concat_ws("/", digits("at"), "file", digits("start"), digits("line"))
    return _PARSERS[kind](placed.withColumn(seq, arrival), keep=[seq])


def _numbered(batches):
    """Arrow batches of one task with the number of each row."""
    line = 0
    for batch in batches:
        numbers = pa.array(range(line, line + batch.num_rows), pa.int64())
        line += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], names=[*batch.schema.names, "line"])
