"""Scalar column functions (time, hashing, text)."""

from trailmark.functions.hashing import poly_hash, poly_hash_of_long
from trailmark.functions.time import (
    as_event_timestamp,
    epoch_micros,
    event_time_millis,
    event_time_seconds,
    java_timestamp_text,
    parse_log_time,
)

__all__ = ["poly_hash", "poly_hash_of_long", "as_event_timestamp", "epoch_micros", "event_time_millis",
           "event_time_seconds", "java_timestamp_text", "parse_log_time"]
