"""Structured Streaming forms of the operators."""

from trailmark.streaming.matching import stream_interval_join, stream_reconcile
from trailmark.streaming.patterns import (
    stream_followed_by,
    stream_order_results,
    stream_reconcile_one_to_one,
    stream_strict_next,
)
from trailmark.streaming.watermarks import ascending, bounded_out_of_order, with_event_time
from trailmark.streaming.windows import (
    refining_top_n_each_batch,
    running_unique_each_batch,
    stream_page_views,
    stream_unique_count,
    stream_window_counts,
    top_n_each_batch,
)

__all__ = ["stream_interval_join", "stream_reconcile", "stream_followed_by",
           "stream_order_results", "stream_reconcile_one_to_one", "stream_strict_next",
           "ascending", "bounded_out_of_order", "with_event_time", "stream_page_views",
           "stream_unique_count", "stream_window_counts", "top_n_each_batch",
           "refining_top_n_each_batch", "running_unique_each_batch"]
