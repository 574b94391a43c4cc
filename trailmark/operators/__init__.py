"""Batch operators: ``DataFrame -> DataFrame`` functions, free of I/O."""

from trailmark.operators.filters import filter_behavior, filter_nonempty_key
from trailmark.operators.matching import interval_join, reconcile, split_reconciled, unmatched
from trailmark.operators.one_to_one import reconcile_one_to_one
from trailmark.operators.patterns import (
    followed_by,
    login_fail_alerts,
    order_results,
    split_outcomes,
    strict_next,
)
from trailmark.operators.topn import ranked_report, top_n
from trailmark.operators.uniques import (
    bitmap_unique_count,
    running_unique_count,
    truncated_average,
    unique_count,
)
from trailmark.operators.windows import (
    keyed_window_sum,
    window_aggregate,
    window_counts,
    with_window_end,
)

__all__ = [
    "filter_behavior", "filter_nonempty_key", "interval_join", "reconcile",
    "split_reconciled", "followed_by", "login_fail_alerts", "order_results",
    "split_outcomes", "strict_next", "ranked_report", "top_n", "bitmap_unique_count",
    "running_unique_count", "truncated_average", "unique_count", "keyed_window_sum",
    "window_counts", "with_window_end", "window_aggregate", "unmatched", "reconcile_one_to_one",
]
