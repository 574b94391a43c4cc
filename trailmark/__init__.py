"""trailmark: user-behaviour analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function that takes column
names and parameters and performs no I/O.  Batch forms live in
``trailmark.operators``; Structured Streaming forms in
``trailmark.streaming``; text-log readers and sinks in ``trailmark.sources``;
composed jobs (the nine reference jobs and the driver queries over the
``events`` table) in ``trailmark.plans``.
"""

from trailmark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
