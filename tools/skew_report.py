"""Skew report: how large is the biggest unit of work of each keyed plan
when one key holds a third of all rows?

The input is derived from ``events``: every third event (by event id) is
re-keyed to one hot user.  For each plan the report prints the largest
partition-key group at the stage that orders rows, as a share of the
input, next to the share a plain ``partitionBy(key)`` would give.

usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    from pyspark.sql import functions as F

    from trailmark.functions.time import epoch_micros
    from trailmark.operators.durations import duration_micros
    from trailmark.operators.ordered import block_size, floor_to
    from trailmark.operators.patterns import FOLLOWED_FACTOR
    from trailmark.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1))
                        .otherwise(F.col("user_id")))
    total = hot.count()
    t = epoch_micros(hot, "ts")

    def share(df, cols):
        m = df.groupBy(*cols).count().agg(F.max("count")).first()[0]
        return m / total

    print(f"rows {total}; hot key share {share(hot, ['user_id']):.3f}")
    for name, within, factor in [("strict-next (1 h)", "1 hour", 4),
                                 ("followed-by (24 h)", "24 hours", FOLLOWED_FACTOR)]:
        b = block_size(duration_micros(within), factor)
        df = hot.withColumn("_blk", floor_to(t, b))
        print(f"{name:28s} by key {share(hot, ['user_id']):.3f}  "
              f"by (key, block) {share(df, ['user_id', '_blk']):.4f}")
    sweep_blk = 16 * (duration_micros("10 minutes") + duration_micros("5 seconds"))
    df = hot.withColumn("_blk", floor_to(t, sweep_blk))
    print(f"{'sliding sweep (10 min/5 s)':28s} by key {share(hot, ['user_id']):.3f}  "
          f"by (key, block) {share(df, ['user_id', '_blk']):.4f} (before pre-aggregation)")
    band = duration_micros("120 minutes")
    df = hot.withColumn("_b", floor_to(t, band))
    print(f"{'interval join (+-60 min)':28s} by key {share(hot, ['user_id']):.3f}  "
          f"by (key, bucket) {share(df, ['user_id', '_b']):.4f}")
    views = hot.where("event_type = 'view'")
    tv = epoch_micros(views, "ts")
    hour = duration_micros("1 hour")
    w = views.withColumn("_w", floor_to(tv, hour))
    s = w.withColumn("_s", floor_to(tv, hour // 60))
    print(f"{'running unique (1 h)':28s} by window {share(w, ['_w']) * total / views.count():.4f}"
          f"  by (window, slice) {share(s, ['_w', '_s']) * total / views.count():.4f}")


if __name__ == "__main__":
    main()
