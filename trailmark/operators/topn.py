"""Per-window top-N (T1, T2) and the ranked text reports.

``row_number() <= n`` over ``partition by window_end`` lets Spark insert a
``WindowGroupLimit`` before the shuffle, so each map task sends at most
``n`` rows per window whatever the number of keys; the final ranking then
sees at most ``n x tasks`` rows per window.  Ties are broken by key
ascending (the reference keeps arrival order, which is not reproducible).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions.text import (
    REPORT_HEADER,
    URL_REPORT_TRAILER,
    item_report_line,
    url_report_line,
)
from trailmark.functions.time import java_timestamp_text
from trailmark.operators.windows import WINDOW_END


def top_n(counts: DataFrame, *, key: str, n: int, value: str = "count",
          group: str = WINDOW_END, rank_col: str = "rank") -> DataFrame:
    """The ``n`` keys with the highest ``value`` per ``group``.

    Exactly ``min(n, keys)`` rows per group (``row_number``, not ``rank``).
    """
    if n < 1:
        raise ValueError(f"n must be positive: {n}")
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col(key).asc())
    # filter on the bare row_number so the optimizer can infer the group limit
    return (counts.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n)
            .select(group, F.col("_rn").cast("long").alias(rank_col), key, value))


def ranked_report(topn: DataFrame, *, key: str, style: str = "items", value: str = "count",
                  group: str = WINDOW_END, rank_col: str = "rank",
                  out: str = "report") -> DataFrame:
    """One text per window, lines in rank order, as the reference prints it.

    ``style='items'`` gives ``no<i>: 商品ID=..浏览量=..`` lines, ``'urls'``
    gives ``NO<i>: URL=.. count=..`` lines and the ``+`` trailer.  The
    collected list is bounded by ``n`` rows per window.
    """
    line_fn = item_report_line if style == "items" else url_report_line
    trailer = URL_REPORT_TRAILER if style == "urls" else ""
    lines = topn.select(group, F.struct(F.col(rank_col).alias("r"),
                                        line_fn(F.col(rank_col), F.col(key), F.col(value))
                                        .alias("l")).alias("_x"))
    return (lines.groupBy(group)
            .agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
            .select(group,
                    F.concat(F.lit(REPORT_HEADER), java_timestamp_text(F.col(group)), F.lit("\n"),
                             F.array_join(F.col("_xs.l"), ""), F.lit(trailer)).alias(out)))
