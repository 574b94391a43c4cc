"""Ordered scans per key, split into time blocks so that no task holds a
whole key.

A keyed ``Window.partitionBy(key)`` sends every row of a key to one task;
with one key holding a third of the data that task is the job.  The scans
used here only look a bounded time ahead (the ``within`` bound of a
pattern), so rows are partitioned by ``(key, block)`` where a block is a
time range at least that bound long, and each block also receives a
*look-ahead* copy of the rows of the next block that fall in the first
``horizon`` of it.  Inside a block the window functions see every row that
can complete a match starting there; look-ahead copies never start one.
Rows are copied at most once, a share of about ``horizon / block``.
(The running distinct count, whose look-back is the whole window, uses
time slices with carried totals instead: see ``uniques.running_unique_count``.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_FACTOR = 4


def floor_to(t: Column, width: int) -> Column:
    return t - F.pmod(t, F.lit(width))


def block_size(horizon_us: int, factor: float = BLOCK_FACTOR) -> int:
    """Block length ``factor x horizon`` (at least 1 us).  A factor below 1
    gives shorter blocks - smaller groups for a key that is dense in a short
    span - at the price of more look-ahead copies (about ``1 / factor`` per
    copied row)."""
    return max(int(max(horizon_us, 1) * factor), 1)


def with_lookahead(rows: DataFrame, *, t: str, horizon_us: int, block_us: int,
                   copy_if: Column | None = None) -> DataFrame:
    """Add ``_blk`` (block start) and ``_own``.  A row (satisfying
    ``copy_if``) is also emitted, with ``_own = false``, into every earlier
    block whose end lies less than ``horizon_us`` before the row: there it
    is the look-ahead of that block's last rows."""
    blk = floor_to(F.col(t), block_us)
    offset = F.col(t) - blk                       # time since the own block's start
    # copies into blocks j = 1, 2, ... back while offset + (j - 1) * block < horizon
    n_copies = F.when(offset < F.lit(horizon_us),
                      F.floor((F.lit(horizon_us) - offset - F.lit(1)) / F.lit(block_us)) + 1) \
        .otherwise(F.lit(0)).cast("int")
    if copy_if is not None:
        n_copies = F.when(copy_if, n_copies).otherwise(F.lit(0))
    # position 0: the own block; position j: the copy j blocks earlier
    back = F.sequence(F.lit(0), n_copies)
    return (rows.select(*rows.columns, F.posexplode(back).alias("_pos", "_j"))
            .withColumn("_blk", blk - F.col("_j").cast("long") * F.lit(block_us))
            .withColumn("_own", F.col("_pos") == 0).drop("_pos", "_j"))
