"""Aggregates of overlapping windows from mergeable pane states.

An aggregate is given by the fields of its state: how a field is made from
rows, how the fields of many panes are merged, how two are, and the result
(the add / merge / result of a user's aggregate function, in Spark
expressions).  A row is then aggregated once, in its pane, however many
windows overlap it:

* panes are ``g = gcd(size, slide)`` wide; their states are partial
  aggregates, combined before the shuffle;
* time is cut into blocks of one window size.  A window that starts at ``s``
  in a block is the *suffix* of that block from ``s`` on and the *prefix* of
  the next block up to ``s + size``.  Both are running merges over the panes
  that exist, so no state has to be subtracted: minimum, maximum and sketches
  work like sums;
* suffix and prefix change at panes only.  Between two changes all windows
  have the same state, so it is merged once and expanded into output rows.

Every pane state goes to two blocks, its own and the one before; a (key,
block) holds at most ``2 x size / g`` states whatever the number of rows, so a
hot key is spread over its blocks.

Where at most ``FEW`` windows overlap a row, the pane states (never the rows)
are expanded into their windows and merged there instead: less sorting for
such windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


FEW = 8


@dataclass(frozen=True)
class Field:
    """One value of a state.  ``add`` aggregates rows, ``merge`` aggregates a
    column of states, ``join`` merges two of which either may be null."""

    add: Column
    merge: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Mergeable:
    """An aggregate: fields of its state and the result made from them."""

    fields: tuple[Field, ...]
    result: Callable[..., Column]


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def _as_is(x: Column) -> Column:
    return x


def _sum_field(rows: Column) -> Field:
    return Field(rows, F.sum, _plus)


def count_of(x=None) -> Mergeable:
    """Rows, or those where ``x`` is not null."""
    c = F.lit(1) if x is None else x
    return Mergeable((_sum_field(F.count(c)),), lambda n: F.coalesce(n, F.lit(0)).cast("long"))


def sum_of(x) -> Mergeable:
    return Mergeable((_sum_field(F.sum(x)),), _as_is)


def min_of(x) -> Mergeable:
    return Mergeable((Field(F.min(x), F.min, F.least),), _as_is)


def max_of(x) -> Mergeable:
    return Mergeable((Field(F.max(x), F.max, F.greatest),), _as_is)


def avg_of(x) -> Mergeable:
    """Mean of the values that are not null; null without any."""
    return Mergeable((_sum_field(F.sum(x)), _sum_field(F.count(x))),
                     lambda total, n: F.when(n > 0, total.cast("double") / n))


def approx_distinct_of(x, lg_config_k: int = 12) -> Mergeable:
    """Distinct values that are not null, from HyperLogLog sketches."""
    join = lambda a, b: F.coalesce(F.hll_union(a, b), a, b)
    return Mergeable((Field(F.hll_sketch_agg(x, lg_config_k), F.hll_union_agg, join),),
                     lambda sketch: F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long"))


def pane_aggregate(rows: DataFrame, *, keys: list, t: str, size_us: int, slide_us: int,
                   aggs: dict[str, Mergeable], end: str) -> DataFrame:
    """``keys..., end (epoch us), results`` for every window that holds a row.

    ``t`` names the event time in epoch us; rows without one lie in no
    window.  A null key is a key.
    """
    g = gcd(size_us, slide_us)
    floor = lambda c, width: c - F.pmod(c, F.lit(width))
    pane = floor(F.col(t), g)
    # with a slide above the size a pane may lie in no window
    covered = floor(pane, slide_us) >= pane + F.lit(g - size_us)
    fields = {f"_f{i}_{j}": f for i, a in enumerate(aggs.values()) for j, f in enumerate(a.fields)}
    states = (rows.where(covered).withColumn("_pane", pane).groupBy(*keys, "_pane")
              .agg(*[f.add.alias(n) for n, f in fields.items()]))

    results = lambda of: [a.result(*[of[f"_f{i}_{j}"] for j in range(len(a.fields))]).alias(name)
                          for i, (name, a) in enumerate(aggs.items())]
    if size_us <= FEW * slide_us:
        first_end = F.col("_pane") + F.lit(g - size_us)
        first_end = first_end + F.pmod(-first_end, F.lit(slide_us)) + F.lit(size_us)
        last_end = floor(F.col("_pane"), slide_us) + F.lit(size_us)
        return (states.withColumn(end, F.explode(F.sequence(first_end, last_end, F.lit(slide_us))))
                .groupBy(*keys, end).agg(*[f.merge(F.col(n)).alias(n) for n, f in fields.items()])
                .select(*keys, end, *results({n: F.col(n) for n in fields})))

    # every state in its own block (0) and, as a part of the prefix, in the one before (1)
    own = floor(F.col("_pane"), size_us)
    placed = (states.select("*", F.posexplode(F.array(own, own - F.lit(size_us))).alias("_next", "_blk"))
              .withColumn("_at", F.col("_pane") + F.lit(g - size_us))  # first start that holds a pane of the next block
              .where((F.col("_next") == 0) | (F.col("_at") < F.col("_blk") + F.lit(size_us))))
    # output is up to size / slide rows for a state: AQE must not size this exchange by its input
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(parts, *keys, "_blk")
    side = Window.partitionBy(*keys, "_blk", "_next")
    up = side.orderBy("_pane").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = side.orderBy(F.col("_pane").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = placed.select("*", F.lag("_pane").over(side.orderBy("_pane")).alias("_before"),
                           F.lead("_pane").over(side.orderBy("_pane")).isNull().alias("_last"),
                           F.struct(*[f.merge(F.col(n)).over(up).alias(n) for n, f in fields.items()]).alias("_prefix"))
    merged = prefix.select("*", F.struct(*[f.merge(F.col(n)).over(down).alias(n) for n, f in fields.items()]).alias("_suffix"))

    # the start from which a state holds; behind the last own pane the suffix is empty
    begins = F.coalesce(F.col("_before") + F.lit(g), F.col("_blk"))
    starts = (F.when(F.col("_next") == 1, F.array("_at"))
              .when(F.col("_last"), F.array(begins, F.col("_pane") + F.lit(g))).otherwise(F.array(begins)))
    changes = (merged.select(*keys, "_blk", "_next", "_prefix", "_suffix", F.posexplode(starts).alias("_gone", "_s"))
               .withColumn("_own", F.when(F.col("_next") == 0, F.struct(
                   (F.col("_gone") == 0).alias("_any"), F.when(F.col("_gone") == 0, F.col("_suffix")).alias("_state"))))
               .withColumn("_ahead", F.when(F.col("_next") == 1, F.col("_prefix"))))
    along = Window.partitionBy(*keys, "_blk").orderBy("_s")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = changes.select(
        *keys, "_s", F.coalesce(F.lead("_s").over(along), F.col("_blk") + F.lit(size_us)).alias("_until"),
        F.last("_own", ignorenulls=True).over(so_far).alias("_own"),
        F.last("_ahead", ignorenulls=True).over(so_far).alias("_ahead"))
    first = F.col("_s") + F.pmod(-F.col("_s"), F.lit(slide_us))
    runs = runs.where((F.coalesce(F.col("_own._any"), F.lit(False)) | F.col("_ahead").isNotNull())
                      & (first < F.col("_until")))
    joined = {n: f.join(F.col(f"_own._state.{n}"), F.col(f"_ahead.{n}")) for n, f in fields.items()}
    windows = F.sequence(first + F.lit(size_us), F.col("_until") - F.lit(1) + F.lit(size_us), F.lit(slide_us))
    return runs.select(*keys, windows.alias("_ends"), *results(joined)).select(
        *keys, F.explode("_ends").alias(end), *aggs)
