"""Connected components of a distributed edge list.

Contraction in rounds: every node points at the neighbour (or itself) of
smallest priority, where priorities are a hash that changes each round;
pointers are doubled twice; edges are rewritten to the pointed-at nodes and
duplicates dropped.  A round at least halves the nodes that still have
edges in expectation, whatever the shape of the graph, so the number of
rounds is logarithmic and the total work is in proportion to the edges.
Nothing is collected; a node with many edges is pre-aggregated by the
partial ``min`` and its side of the joins is split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node of the
    component) for every node that has an edge to another node.  Edges with
    a null end and loops are ignored; no edges give no rows."""
    rest = materialize(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                       .where("a is not null and b is not null and a != b").distinct())
    levels: list[DataFrame] = []
    while not rest.isEmpty():
        pointers = materialize(_pointers(rest, len(levels)))
        levels.append(pointers)
        left = pointers.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = pointers.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        rest = materialize(rest.join(left, "a").join(right, "b").where("to_a != to_b")
                           .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                           .distinct())
    if not levels:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = levels[0].withColumnRenamed("to", "root")
    for pointers in levels[1:]:
        step = pointers.withColumnRenamed("node", "root")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(smallest, "root").select("node", "component")


def _pointers(edges: DataFrame, level: int) -> DataFrame:
    """Columns ``node`` and ``to``: four steps along the smallest priority."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.inline(ends))
    order = lambda c: F.struct(F.xxhash64(F.lit(level), F.col(c)).alias("h"), F.col(c).alias("n"))
    once = (both.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("best"))
            .select("node", F.least("best", order("node"))["n"].alias("to")))
    twice = _follow(once)
    return _follow(twice)


def _follow(pointers: DataFrame) -> DataFrame:
    step = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
    return pointers.join(step, "to").select("node", F.col("next").alias("to"))
