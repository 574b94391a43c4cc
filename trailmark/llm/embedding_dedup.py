"""Near-duplicate vectors by a forest of random-projection trees.

Vectors of the same direction (equal after division by their length, to 12
decimals) are one class; a class is compared once and stands for all its
copies.  Each of several trees cuts the classes again and again by a random
direction at the median, until a leaf is small; what lies within ``spill``
of the median goes to both sides.  The upper cuts are fitted on a bounded
sample (``SAMPLE`` classes in hash order) and every class is sent through
them; leaves that are still above ``LARGEST_LEAF`` are cut further, one
level a round, at the quantiles of all their classes.

A group of near copies is not cut through itself: where at least ``DENSE``
of the pairs of a node's classes are linked (seen on ``DENSE_SAMPLE`` of
them) the cutting stops, however many they are.  Such a leaf above
``LARGEST_LEAF`` is dealt into blocks and every block is compared with every
other, each pair once, by as many comparisons as a few times its links.

Inside a leaf all classes are compared by cosine in double precision.  A
pair may meet in several leaves: each class carries the list of its leaves,
and a pair counts only in the smallest leaf that both share, so links are
counted without writing pairs.  A leaf returns a row for each class: its
new links and the smallest class it is connected with there; components of
those edges are the union over all trees.

Links are exact (cosine at least the threshold in double precision); which
of them are found depends on the trees outside of the dense leaves.  A pair at cosine 0.95 is parted by
a cut with a probability of about 4 %, so one tree of ten levels keeps about
two thirds of such pairs and eight trees lose one in several thousand.
Tables of at most ``LEAF`` classes are one leaf and exact.

Defined cases: vectors that are null, empty, zero, of a length that is not
finite, or hold a null or non-finite component link with nothing and are
their own component; vectors link only with those of their dimension;
repeated rows are copies, each a row with its links; rows without an id
link like others but name no component; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components

TREES = 8
LEAF, LARGEST_LEAF = 1024, 4096
SPILL = 0.03
SAMPLE, LEAST_SAMPLE = 32768, 32
DENSE, DENSE_SAMPLE = 0.2, 128
ROWS_AT_ONCE = 512
PAIRS_AT_ONCE = 1 << 14
LEAVES_AT_ONCE = 1024
SEED = 20240


class Tree:
    """Cuts fitted on a sample.  Node i sends a vector whose projection on
    ``directions[i]`` is at most ``high[i]`` to ``left[i]`` and one that is
    at least ``low[i]`` to ``right[i]``; negative children are leaves."""

    def __init__(self, sample: np.ndarray, share: float, leaf: int, spill: float, threshold: float, rng):
        self.directions, self.low, self.high, self.left, self.right = [], [], [], [], []
        self.leaves, self.threshold = 0, threshold
        self.root = self._grow(sample, share, leaf, spill, rng)
        self.directions = np.array(self.directions, dtype=np.float32)

    def _grow(self, sample: np.ndarray, share: float, leaf: int, spill: float, rng) -> int:
        direction = rng.normal(size=sample.shape[1]).astype(np.float32)
        along = sample @ direction
        if (len(sample) <= max(leaf * share, LEAST_SAMPLE if share < 1 else 0) or along.min() == along.max()
                or _mostly_linked(sample, self.threshold)):
            self.leaves += 1
            return -self.leaves
        low, high = np.quantile(along, [0.5 - spill, 0.5 + spill])
        node = len(self.low)
        self.directions.append(direction)
        for values, value in ((self.low, low), (self.high, high), (self.left, 0), (self.right, 0)):
            values.append(value)
        self.left[node] = self._grow(sample[along <= high], share, leaf, spill, rng)
        self.right[node] = self._grow(sample[along >= low], share, leaf, spill, rng)
        return node

    def leaves_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf numbers (from 0), a row may have several."""
        rows, leaves, todo = [], [], [(self.root, np.arange(len(vectors)))]
        while todo:
            node, here = todo.pop()
            if not len(here):
                continue
            if node < 0:
                rows.append(here)
                leaves.append(np.full(len(here), -node - 1))
                continue
            along = vectors[here] @ self.directions[node]
            todo += [(self.left[node], here[along <= self.high[node]]), (self.right[node], here[along >= self.low[node]])]
        return np.concatenate(rows), np.concatenate(leaves)


def _mostly_linked(units: np.ndarray, threshold: float) -> bool:
    few = units[::max(1, len(units) // DENSE_SAMPLE)][:DENSE_SAMPLE]
    return bool(np.triu(few @ few.T >= threshold, 1).sum() >= max(1, DENSE * len(few) * (len(few) - 1) / 2))


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """Columns ``id_col``, ``n_links``, ``component_id`` and ``kept``, one row
    per row of ``df``."""
    vector = F.col(vector_col).cast("array<double>")
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    finite = F.coalesce((length > 0) & (length < float("inf")), F.lit(False))  # NaN is above infinity
    rows = df.select(F.col(id_col).alias("id"), F.when(finite, F.transform(vector, lambda x: F.round(x / length, 12)))
                     .alias("unit"), vector.alias("vector")).withColumn("hash", F.xxhash64("unit"))
    classes = materialize(rows.where("unit is not null").groupBy("hash", "unit")
                          .agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.min("vector").alias("vector"))
                          .select(F.monotonically_increasing_id().alias("node"), "*", F.size("unit").alias("dim")))
    placed = materialize(_place(classes, trees, leaf, spill, threshold))
    members = placed.select("leaf_dim", F.explode("leaves").alias("in"), "node", "vector", "copies",
                            F.col("leaves.leaf").alias("leaves"))
    own, other = F.pmod(F.xxhash64("node"), "in.blocks").alias("block"), F.sequence(F.lit(0), F.col("in.blocks") - 1)
    members = members.select("leaf_dim", "in.leaf", own, F.explode(other).alias("other"), "node", "vector", "copies", "leaves")
    found = materialize(members.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
                        .groupBy("leaf_dim", "leaf", "low", "high")
                        .applyInArrow(_compare(threshold), "node long, links long, to long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    named = parts.join(classes.select("node", "first"), "node")
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(smallest, "component").select("node", "smallest")
    every = (classes.select("node", "hash", "unit", "first", "copies").join(links, "node", "left")
             .join(named, "node", "left")
             .select("hash", "unit", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("smallest", "first").alias("component_id")))
    joined = rows.select("id", "hash", "unit").join(every, ["hash", "unit"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


# -- leaves ---------------------------------------------------------------------

def _place(classes: DataFrame, trees: int, leaf: int, spill: float, threshold: float) -> DataFrame:
    """``classes`` with the list of their leaves and the number of blocks in
    which each is compared, no block much too large."""
    forests = {}
    for dim, count in classes.groupBy("dim").count().orderBy("dim").collect():  # one row for each dimension
        share = min(1.0, SAMPLE / count)
        few = classes.where(F.col("dim") == dim).where(
            F.pmod(F.xxhash64("hash"), F.lit(1 << 30)) < int(share * (1 << 30))).select("unit")
        sample = few.toArrow().column(0).combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, dim)
        n_trees = trees if count > leaf else 1
        forests[dim] = [Tree(sample, share, leaf, spill, threshold, np.random.default_rng([SEED, dim, t]))
                        for t in range(n_trees)] if len(sample) else []
    shared = classes.sparkSession.sparkContext.broadcast(forests)  # bounded by the sample
    schema = pa.schema([("node", pa.int64()), ("leaf_dim", pa.int32()), ("leaves", pa.list_(pa.int64()))])

    def run(batches):
        forests = shared.value
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                vectors = batch.column(2).take(pa.array(at)).flatten().to_numpy().reshape(-1, dim).astype(np.float32)
                rows, leaves = [], []
                for number, tree in enumerate(forests[dim]):
                    r, x = tree.leaves_of(vectors)
                    rows.append(r)
                    leaves.append(x + (number << 40))
                rows, leaves = np.concatenate(rows), np.concatenate(leaves)
                order = np.lexsort((leaves, rows))
                offsets = np.searchsorted(rows[order], np.arange(len(at) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), dim, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(leaves[order], pa.int64()))],
                    schema=schema)

    routed = classes.select("node", "dim", "unit").mapInArrow(run, "node long, leaf_dim int, leaves array<long>")
    pending = materialize(routed.select("node", "leaf_dim", F.explode("leaves").alias("leaf")))
    settled, largest, key = None, LARGEST_LEAF * leaf // LEAF, ["leaf_dim", "leaf"]
    while True:
        sizes = pending.groupBy(key).agg(F.count("*").alias("n"))
        large = materialize(sizes.where(F.col("n") > largest).withColumn("blocks", F.ceil(F.col("n") / largest)))
        small = pending.join(large, key, "left_anti").withColumn("blocks", F.lit(1).cast("long"))
        settled = small if settled is None else settled.unionByName(small)
        if large.isEmpty():
            break
        members = pending.join(large, key)
        dense = materialize(_dense(members, classes, threshold))
        halves = materialize(_halve(members.join(dense, key, "left_anti"), classes, spill))
        whole = members.join(dense, key, "left_semi").drop("n").unionByName(halves.where("whole").drop("whole"))
        settled = settled.unionByName(whole)
        pending = halves.where("not whole").drop("whole", "blocks")
    lists = settled.groupBy("node", "leaf_dim").agg(F.sort_array(F.collect_set(F.struct("leaf", "blocks"))).alias("leaves"))
    return lists.join(classes.select("node", "vector", "copies"), "node")


def _dense(members: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The leaves whose members are mostly linked, judged on about
    ``DENSE_SAMPLE`` members of each."""
    def judge(table: pa.Table) -> pa.Table:
        units = table.column("unit").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        return table.select(["leaf_dim", "leaf"]).slice(0, int(_mostly_linked(units, threshold)))

    few = members.where(F.pmod(F.xxhash64("node", "leaf"), "n") < DENSE_SAMPLE).select("leaf_dim", "leaf", "node")
    return (few.join(classes.select("node", "unit"), "node").groupBy("leaf_dim", "leaf")
            .applyInArrow(judge, "leaf_dim int, leaf long"))


def _halve(members: DataFrame, classes: DataFrame, spill: float) -> DataFrame:
    """One more cut of the given leaves at the quantiles of their members;
    ``whole`` marks leaves whose members no cut can part."""
    def run(batches):
        for batch in batches:
            leaves, units = batch.column(2).to_numpy(), batch.column(4)
            along = np.empty(batch.num_rows)
            for leaf in np.unique(leaves):
                at = np.nonzero(leaves == leaf)[0]
                vectors = units.take(pa.array(at)).flatten().to_numpy().reshape(len(at), -1)
                direction = np.random.default_rng([SEED, int(leaf) & ((1 << 63) - 1)]).normal(size=vectors.shape[1])
                along[at] = vectors @ direction
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(along)],
                                             names=["node", "leaf_dim", "leaf", "blocks", "along"])

    along = materialize(members.join(classes.select("node", "unit"), "node")
                        .select("node", "leaf_dim", "leaf", "blocks", "unit")
                        .mapInArrow(run, "node long, leaf_dim int, leaf long, blocks long, along double"))
    cuts = along.groupBy("leaf_dim", "leaf").agg(
        F.percentile_approx("along", 0.5 - spill).alias("low"), F.percentile_approx("along", 0.5 + spill).alias("high"),
        (F.min("along") == F.max("along")).alias("whole"))
    side = lambda n, keep: F.when(keep, F.xxhash64("leaf", F.lit(n)))
    sides = F.array_compact(F.array(side(0, F.col("along") <= F.col("high")), side(1, F.col("along") >= F.col("low"))))
    return along.join(cuts, ["leaf_dim", "leaf"]).select(
        "node", "leaf_dim", F.explode(F.when(F.col("whole"), F.array("leaf")).otherwise(sides)).alias("leaf"), "whole", "blocks")


# -- comparison inside a leaf -----------------------------------------------------

def _compare(threshold: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def leaf_links(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("node").to_numpy(), table.column("block").to_numpy()))
        table = table.take(pa.array(order))
        nodes, copies, here, block = (table.column(c).to_numpy() for c in ("node", "copies", "leaf", "block"))
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(nodes), -1)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        others = _padded(table.column("leaves").to_pylist())
        links, to = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
        edges = [(to[:0], to[:0])]
        # a block with itself, or the rows of one block with those of another
        within = table.column("low")[0] == table.column("high")[0]
        rows = len(nodes) if within else int(np.searchsorted(block, table.column("high")[0].as_py()))
        for at in range(0, rows, ROWS_AT_ONCE):
            end, behind = min(at + ROWS_AT_ONCE, rows), at if within else rows
            near = unit[at:end] @ unit[behind:].T >= threshold
            if within:
                near &= np.arange(at, len(nodes)) > np.arange(at, end)[:, None]
            if np.count_nonzero(near) > PAIRS_AT_ONCE:
                new = (near & ~_share_smaller(others[at:end], others[behind:], here[0])).astype(np.float64)
                links[at:end] += (new @ copies[behind:]).astype(np.int64)  # whole numbers far below 2^53
                links[behind:] += (copies[at:end] @ new).astype(np.int64)
                edges.append(_spanning(near, at, behind))
                continue
            x, y = np.nonzero(near)
            x, y = x + at, y + behind
            edges.append((x, y))
            new = _first_shared(others[x], others[y]) == here[0]
            np.add.at(links, x[new], copies[y[new]])
            np.add.at(links, y[new], copies[x[new]])
        to = _smallest_connected(len(nodes), *(np.concatenate(e) for e in zip(*edges)))
        told = (links > 0) | (to != np.arange(len(nodes)))
        return pa.table([pa.array(nodes[told]), pa.array(links[told]), pa.array(nodes[to[told]])], schema=schema)

    return leaf_links


def _padded(leaves: list[list[int]]) -> np.ndarray:
    """The lists as a matrix, short ones filled up with their last value."""
    width = max(map(len, leaves))
    return np.array([x + x[-1:] * (width - len(x)) for x in leaves], dtype=np.int64)


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value that both rows hold."""
    shared = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return np.where(shared, a, np.iinfo(np.int64).max).min(axis=1)


def _share_smaller(a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """For every pair of rows, whether both hold the same value below ``here``."""
    values = np.intersect1d(a[a < here], b[b < here])
    shared = np.zeros((len(a), len(b)), dtype=bool)
    for i in range(0, len(values), LEAVES_AT_ONCE):
        part = values[i:i + LEAVES_AT_ONCE]
        shared |= _holds(a, part) @ _holds(b, part).T > 0
    return shared


def _holds(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(values, rows), len(values) - 1)
    row, column = np.nonzero(values[at] == rows)
    held = np.zeros((len(rows), len(values)), dtype=np.float32)
    held[row, at[row, column]] = 1
    return held


def _spanning(near: np.ndarray, row: int, column: int) -> tuple[np.ndarray, np.ndarray]:
    """Few edges that connect what the links ``near`` of the members from
    ``row`` on with those from ``column`` on connect."""
    n = len(near)
    label = np.arange(n, dtype=np.int32)
    while True:
        least = np.where(near, label[:, None], n).min(axis=0)  # of each column
        after = np.minimum(label, np.where(near, least, n).min(axis=1))
        if (after == label).all():
            break
        label = after
    linked = np.nonzero(least < n)[0]
    return np.concatenate([np.arange(n), linked + column - row]) + row, np.concatenate([label, least[linked]]) + row


def _smallest_connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the smallest member connected by the edges."""
    to = np.arange(n)
    while True:
        least = np.minimum(to[a], to[b])
        before = to.copy()
        np.minimum.at(to, to[a], least)
        np.minimum.at(to, to[b], least)
        to = to[to]
        if (to == before).all():
            return to
