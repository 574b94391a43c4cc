"""Approximate nearest neighbours by stable projections and kd-trees.

The neighbours of a query are the vectors of the largest inner product.
Candidates are lifted by one component to a common length M and queries are
scaled to it, so that the squared distance is ``2 M^2 - 2 m (inner product)``
with a scale m of the query: the largest products are the nearest points.
Lengths that differ much would make all points nearly as far, so candidates
are grouped by the power of two of their length, each group with its own M.

A point at distance r has, under ``DIMS`` Gaussian (2-stable) projections, a
squared projected distance of r^2 times a chi-square variable.  Projected
neighbours of a query are visited in the order of a kd-tree's leaves, a few
leaves more each time, and verified with the original vectors until the
chi-square test holds: once the next leaf is farther than
``sqrt(quantile(p)) * d``, with d the distance of the k-th neighbour found so
far, a point not yet seen is among the k nearest with a probability below
1 - p.  Inside a visited leaf the same test leaves out single points.

On Spark the upper part of the tree is fitted on a bounded sample
(``SAMPLE`` classes of a group in hash order, at most ``MOST_CELLS`` cells)
and every class is sent to its cell; a large cell is dealt into blocks of
members, each with a tree of its own, and many queries of a cell into blocks
of queries.  Queries first search their own cells; the k-th score found there
bounds the second search, of all cells whose box is near enough to pass the
test.  Only what can still be among the k best comes back.

Equal vectors are one class, which keeps its k + 1 smallest ids, and equal
queries are searched once, so copies cost nothing and lose nothing.

Defined cases: vectors that are null, empty, zero, of a length that is not
finite or that hold a null or non-finite component take no part, nor do rows
without an id; vectors are compared with those of their own dimension; of
rows repeating a query's id the least vector is the query, and no row with
the query's id is its candidate; other repeated rows each count; ties go to
the smaller id.  Scores are sums in double precision of the original
components' products.
"""

from __future__ import annotations

from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

DIMS, CONFIDENCE = 16, 0.95
SAMPLE, MOST_CELLS = 32768, 1024
CELL, LEAF = 16384, 64
QUERY_BLOCK, QUERIES_AT_ONCE = 4096, 256
SEED = 1201


def quantile(p: float, dims: int) -> float:
    """The p-quantile of chi-square with an even number of degrees of freedom."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 10.0 * dims + 200
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class KdTree:
    """Median cuts of points along their widest axis.  ``order`` lists the
    points leaf by leaf, ``starts`` where each leaf begins in it."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.axis, self.cut, self.left, self.right = [], [], [], []
        self.parts: list[np.ndarray] = []
        self.root = self._grow(points, np.arange(len(points)), leaf)
        self.order = np.concatenate(self.parts)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.parts])])

    def _grow(self, points: np.ndarray, here: np.ndarray, leaf: int) -> int:
        own = points[here]
        spread = own.max(axis=0) - own.min(axis=0) if len(here) else np.zeros(1)
        if len(here) <= leaf or not spread.max() > 0:
            self.parts.append(here)
            return -len(self.parts)
        axis = int(spread.argmax())
        values = own[:, axis]
        cut = np.partition(values, len(here) // 2)[len(here) // 2]
        cut = cut if (values < cut).any() else values[values > cut].min()  # the lower half is one value
        node = len(self.axis)
        for held, value in ((self.axis, axis), (self.cut, cut), (self.left, 0), (self.right, 0)):
            held.append(value)
        self.left[node] = self._grow(points, here[values < cut], leaf)
        self.right[node] = self._grow(points, here[values >= cut], leaf)
        return node

    def cells(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point, by the cuts alone."""
        found, todo = np.zeros(len(points), dtype=np.int64), [(self.root, np.arange(len(points)))]
        while todo:
            node, here = todo.pop()
            if node < 0:
                found[here] = -node - 1
            elif len(here):
                below = points[here, self.axis[node]] < self.cut[node]
                todo += [(self.left[node], here[below]), (self.right[node], here[~below])]
        return found


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box."""
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis, None]
        total += np.square(np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0))
    return total


class Group:
    """Candidates of one dimension and one power of two of length."""

    def __init__(self, number: int, dim: int, longest: float, dims: int):
        self.number, self.dim, self.longest = number, dim, longest
        self.directions = np.random.default_rng([SEED, dim]).normal(size=(dim + 1, dims))

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of candidates."""
        rest = np.sqrt(np.maximum(self.longest ** 2 - np.square(vectors).sum(axis=1), 0))
        return vectors @ self.directions[:-1] + rest[:, None] * self.directions[-1]

    def scales(self, queries: np.ndarray) -> np.ndarray:
        return self.longest / np.sqrt(np.square(queries).sum(axis=1))

    def scaled(self, queries: np.ndarray) -> np.ndarray:
        """Projections of queries."""
        return (queries * self.scales(queries)[:, None]) @ self.directions[:-1]

    def reach(self, queries: np.ndarray, scores: np.ndarray, chi: float) -> np.ndarray:
        """Squared projected distance at which the test holds for a k-th score."""
        apart = 2 * self.longest ** 2 - 2 * self.scales(queries) * scores
        return chi * np.maximum(np.nan_to_num(apart, nan=np.inf, posinf=np.inf), 0)


def usable_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns ``id``, ``dim``, ``vec`` and ``band`` (the power of two of the length) of the usable rows."""
    vector = F.col(vector_col)
    length = F.sqrt(F.aggregate(vector.cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"), vector.alias("vec"), length.alias("length"))
            .where("id is not null and dim > 0 and length > 0 and length < double('Infinity')")
            .select("id", "dim", "vec", F.floor(F.log2("length")).cast("int").alias("band")))


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, confidence: float = CONFIDENCE,
            dims: int = DIMS) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``id`` and ``score`` for every
    row of ``queries``; both tables as ``usable_vectors`` makes them."""
    if dims % 2 or not 0 < confidence < 1:
        raise ValueError("dims must be even, confidence between 0 and 1")
    chi, most = quantile(confidence, dims), k + 1
    by_id = Window.partitionBy("dim", "vec").orderBy("id")
    classes = materialize(
        vectors.groupBy("dim", "vec", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"), F.min("band").alias("band"))
        .withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= most)
        .groupBy("dim", "vec").agg(F.min("band").alias("band"), F.min("id").alias("first"),
                                   F.sort_array(F.collect_list(F.struct("id", "copies"))).alias("entries")))
    named = queries.groupBy("id").agg(F.min("vec").alias("vec"))
    asked = materialize(named.groupBy("vec").agg(F.min("id").alias("query"))
                        .select("query", F.size("vec").alias("dim"), "vec"))
    groups = _groups(classes, dims)
    members, boxes = _placed(classes, groups)
    home = _searched(members, _routed(asked.withColumn("floor", F.lit(None).cast("double")), groups, boxes, chi), k, chi, groups)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    near = materialize(home.withColumn("at", F.row_number().over(best)).where(F.col("at") <= most))
    floors = near.where(F.col("at") == most).select("query", F.col("score").alias("floor"))
    beyond = _routed(asked.join(floors, "query", "left").select("query", "dim", "vec", F.coalesce("floor", F.lit(float("-inf")))
                                                              .alias("floor")), groups, boxes, chi)
    found = near.drop("at").unionByName(_searched(members, beyond, k, chi, groups))
    top = (found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= most)
           .select("query", "score", F.inline("entries")))
    best_ids = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = top.withColumn("at", F.row_number().over(best_ids)).where(F.col("at") <= most).drop("at")
    own = named.join(asked.select("query", "vec"), "vec").select(F.col("id").alias("query_id"), "query")
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (own.join(top, "query").where("id != query_id")
            .select("query_id", "score", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


# -- index ------------------------------------------------------------------------

def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _groups(classes: DataFrame, dims: int) -> dict[int, list[tuple[Group, KdTree, int]]]:
    """By dimension: each group with the tree of its cells, fitted on a
    sample, and the band it holds."""
    groups: dict[int, list] = {}
    square = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x)
    rows = classes.groupBy("dim", "band").agg(F.count("*").alias("n"), F.max(square).alias("square")).orderBy("dim", "band").collect()
    for number, row in enumerate(rows):  # one row for each dimension and power of two
        group = Group(number, row["dim"], float(np.sqrt(row["square"])), dims)
        share = min(1.0, SAMPLE / row["n"])
        few = (classes.where((F.col("dim") == row["dim"]) & (F.col("band") == row["band"]))
               .where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vec"))
        sample = few.toArrow().column(0)
        points = group.lifted(_matrix(sample)) if len(sample) else np.zeros((1, dims))
        cells = min(MOST_CELLS, -(-row["n"] // CELL))
        tree = KdTree(points, -(-len(points) // cells))
        tree.parts = tree.order = None  # only the cuts are sent on
        groups.setdefault(row["dim"], []).append((group, tree, row["band"]))
    return groups


def _placed(classes: DataFrame, groups) -> tuple[DataFrame, dict[tuple[int, int], tuple]]:
    """The classes with ``group``, ``cell`` and ``block``, and for each cell
    its box and number of blocks."""
    shared = classes.sparkSession.sparkContext.broadcast(groups)  # bounded by the sample

    def placed(batches):
        for batch in batches:
            dims, bands = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("dim", "band"))
            for dim in np.unique(dims):
                for group, tree, band in shared.value[dim]:
                    at = np.nonzero((dims == dim) & (bands == band))[0]
                    if len(at):
                        part = batch.take(pa.array(at))
                        points = group.lifted(_matrix(part.column(part.schema.get_field_index("vec"))))
                        yield group.number, part, points, tree.cells(points)

    def boxes(batches):
        held: dict[tuple[int, int], list] = {}
        for number, _, points, cells in placed(batches):
            for cell in np.unique(cells):
                own = points[cells == cell]
                low, high, n = held.get((number, cell), (np.inf, -np.inf, 0))
                held[number, cell] = (np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0)), n + len(own))
        rows = [(g, c, i, l, h, n) for (g, c), (low, high, n) in held.items() for i, (l, h) in enumerate(zip(low, high))]
        columns = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)],
                                         names=["group", "cell", "axis", "low", "high", "n"])

    sums = (classes.select("dim", "band", "vec").mapInArrow(boxes, "group int, cell long, axis int, low double, high double, n long")
            .groupBy("group", "cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
            .orderBy("group", "cell", "axis").collect())  # DIMS rows for each of the bounded number of cells
    found: dict[tuple[int, int], tuple] = {}
    for r in sums:
        low, high, _ = found.setdefault((r["group"], r["cell"]), ([], [], -(-r["n"] // (2 * CELL))))
        low.append(r["low"])
        high.append(r["high"])
    counts = classes.sparkSession.sparkContext.broadcast({key: blocks for key, (_, _, blocks) in found.items()})

    def run(batches):
        for number, part, _, cells in placed(batches):
            blocks = np.array([counts.value[number, c] for c in cells], dtype=np.int64)
            first = part.column(part.schema.get_field_index("first")).to_numpy()
            kept = part.select(["first", "vec", "entries"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cells), number, dtype=np.int32)), pa.array(cells), pa.array(_mixed(first) % blocks), *kept.columns],
                names=["group", "cell", "block", "first", "vec", "entries"])

    kind = classes.schema["vec"].dataType.simpleString()
    return classes.mapInArrow(run, f"group int, cell long, block long, first long, vec {kind}, "
                                   "entries array<struct<id:bigint,copies:int>>"), found


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Ids as well-spread numbers that are not negative."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(20)).astype(np.int64)


# -- search -----------------------------------------------------------------------

def _routed(asked: DataFrame, groups, boxes, chi: float) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """The queries (``query``, ``dim``, ``vec``, ``floor``) with a row for
    each cell and block they search: their own cells where ``floor`` is null,
    else every other cell that the test does not rule out.  Also, for each
    cell, into how many parts its queries are dealt."""
    shared = asked.sparkSession.sparkContext.broadcast((groups, boxes))

    def routes(batches):
        groups, boxes = shared.value
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                vectors = _matrix(batch.column(2).take(pa.array(at)))
                floors = batch.column(3).to_numpy(zero_copy_only=False).astype(float)[at]
                for group, tree, _ in groups.get(dim, []):
                    cells = [c for g, c in boxes if g == group.number]
                    low, high, blocks = (np.array(x) for x in zip(*(boxes[group.number, c] for c in cells)))
                    points = group.scaled(vectors)
                    away = box_distances(points, low, high)
                    home = away.argmin(axis=1)[:, None] == np.arange(len(cells))
                    near = ~home & (away <= group.reach(vectors, floors, chi)[:, None])
                    row, column = np.nonzero(np.where(np.isnan(floors)[:, None], home, near))
                    yield batch, at[row], group.number, np.array(cells)[column], blocks[column]

    def counts(batches):
        found: dict[tuple[int, int], int] = {}
        for _, rows, number, cells, _ in routes(batches):
            for cell, n in zip(*np.unique(cells, return_counts=True)):
                found[number, cell] = found.get((number, cell), 0) + int(n)
        rows = [(g, c, n) for (g, c), n in found.items()]
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
                                         names=["group", "cell", "n"])

    sizes = (asked.mapInArrow(counts, "group int, cell long, n long").groupBy("group", "cell").agg(F.sum("n").alias("n"))
             .select("group", "cell", F.ceil(F.col("n") / QUERY_BLOCK).cast("long").alias("parts")))
    parts = {(r["group"], r["cell"]): r["parts"] for r in sizes.collect()}  # a row for each cell

    def run(batches):
        for batch, rows, number, cells, blocks in routes(batches):
            of = np.array([parts[number, c] for c in cells], dtype=np.int64)
            copies = np.repeat(np.arange(len(rows)), blocks)
            block = np.arange(len(copies)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            query = batch.column(0).to_numpy()[rows]
            part = _mixed(query) % np.maximum(of, 1)
            taken = batch.take(pa.array(rows[copies]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(copies), number, dtype=np.int32)), pa.array(cells[copies]), pa.array(block.astype(np.int64)),
                 pa.array(part[copies]), pa.array(of[copies]), taken.column(0), taken.column(2), taken.column(3)],
                names=["group", "cell", "block", "part", "parts", "query", "vec", "floor"])

    kind = asked.schema["vec"].dataType.simpleString()
    routed = asked.mapInArrow(run, f"group int, cell long, block long, part long, parts long, query long, vec {kind}, floor double")
    return routed, parts


def _searched(members: DataFrame, routes: tuple[DataFrame, dict], k: int, chi: float, groups) -> DataFrame:
    """Columns ``query``, ``score``, ``first`` and ``entries``: of each cell's
    block the best k + 1 classes of every query sent there."""
    spark, (routed, parts) = members.sparkSession, routes
    cells = spark.createDataFrame([(g, c, p) for (g, c), p in parts.items()], "group int, cell long, parts long")
    dealt = (members.join(F.broadcast(cells), ["group", "cell"])  # a row for each cell
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))))
    keys = ["group", "cell", "block", "part"]
    shared = spark.sparkContext.broadcast({g.number: g for found in groups.values() for g, _, _ in found})
    schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("first", pa.int64()),
                        ("entries", pa.list_(pa.struct([("id", pa.int64()), ("copies", pa.int32())])))])

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return schema.empty_table()
        group = shared.value[asked.column("group")[0].as_py()]
        query, first = asked.column("query").to_numpy(), held.column("first").to_numpy()
        vectors, queries = _matrix(held.column("vec")), _matrix(asked.column("vec"))
        floors = np.nan_to_num(asked.column("floor").to_numpy().astype(float), nan=-np.inf, neginf=-np.inf)
        rows, at, scores = search(group, vectors, first, queries, floors, k + 1, chi)
        return pa.table([pa.array(query[rows]), pa.array(scores), pa.array(first[at]),
                         held.column("entries").combine_chunks().take(pa.array(at))], schema=schema)

    return (routed.groupBy(*keys).cogroup(dealt.groupBy(*keys))
            .applyInArrow(run, "query long, score double, first long, entries array<struct<id:bigint,copies:int>>"))


def search(group: Group, vectors: np.ndarray, names: np.ndarray, queries: np.ndarray, floors: np.ndarray, most: int,
           chi: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every query the ``most`` best vectors found (ties to the smaller
    name) that score at least its floor: rows of queries, rows of vectors and scores."""
    points = group.lifted(vectors)
    tree = KdTree(points, LEAF)
    vectors, points, names = vectors[tree.order], points[tree.order], names[tree.order]
    leaves = list(zip(tree.starts, tree.starts[1:]))
    low = np.array([points[a:b].min(axis=0) for a, b in leaves])
    high = np.array([points[a:b].max(axis=0) for a, b in leaves])
    found = []
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        own = queries[start:start + QUERIES_AT_ONCE]
        best, at = _visited(group, vectors, points, names, leaves, (low, high), own, floors[start:start + len(own)], most, chi)
        row, column = np.nonzero(at >= 0)
        exact = (vectors[at[row, column]] * own[row]).sum(axis=1)  # the same sum wherever the pair meets
        kept = exact >= floors[start + row]
        found.append((start + row[kept], tree.order[at[row, column][kept]], exact[kept]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _visited(group, vectors, points, names, leaves, boxes, queries, floors, most, chi):
    """Scores and rows of the best vectors of each query, leaf after leaf."""
    projected = group.scaled(queries)
    away = box_distances(projected, *boxes)
    order = np.argsort(away, axis=1, kind="stable")
    away = np.take_along_axis(away, order, axis=1)
    best = np.full((len(queries), most), -np.inf)
    at = np.full((len(queries), most), -1)
    active, next_, step = np.arange(len(queries)), 0, 1
    while len(active) and next_ < len(leaves):
        reach = group.reach(queries, np.maximum(best[:, -1], floors), chi)
        active = active[away[active, next_] <= reach[active]]  # the test holds for the others
        upto = min(next_ + step, len(leaves))
        row, column = np.nonzero(away[active, next_:upto] <= reach[active, None])
        row, leaf = active[row], order[active[row], next_ + column]
        by_leaf = np.argsort(leaf, kind="stable")
        bounds = np.nonzero(np.diff(leaf[by_leaf]))[0] + 1
        for rows, same in zip(np.split(row[by_leaf], bounds), np.split(leaf[by_leaf], bounds)):
            if len(rows):
                a, b = leaves[same[0]]
                _verify(vectors, points, names, a, b, queries, projected, rows, reach, best, at)
        next_, step = upto, 2 * step
    return best, at


def _verify(vectors, points, names, a, b, queries, projected, rows, reach, best, at) -> None:
    """Takes the points of a leaf that pass the test into the best of the queries ``rows``."""
    own = projected[rows]
    apart = np.square(own).sum(axis=1)[:, None] + np.square(points[a:b]).sum(axis=1) - 2 * own @ points[a:b].T
    near = apart <= reach[rows, None] * (1 + 1e-9)
    columns = np.nonzero(near.any(axis=0))[0]
    if not len(columns):
        return
    scores = np.where(near[:, columns], queries[rows] @ vectors[a + columns].T, -np.inf)
    better = (scores >= best[rows, -1, None]).any(axis=1) & (scores > -np.inf).any(axis=1)
    rows, scores = rows[better], scores[better]
    every = np.hstack([best[rows], scores])
    which = np.hstack([at[rows], np.broadcast_to(a + columns, scores.shape)])
    which[every == -np.inf] = -1
    order = np.lexsort((np.where(which >= 0, names[which], np.iinfo(np.int64).max), -every), axis=1)[:, :best.shape[1]]
    best[rows], at[rows] = np.take_along_axis(every, order, axis=1), np.take_along_axis(which, order, axis=1)
