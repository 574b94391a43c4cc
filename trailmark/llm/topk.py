"""Exact top-k search by inner product, by distributed histogram selection.

Vector components become integers, ``floor(scale * x)``, so scores are
integers too.  Queries and candidates are dealt into blocks, and a task
scores one block of queries against one block of candidates.  Each pass
scores everything and counts, for every query, the scores by bins of the
interval that holds its k-th value; the counts are added up over all blocks
and the interval shrinks to the bin of the k-th value.  The first interval
is the range that the longest vector allows, and after
log(range) / log(``BINS``) passes an interval is a single score.  A last
pass keeps what scores above it, and of the ties on it the smallest ids.

What a block sends is bounded: bins below its own k-th score cannot hold
the k-th score of all and are left out, and of the ties a block keeps k.
Intervals are a table joined to the queries; nothing grows on the driver.

Defined cases: vectors that are null, empty or hold a null or non-finite
component take no part, nor do rows without an id; vectors are compared
with those of their own dimension; of rows repeating a query's id the least
vector is the query, and no row with the query's id is its candidate;
other repeated rows each count; ties go to the smaller id.  Scores are
exact below 2^53 in size and wrap like a long beyond 2^63.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BINS = 1024
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096
_EXACT = 1 << 53


def integer_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: int = 256) -> DataFrame:
    """Columns ``id``, ``dim`` and ``vec`` (array of long) of the usable rows."""
    vector = F.col(vector_col).cast("array<double>")
    usable = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above infinity
    return (df.where(F.col(id_col).isNotNull() & (F.size(vector) > 0) & usable)
            .select(F.col(id_col).cast("long").alias("id"), F.size(vector).alias("dim"),
                    F.transform(vector, lambda x: F.floor(x * scale).cast("long")).alias("vec")))


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 5) -> DataFrame:
    """Columns ``query_id``, ``rank`` (from 1), ``id`` and ``score`` for every
    row of ``queries``; both tables as ``integer_vectors`` makes them."""
    vectors = materialize(vectors)
    queries = queries.groupBy("id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    count, longest = vectors.select(F.count("*"), F.max(_square("vec"))).first()
    n_queries, longest_query = queries.select(F.count("*"), F.max(_square("vec"))).first()
    bound = min(int(math.sqrt(longest or 0) * math.sqrt(longest_query or 0)) + 2, 1 << 61)
    blocks = -(-count // CANDIDATE_BLOCK), -(-n_queries // QUERY_BLOCK)
    exact = bound * 2 < _EXACT  # then float64 products are exact
    asked = materialize(queries.select(
        "id", "dim", "vec", F.lit(-bound).cast("long").alias("low"), F.lit(bound + 1).cast("long").alias("high"),
        F.lit(0).cast("long").alias("above")))
    width = 2 * bound + 1
    while width > 1:
        step = -(-width // BINS)
        counts = (_scored(vectors, asked, blocks, _histogram(k, step, exact), "query_id long, bin int, n long")
                  .groupBy("query_id", "bin").agg(F.sum("n").alias("n")))
        asked = materialize(_narrowed(asked, counts, k, step))
        width = step
    found = _scored(vectors, asked, blocks, _above(k, exact), "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def _square(column: str) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def _scored(vectors: DataFrame, asked: DataFrame, blocks: tuple[int, int], task, schema: str) -> DataFrame:
    """Runs ``task(queries, candidates)`` for each pair of blocks."""
    candidate_blocks, query_blocks = blocks
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.lit(max(1, n))).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
    left = asked.select("*", hashed(query_blocks).alias("qb"), every(candidate_blocks).alias("cb"))
    right = vectors.select("*", hashed(candidate_blocks).alias("cb"), every(query_blocks).alias("qb"))
    keys = ["dim", "qb", "cb"]

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        return task(queries, candidates)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _scores(queries: pa.Table, candidates: pa.Table, exact: bool):
    """Query ids, candidate ids in ascending order, and their scores; the
    scores of a query with itself are masked."""
    ids = candidates.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, asked = ids[order], queries.column("id").to_numpy()
    kind = np.float64 if exact else np.int64
    scores = (_matrix(queries).astype(kind) @ _matrix(candidates)[order].astype(kind).T).astype(np.int64)
    return asked, ids, scores, asked[:, None] == ids[None, :]


def _histogram(k: int, step: int, exact: bool):
    schema = pa.schema([("query_id", pa.int64()), ("bin", pa.int32()), ("n", pa.int64())])

    def task(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        asked, _, scores, own = _scores(queries, candidates, exact)
        low, high = queries.column("low").to_numpy(), queries.column("high").to_numpy()
        inside = (scores >= low[:, None]) & (scores < high[:, None]) & ~own
        row, column = np.nonzero(inside)
        bins = (scores[row, column] - low[row]) // step
        counts = np.bincount(row * BINS + bins, minlength=len(asked) * BINS).reshape(-1, BINS)
        higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        row, column = np.nonzero((counts > 0) & (higher < k))
        return pa.table([pa.array(asked[row]), pa.array(column.astype(np.int32)),
                         pa.array(counts[row, column].astype(np.int64))], schema=schema)

    return task


def _narrowed(asked: DataFrame, counts: DataFrame, k: int, step: int) -> DataFrame:
    """Each query's interval cut down to the bin of its k-th value; a query
    with fewer than k candidates keeps the lowest score of all."""
    down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
    state = asked.select(F.col("id").alias("query_id"), "low", "high", "above")
    reached = (counts.withColumn("to", F.sum("n").over(down)).join(state, "query_id")
               .where((F.col("above") + F.col("to") >= k) & (F.col("above") + F.col("to") - F.col("n") < k))
               .select("query_id", (F.col("low") + F.col("bin") * F.lit(step)).alias("new_low"),
                       (F.col("above") + F.col("to") - F.col("n")).alias("new_above")))
    low = F.coalesce("new_low", "low")
    return asked.join(reached.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", "dim", "vec", low.alias("low"), F.least(low + F.lit(step), "high").alias("high"),
        F.coalesce("new_above", "above").cast("long").alias("above"))


def _above(k: int, exact: bool):
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def task(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        asked, ids, scores, own = _scores(queries, candidates, exact)
        least = queries.column("low").to_numpy()[:, None]
        ties = (scores == least) & ~own
        wanted = (scores > least) & ~own | ties & (ties.cumsum(axis=1) <= k)  # ids ascend
        row, column = np.nonzero(wanted)
        return pa.table([pa.array(asked[row]), pa.array(ids[column]), pa.array(scores[row, column])], schema=schema)

    return task
