"""One-to-one reconciliation of two tables (J3), each row used at most once.

The rows of a key are taken in the order of time and ``seq``; a row matches
the oldest waiting row of the other side that is at most ``bound`` away, and
a row that has waited longer stays unmatched.  Per key this is a walk of two
pointers over both sides: the rows under them match if they are close enough,
else the earlier one stays alone.

Such matches chain without limit (one more pay moves all later pairs), but a
key need not be one group.  Time is cut into blocks of ``BLOCK_FACTOR`` times
the bound; a block also gets the rows of the last ``bound`` before it, which
may still wait there.  What comes before a block matters to it by one number
only: how many of those rows wait, of which side (rows of both never wait
together).  A first pass therefore walks every block from each of its
possible entries at once - walks that meet go on as one - and keeps, for each
entry, the number with which the block is left.  These small tables are
chained by key in time order; a block after a gap longer than the bound has
no entries but the empty one, which cuts a key into segments.  A second pass
walks each block once from its now known entry and writes its rows: a pair
in the block of its later row, a row that stays alone where its wait ends.

Rows are shuffled by (key, block), so a key with a large share of all rows
is spread over its blocks; what a task holds is one block of one key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.functions.time import epoch_micros
from trailmark.operators.durations import duration_micros
from trailmark.operators.matching import MATCHED, UNMATCHED_LEFT, UNMATCHED_RIGHT
from trailmark.operators.ordered import floor_to

BLOCK_FACTOR = 4
FEW_WALKS = 4


def reconcile_one_to_one(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, left_ts: str, right_ts: str,
                         left_seq: str, right_seq: str, bound="5 seconds", unit: str = "s", left_carry=None,
                         right_carry=None, prefixes=("pay_", "receipt_"), key_out: str | None = None,
                         status_col: str = "status", block_factor: int = BLOCK_FACTOR) -> DataFrame:
    """Matched pairs and the unmatched rows of both sides, every input row in
    exactly one row: the columns of :func:`matching.reconcile`.  Rows of a
    side with equal times are taken by ``seq``.  Rows with a NULL key or time
    are unmatched."""
    bound_us = duration_micros(bound)
    if bound_us < 0 or block_factor < 1:
        raise ValueError("the bound must not be negative, blocks not shorter than the bound")
    width = max(block_factor * bound_us, 1)
    lcols, rcols = [*(left_carry or left.columns)], [*(right_carry or right.columns)]

    def side(df, key, ts, seq, cols, prefix, is_left):
        return df.select(F.col(key).alias("_k"), epoch_micros(df, ts, unit).alias("_t"), F.col(seq).alias("_seq"),
                         F.lit(is_left).alias("_left"), F.struct(*[F.col(c).alias(prefix + c) for c in cols]).alias("_l" if is_left else "_r"))

    both = (side(left, left_key, left_ts, left_seq, lcols, prefixes[0], True)
            .unionByName(side(right, right_key, right_ts, right_seq, rcols, prefixes[1], False), allowMissingColumns=True))
    placed = both.where("_k is not null and _t is not null")
    blk = floor_to(F.col("_t"), width)
    waits = F.col("_t") >= blk + F.lit(width - bound_us)  # may wait in the next block
    blocks = F.when(waits, F.array(blk, blk + F.lit(width))).otherwise(F.array(blk))
    rows = (placed.select("*", F.posexplode(blocks).alias("_copy", "_blk")))
    key_type = both.schema["_k"].dataType.simpleString()

    def ordered(df):
        return df.repartition("_k", "_blk").sortWithinPartitions("_k", "_blk", "_left", "_t", "_seq")

    def maps(batches):
        for table, groups in _groups(batches):
            t, is_left, blk = (table.column(c).to_pylist() for c in ("_t", "_left", "_blk"))
            starts, low, exits = [], [], []
            for a, b in groups:
                m = bisect_left(is_left, True, a, b)
                before, found = _exits(t[m:b], t[a:m], blk[a], width, bound_us)
                starts.append(a)
                low.append(before)
                exits.append(found)
            keys = table.select(["_k", "_blk"]).take(pa.array(starts, pa.int64()))
            yield from keys.append_column("_low", pa.array(low, pa.int64())).append_column(
                "_exits", pa.array(exits, pa.list_(pa.int64()))).to_batches()

    def entries(batches):
        key, at, state = None, None, 0
        for batch in batches:
            found = []
            for k, blk, low, exits in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key or blk != at:
                    state = 0  # nothing of this key in the block before
                found.append(state)
                key, at, state = k, blk + width, exits[state + low]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int64())], names=["_k", "_blk", "_entry"])

    chained = (ordered(rows.select("_k", "_blk", "_left", "_t", "_seq"))
               .mapInArrow(maps, f"_k {key_type}, _blk long, _low long, _exits array<long>")
               .repartition("_k").sortWithinPartitions("_k", "_blk")
               .mapInArrow(entries, f"_k {key_type}, _blk long, _entry long"))
    # the entry of a block is a row before its others; only what differs from nothing is told
    told = chained.where("_entry != 0").withColumn("_t", F.col("_blk"))
    fed = (rows.drop("_copy").unionByName(told, allowMissingColumns=True).repartition("_k", "_blk")
           .sortWithinPartitions("_k", "_blk", F.asc_nulls_first("_left"), "_t", "_seq")
           .select("_k", "_blk", "_left", "_t", "_entry", "_l", "_r"))
    structs = {c: both.schema[c].dataType.simpleString() for c in ("_l", "_r")}

    def walk(batches):
        for table, groups in _groups(batches):
            t, blk, entry, is_left = (table.column(c).to_pylist() for c in ("_t", "_blk", "_entry", "_left"))
            pays, receipts = [], []
            for a, b in groups:
                state = entry[a] if is_left[a] is None else 0
                a += is_left[a] is None
                m = bisect_left(is_left, True, a, b)
                for i, j in _walk(t[m:b], t[a:m], blk[b - 1], width, bound_us, state):
                    pays.append(None if i is None else m + i)
                    receipts.append(None if j is None else a + j)
            one = [r if p is None else p for p, r in zip(pays, receipts)]
            status = [UNMATCHED_LEFT if r is None else UNMATCHED_RIGHT if p is None else MATCHED for p, r in zip(pays, receipts)]
            yield from pa.table([table.column("_k").take(pa.array(one, pa.int64())), table.column("_l").take(pa.array(pays, pa.int64())),
                                 table.column("_r").take(pa.array(receipts, pa.int64())), pa.array(status, pa.string())],
                                names=["_k", "_l", "_r", "_status"]).to_batches()

    found = fed.mapInArrow(walk, f"_k {key_type}, _l {structs['_l']}, _r {structs['_r']}, _status string")
    alone = both.where("_k is null or _t is null").select(
        "_k", "_l", "_r", F.when(F.col("_left"), F.lit(UNMATCHED_LEFT)).otherwise(F.lit(UNMATCHED_RIGHT)).alias("_status"))
    return found.unionByName(alone).select(F.col("_k").alias(key_out or left_key), "_l.*", "_r.*", F.col("_status").alias(status_col))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole (key, block) groups, with the rows of each group."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, last: bool):
        key, blk = table.column("_k"), table.column("_blk").to_numpy()
        same = pc.equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False).astype(bool)
        edges = [0, *(np.nonzero(~(same & (blk[1:] == blk[:-1])))[0] + 1).tolist(), len(blk)]
        if not last:
            edges.pop()
        return table.slice(0, edges[-1]), list(zip(edges, edges[1:])), table.slice(edges[-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        first, rest = held[0], batch
        if len(held) > 1 and (first.column(0)[0] == rest.column(0)[-1] and first.column(1)[0] == rest.column(1)[-1]):
            continue  # still the same group
        whole, groups, left = cut(pa.Table.from_batches(held).combine_chunks(), False)
        if groups:
            yield whole, groups
        held = left.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield cut(table, True)[:2]


def _exits(pays: list, receipts: list, start: int, width: int, bound: int) -> tuple[int, list[int]]:
    """For each entry of a block, from as many waiting receipts as may wait
    (negative) to as many pays, the number with which the block is left.
    Also the number of receipts that may wait."""
    old_pays, old_receipts = bisect_left(pays, start), bisect_left(receipts, start)
    until = start + width - bound
    late_pays, late_receipts = len(pays) - bisect_left(pays, until), len(receipts) - bisect_left(receipts, until)
    if old_pays + old_receipts < FEW_WALKS:
        found = []
        for state in range(-old_receipts, old_pays + 1):
            x, y = _end(pays, receipts, old_pays - max(state, 0), old_receipts - max(-state, 0), bound)
            found.append(min(len(pays) - x, late_pays) - min(len(receipts) - y, late_receipts))
        return old_receipts, found
    pays, receipts = np.array(pays, dtype=np.int64), np.array(receipts, dtype=np.int64)
    entry = np.arange(-old_receipts, old_pays + 1)
    i, j = old_pays - np.maximum(entry, 0), old_receipts - np.maximum(-entry, 0)
    walks = np.arange(len(entry))  # which walk an entry is on
    while len(i) > FEW_WALKS and ((i < len(pays)) & (j < len(receipts))).any():
        # those with the fewest rows behind them take a step: walks that meet do so in the same round
        open_ = (i < len(pays)) & (j < len(receipts))
        on = np.nonzero(open_ & (i + j == (i + j)[open_].min()))[0]
        apart = pays[i[on]] - receipts[j[on]]
        i[on] += apart <= bound
        j[on] += apart >= -bound
        new = np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1]))  # walks do not cross: met ones are neighbours
        walks, i, j = (np.cumsum(new) - 1)[walks], i[new], j[new]
    if len(i) <= FEW_WALKS:
        ends = [_end(pays.tolist(), receipts.tolist(), x, y, bound) for x, y in zip(i.tolist(), j.tolist())]
        i, j = np.array(ends).T
    left = np.minimum(len(pays) - i, late_pays) - np.minimum(len(receipts) - j, late_receipts)
    return old_receipts, left[walks].tolist()


def _end(pays: list, receipts: list, i: int, j: int, bound: int) -> tuple[int, int]:
    while i < len(pays) and j < len(receipts):
        apart = pays[i] - receipts[j]
        i, j = i + (apart <= bound), j + (apart >= -bound)
    return i, j


def _walk(pays: list, receipts: list, start: int, width: int, bound: int, entry: int) -> Iterator[tuple]:
    """The rows of a block from its entry on: (pay, receipt), None for a side that is missing."""
    i = bisect_left(pays, start) - max(entry, 0)
    j = bisect_left(receipts, start) - max(-entry, 0)
    while i < len(pays) and j < len(receipts):
        apart = pays[i] - receipts[j]
        if abs(apart) <= bound:
            yield i, j
        else:
            yield (i, None) if apart < 0 else (None, j)
        i, j = i + (apart <= bound), j + (apart >= -bound)
    # what still may wait in the next block is written there
    until = start + width - bound
    yield from ((x, None) for x in range(i, len(pays)) if pays[x] < until)
    yield from ((None, x) for x in range(j, len(receipts)) if receipts[x] < until)
