"""Best-fit packing of whole documents into sequences of bounded length.

A document's token ids are followed by an end id; only what is longer than
the capacity is cut into pieces.  Pieces are packed by large-item matching:
pieces above a third of the capacity share a bin with at most one other of
their kind, matched greedily (the longest with the longest that still
fits); shorter pieces then go, longest first, to the fullest bin that still
takes them.

Bins depend on lengths alone, so the plan is made from the histogram of
piece lengths: at most ``capacity`` rows whatever the input, and it moves
whole runs of equal pieces and equal bins at once.  Each piece then finds
its place by its rank among the pieces of its length.  Ranks are counted in
salted groups of a length, so a length that a third of all pieces share is
no single task.

Defined cases: a null or empty text is one piece that holds the end id
only; repeated rows are packed each on their own; pieces of null ids are
packed like others; no rows give no rows; other columns are not carried.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bpe import BYTES_AT_ONCE, default_tokenizer, word_bpe
from .rows import sized_slices, text_rows

CAPACITY = 4096
#: pieces of one length that are ranked together, about
RANKED_TOGETHER = 20_000


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = 1, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, if asked for, ``ids`` (binary, little-endian unsigned
    32-bit)."""
    path = tokenizer or default_tokenizer()
    rows = text_rows(docs, id_col, text_col)
    end = struct.pack("<I", end_id)
    fields = [("piece", pa.int32(), "int"), ("start", pa.int64(), "long"), ("length", pa.int64(), "long"),
              ("ids_crc32", pa.int64(), "long")] + [("ids", pa.binary(), "binary")] * with_ids

    def run(batches):
        encode = word_bpe(path).encode_many
        for batch in sized_slices(batches, BYTES_AT_ONCE):
            source, found = [], []
            for row, ids in enumerate(encode(batch.column(1))):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    source.append(row)
                    found.append((number, at // 4, len(part) // 4, zlib.crc32(part), part)[:len(fields)])
            columns = list(zip(*found)) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int32())),
                 *(pa.array(v, t) for v, (_, t, _) in zip(columns, fields))],
                names=[id_col, *(f[0] for f in fields)])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"`{id_col}` {id_type}", *(f"{n} {t}" for n, _, t in fields)]))


class Plan:
    """Places for runs of equal pieces.  A run covers the ranks from
    ``first`` on of one length and puts ``each`` pieces, from ``offset`` on,
    into every bin from ``bin`` on."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.runs: list[tuple[int, int, int, int, int]] = []  # length, first, bin, each, offset
        self.left = {n: c for n, c in histogram.items() if c}
        self.taken: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first bin, bins)
        large = sorted(n for n in self.left if 3 * n > capacity)
        small = sorted((n for n in self.left if 3 * n <= capacity), reverse=True)
        self._match(large)
        self._fill(small)
        table = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 5)
        self.key = table[:, 0] << 44 | table[:, 1]
        self.first, self.bin, self.each, self.offset = table[:, 1:].T.copy()

    def _put(self, length: int, bin_: int, bins: int, each: int, offset: int, count: int) -> None:
        self.runs.append((length, self.taken[length], bin_, each, offset))
        self.taken[length] += count
        self.left[length] -= count

    def _new(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _match(self, lengths: list[int]) -> None:
        """Pairs of large pieces, longest first; ``lengths`` ascends."""
        while lengths:
            longest = lengths[-1]
            at = bisect_left(lengths, self.capacity - longest + 1) - 1
            if at >= 0 and lengths[at] == longest and self.left[longest] == 1:
                at -= 1
            n = self.left[longest]
            if at < 0:
                bin_, gap = self._new(n), self.capacity - longest
                self._put(longest, bin_, n, 1, 0, n)
            elif lengths[at] == longest:
                n //= 2
                bin_, gap = self._new(n), self.capacity - 2 * longest
                self._put(longest, bin_, n, 2, 0, 2 * n)
            else:
                other = lengths[at]
                n = min(n, self.left[other])
                bin_, gap = self._new(n), self.capacity - longest - other
                self._put(longest, bin_, n, 1, 0, n)
                self._put(other, bin_, n, 1, longest, n)
                if not self.left[other]:
                    del lengths[at]
            self.open[gap].append((bin_, n))
            if not self.left[longest]:
                lengths.pop()

    def _fill(self, lengths: list[int]) -> None:
        """Smaller pieces into the smallest gap that takes them; ``lengths`` descends."""
        gaps = sorted(self.open)

        def reopen(gap: int, bin_: int, bins: int) -> None:
            if bins and gap:
                if not self.open[gap] and (not gaps or bisect_left(gaps, gap) == len(gaps)
                                           or gaps[bisect_left(gaps, gap)] != gap):
                    insort(gaps, gap)
                self.open[gap].append((bin_, bins))

        for length in lengths:
            while (n := self.left[length]):
                at = bisect_left(gaps, length)
                if at < len(gaps):
                    gap = gaps[at]
                    bin_, bins = self.open[gap].pop()
                    if not self.open[gap]:
                        del gaps[at]
                    each = gap // length
                    full = min(bins, n // each)
                else:
                    gap, each = self.capacity, self.capacity // length
                    full = n // each
                    bins = full + (n % each > 0)
                    bin_ = self._new(bins)
                offset = self.capacity - gap
                if full:
                    self._put(length, bin_, full, each, offset, full * each)
                    reopen(gap - each * length, bin_, full)
                    bin_, bins, n = bin_ + full, bins - full, n - full * each
                if bins and n and n < each:
                    self._put(length, bin_, 1, n, offset, n)
                    reopen(gap - n * length, bin_, 1)
                    bin_, bins = bin_ + 1, bins - 1
                reopen(gap, bin_, bins)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of pieces by length and rank."""
        run = np.searchsorted(self.key, length << 44 | rank, side="right") - 1
        bins, slot = np.divmod(rank - self.first[run], self.each[run])
        return self.bin[run] + bins, self.offset[run] + slot * length


def assign(found: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (a table that reads the same each time, with ``length`` from
    1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    lengths = {r["length"]: r["n__"] for r in found.groupBy("length").agg(F.count("*").alias("n__")).collect()}
    salts = found.sparkSession.createDataFrame(
        [(n, -(-c // RANKED_TOGETHER)) for n, c in lengths.items()], "length long, salts__ long")
    # equal rows part as well: the table reads the same each time, so a row keeps its place in it
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("salts__")).cast("int")
    salted = found.join(F.broadcast(salts), "length").select(*found.columns, dealt.alias("salt__"))
    sizes = materialize(salted.groupBy("length", "salt__").agg(F.count("*").alias("n__")))
    plan = Plan(lengths, capacity)  # at most ``capacity`` lengths
    before = Window.partitionBy("length").orderBy("salt__")
    starts = sizes.select("length", "salt__", (F.sum("n__").over(before) - F.col("n__")).alias("first__"))
    inside = Window.partitionBy("length", "salt__").orderBy(*found.columns)
    ranked = (salted.withColumn("row__", F.row_number().over(inside) - 1)
              .join(starts, ["length", "salt__"])
              .select(*found.columns, (F.col("first__") + F.col("row__")).cast("long").alias("rank__")))
    at, names = found.columns.index("length"), [*found.columns, "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at, batch.num_columns - 1))
            bins, offset = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bins), pa.array(offset)], names=names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return ranked.mapInArrow(run, f"{kept}, sequence_id long, offset long")


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = 1, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places: ``sequence_id`` and the
    gapless ``offset`` in it."""
    found = pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id,
                   tokenizer=tokenizer, with_ids=with_ids)
    return assign(materialize(found), capacity=capacity)
