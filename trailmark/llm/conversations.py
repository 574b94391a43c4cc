"""Conversation structure repair by weighted CYK interval parsing.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``.
Its rows, in the order of their turns, are repaired by edits: Keep, Rerole
to user or assistant, Delete (the only edit of a blank row or of one whose
role and text came before), and Insert of an empty user or assistant row.

The repair grammar is in Chomsky normal form.  A symbol says how the rows
that a span leaves begin and end: E leaves none, UU, UA, AU and AA alternate
from the first letter to the last, S is a system row, SU and SA begin with
one.  A row alone derives the symbols of its edits; two neighbouring spans
derive the symbol of their joined ends where these alternate.  The cell of a
span holds for each symbol the cheapest edits as (cost, audit), audits
compared as text, and is closed under insertion at both of its ends.

Spans of up to ``BLOCK`` rows are parsed bottom-up by span length over all
cuts.  Two audits of a cell that cost the same are never prefixes of each
other (the longer would hold more insertions), so the least of a longer span
is made of least parts, and since a symbol fixes both ends every cut gives
the same cell: longer spans are put together from neighbours of doubled
length, one cut each, and a conversation of n rows costs n log n.

On Spark a conversation is cut into chunks of 2^``TURN_BITS`` turn numbers.  Rows
are shuffled by (conversation, chunk), where the chunk's faults are found
and its cell is parsed, so a conversation with a large share of all rows is
spread over tasks.  What comes back of a text is only its letter; cells are
combined by conversation.  A text of one chunk that came in an earlier one is
told by a mark row there.  Repaired rows are then streamed in order, one
batch in memory; a digest of a whole conversation is sequential by nature,
so this last step reads a conversation in one task.

Defined cases: null roles and texts are one space, and so are null ids and
turns in the key of the damage; rows without a turn come first, rows of
equal turns follow each other by role and text; rows without a conversation
id are one conversation; repeated rows each count; an empty table gives no
rows; a conversation without rows (all were dropped) has zeros, an empty
audit and the digest of an empty text; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

BLOCK = 8
TURN_BITS = 8
NO_TURN = -(1 << 62)  # chunk of the rows without a turn
CELLS_KEPT = 1 << 14
ROWS_AT_ONCE = 2048

#: costs of the edits and of a truncated row that stays
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_ENDS = {"UU": "uu", "UA": "ua", "AU": "au", "AA": "aa"}
_RULES = [(x, y, x[0] + y[1]) for x in _ENDS for y in _ENDS if x[1] != y[0]]
_RULES += [("S", y, "S" + y[1]) for y in ("UU", "UA")]
_RULES += [("S" + x, y, "S" + y[1]) for x, other in (("U", "A"), ("A", "U")) for y in _ENDS if y[0] == other]
_RULES += [("E", "E", "E")] + [r for x in (*_ENDS, "S", "SU", "SA") for r in (("E", x, x), (x, "E", x))]
_LEGAL = ("E", "UA", "SA")
_INSERTED = {"UU": (INSERT, "I"), "AA": (INSERT, "I")}

Cell = dict[str, tuple[int, str]]


def _join(left: Cell, right: Cell, into: Cell) -> None:
    for y, z, x in _RULES:
        if y in left and z in right:
            a, b = left[y], right[z]
            cost = a[0] + b[0]
            if x not in into or cost <= into[x][0]:
                found = (cost, a[1] + b[1])
                if x not in into or found < into[x]:
                    into[x] = found


def _close(cell: Cell) -> Cell:
    """With every insertion of a row before or behind the span that helps."""
    while True:
        before = dict(cell)
        _join(_INSERTED, before, cell)
        _join(before, _INSERTED, cell)
        if cell == before:
            return cell


def _terminal(kind: str) -> Cell:
    """The cell of one row: ``-`` must go; else the role's initial (``o`` for
    any other), in upper case if the row is truncated."""
    cell: Cell = {"E": (DELETE, "D")}
    if kind != "-":
        stays = TRUNCATED if kind.isupper() else 0
        cell |= {"UU": (REROLE + stays, "R"), "AA": (REROLE + stays, "R")}
        kept = {"u": "UU", "a": "AA", "s": "S"}.get(kind.lower())
        if kept:
            cell[kept] = (KEEP + stays, "K")
    return cell


@lru_cache(maxsize=CELLS_KEPT)
def _block(kinds: str) -> Cell:
    cells = {}
    for length in range(1, len(kinds) + 1):
        for i in range(len(kinds) - length + 1):
            cell: Cell = {} if length > 1 else _terminal(kinds[i])
            for cut in range(i + 1, i + length):
                _join(cells[i, cut], cells[cut, i + length], cell)
            cells[i, i + length] = _close(cell)
    return cells[0, len(kinds)]


def combine(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans together."""
    while len(cells) > 1:
        doubled = []
        for i in range(0, len(cells) - 1, 2):
            cell: Cell = {}
            _join(cells[i], cells[i + 1], cell)
            doubled.append(_close(cell))
        cells = doubled + cells[len(cells) - len(cells) % 2:]
    return cells[0] if cells else _close({"E": (0, "")})


def parse(kinds: str) -> Cell:
    """The cell of a span of rows, one letter each (see ``_terminal``)."""
    return combine([_block(kinds[i:i + BLOCK]) for i in range(0, len(kinds), BLOCK)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest edits to a legal conversation."""
    return min(cell[x] for x in _LEGAL if x in cell)


# -- rows -------------------------------------------------------------------------

def rows_of(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", code: Column | None = None) -> DataFrame:
    """Columns ``key``, ``conv``, ``chunk``, ``turn``, ``role``, ``text`` and
    ``code``, as the functions below take them.  ``key`` names the
    conversation and is never null."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return df.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("key"),
        F.col(conv_col).alias("conv"),
        F.coalesce(F.shiftright(F.col(turn_col).cast("long"), TURN_BITS), F.lit(NO_TURN)).alias("chunk"),
        F.col(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"),
        (F.lit(-1) if code is None else code).cast("int").alias("code"), F.lit(False).alias("dropped"))


def damage_code(conv_col: str = "conv_id", turn_col: str = "turn", of: int = 20) -> Column:
    """Which damage a row takes: the CRC-32 of ``conversation:turn`` modulo ``of``."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % of


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after the damage that ``code`` names: 0 drops the row (it stays
    as ``dropped``, so that its conversation does), 1 empties the text, 2
    removes its sentence ends, 3 repeats the row, 4 makes it the user's."""
    code = F.col("code")
    times = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "key", "conv", "chunk", "turn", F.when(code == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(code.isin(0, 1), F.lit("")).when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "code", (code == 0).alias("dropped"), F.explode(times).alias("copy")).drop("copy")


_SPACE = " \t\n\x0b\x0c\r"
_PAIRS = {"su", "ua", "au"}


class _Chunk:
    """What is known of a chunk's rows so far."""

    def __init__(self, key: str, conv, chunk: int):
        self.key, self.conv, self.chunk = key, conv, chunk
        self.seen: set[bytes] = set()
        self.kinds: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role: str, text: str, digest: bytes) -> None:
        shown, initial = text.rstrip(_SPACE), role[:1]
        kind = initial if initial and initial in "sua" else "o"
        if not shown:
            self.blank, kind = self.blank + 1, "-"
        elif digest in self.seen:
            self.duplicate, kind = self.duplicate + 1, "-"
        elif shown[-1] not in ".!?":
            self.truncated, kind = self.truncated + 1, kind.upper()
        self.seen.add(digest)
        self.kinds.append(kind)
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _PAIRS
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low

    def row(self) -> tuple:
        cell = parse("".join(self.kinds))
        names = sorted(cell)
        return (self.key, self.conv, self.chunk, self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated,
                self.illegal, self.first, self.last, names, [cell[x][0] for x in names], [cell[x][1] for x in names])


_CHUNK_FIELDS = [("chunk", "long"), ("low", "long"), ("high", "long"), ("turns", "long"), ("blank", "long"),
                 ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("first", "string"), ("last", "string"),
                 ("symbols", "array<string>"), ("costs", "array<long>"), ("audits", "array<string>")]
_FOUND_FIELDS = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
                 ("cost", "long"), ("audit", "string")]
_ARROW = {"long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}


def _schema(conv: str, fields) -> str:
    return ", ".join(["key string", f"conv {conv}", *(f"{n} {t}" for n, t in fields)])


def _batches(rows: Iterator[tuple], conv: pa.DataType, fields) -> Iterator[pa.RecordBatch]:
    """The rows (key, conv, fields...) as Arrow batches."""
    types = [pa.string(), conv, *(_ARROW[t] for _, t in fields)]
    names, held = ["key", "conv", *(n for n, _ in fields)], []

    def batch():
        columns = zip(*held) if held else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield batch()
            held = []
    yield batch()


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, ROWS_AT_ONCE).columns))


def _ordered(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by, *order)


def _repeated_over_chunks(rows: DataFrame) -> DataFrame:
    """Mark rows (key, chunk, digest) of texts that an earlier chunk of the
    conversation holds.  Only conversations of several chunks are looked at."""
    several = (rows.groupBy("key").agg(F.min("chunk").alias("from"), F.max("chunk").alias("to"))
               .where("from != to").select("key"))
    held = rows.join(several, "key", "left_semi").groupBy("key", "digest", "chunk").agg(F.lit(1).alias("one"))
    first = held.groupBy("key", "digest").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last_")).where("first != last_")
    return held.join(first, ["key", "digest"]).where("chunk > first").select("key", "chunk", "digest", F.lit(True).alias("mark"))


def analyse(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``key``, ``conv``, ``gaps``, the number of
    ``blank``, ``duplicate`` and ``truncated`` rows (each row's first fault)
    and of ``illegal`` neighbours, the ``cost`` of the cheapest repair and
    its ``audit``, the initials of its edits."""
    conv = rows.schema["conv"].dataType.simpleString()
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    rows = rows.select("key", "conv", "chunk", "turn", "role", "text", "dropped", digest.alias("digest"))
    marks = _repeated_over_chunks(rows.where("not dropped").select("key", "chunk", "digest"))
    together = (rows.withColumn("mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
                .select("key", "chunk", "mark", "conv", "turn", "role", "text", "dropped", "digest"))
    together = _ordered(together, ["key", "chunk"], [F.desc("mark"), F.asc_nulls_first("turn"), "role", "text"])

    def chunks(batches):
        def found():
            now, marked = None, set()
            for key, chunk, mark, conv, turn, role, text, dropped, digest in _tuples(batches):
                if now is None or (now.key, now.chunk) != (key, chunk):
                    if now is not None:
                        yield now.row()
                    now = _Chunk(key, conv, chunk)
                if mark:
                    now.seen.add(digest)
                    continue
                now.conv = conv
                if not dropped:
                    now.add(turn, role, text, digest)
            if now is not None:
                yield now.row()
        return _batches(found(), conv_type, _CHUNK_FIELDS)

    def whole(batches):
        def found():
            parts: list[tuple] = []
            for row in _tuples(batches):
                if parts and parts[0][0] != row[0]:
                    yield _whole(parts)
                    parts = []
                parts.append(row)
            if parts:
                yield _whole(parts)
        return _batches(found(), conv_type, _FOUND_FIELDS)

    conv_type = _arrow_type(rows)
    cells = together.mapInArrow(chunks, _schema(conv, _CHUNK_FIELDS))
    return _ordered(cells, ["key"], ["chunk"]).mapInArrow(whole, _schema(conv, _FOUND_FIELDS))


def _arrow_type(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["conv"].dataType)


def _whole(parts: list[tuple]) -> tuple:
    """A conversation from its chunks in order."""
    lows, highs, turns = ([p[i] for p in parts if p[i] is not None] for i in (3, 4, 5))
    gaps = max(highs) - min(lows) + 1 - sum(turns) if lows else 0
    blank, duplicate, truncated, illegal = (sum(p[i] for p in parts) for i in (6, 7, 8, 9))
    full = [p for p in parts if p[10] is not None]
    illegal += sum(a[11] + b[10] not in _PAIRS for a, b in zip(full, full[1:]))
    cost, audit = cheapest(combine([dict(zip(p[12], zip(p[13], p[14]))) for p in full]))
    return (*parts[0][:2], gaps, blank, duplicate, truncated, illegal, cost, audit)


# -- repair -----------------------------------------------------------------------

def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of what the edits of ``audit`` leave of the rows."""
    at = -((len(audit) - audit.count("D")) % 2)  # an odd number begins with a system row
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit != "D":
            yield edit, role if edit == "K" else ("user", "assistant")[at % 2], text
            at += 1


def _conversations(batches) -> Iterator[tuple[tuple, Iterator[tuple[str, str, str]]]]:
    """For each conversation of a sorted stream: what was found of it, and
    its repaired rows, to be read before the next one."""
    stream = _tuples(batches)
    for key, _, *found in stream:
        # the row of findings stands before the conversation's rows
        conv, numbers, audit = found[0], found[4:-1], found[-1]
        own = ((role, text) for _, _, _, _, role, text, *_ in stream)
        yield (key, conv, *numbers, audit), _edited(audit, own)


def _fed(rows: DataFrame, found: DataFrame) -> DataFrame:
    names = [n for n, _ in _FOUND_FIELDS]
    feed = (rows.where("not dropped").select("key", "chunk", "conv", "turn", "role", "text").withColumn("row", F.lit(True))
            .unionByName(found.select("key", "conv", *names, F.lit(False).alias("row")), allowMissingColumns=True)
            .select("key", "row", "conv", "turn", "role", "text", *names))
    return _ordered(feed, ["key"], ["row", F.asc_nulls_first("turn"), "role", "text"])


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired rows: ``key``, ``conv``, ``position`` (from 0), ``edit``,
    ``role`` and ``text``.  ``found`` as ``analyse`` returns it."""
    fields = [("position", "long"), ("edit", "string"), ("role", "string"), ("text", "string")]
    conv_type = _arrow_type(rows)

    def run(batches):
        return _batches(((*about[:2], i, *row) for about, lines in _conversations(batches)
                         for i, row in enumerate(lines)), conv_type, fields)

    return _fed(rows, found).mapInArrow(run, _schema(rows.schema["conv"].dataType.simpleString(), fields))


def with_digest(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``repaired_sha256``: of the repaired rows as
    ``role:text``, joined by newlines."""
    fields = [*_FOUND_FIELDS, ("repaired_sha256", "string")]
    conv_type = _arrow_type(rows)

    def run(batches):
        def digests():
            for about, lines in _conversations(batches):
                sha = hashlib.sha256()
                for i, (_, role, text) in enumerate(lines):
                    sha.update(f"{chr(10) if i else ''}{role}:{text}".encode())
                yield (*about, sha.hexdigest())
        return _batches(digests(), conv_type, fields)

    return _fed(rows, found).mapInArrow(run, _schema(rows.schema["conv"].dataType.simpleString(), fields))
