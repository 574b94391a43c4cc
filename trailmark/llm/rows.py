"""Small helpers shared by the operators that run Arrow batches through Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows handled together inside a task; bounds the size of one output batch
ROWS_AT_ONCE = 256
#: bytes of texts that are Python strings at once
TEXT_BYTES = 1 << 20

_HELD: dict = {}  # of a Python worker


def held(key, make: Callable):
    """What ``make()`` has returned for ``key``.  A Python worker keeps it
    from task to task, but only that of one key: workers outlive their stage,
    and the tables and caches of several would add up in them."""
    if key not in _HELD:
        let_go()
        _HELD[key] = make()
    return _HELD[key]


def let_go() -> None:
    """Drop what an earlier task of this worker has left behind."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()


def text_rows(df: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """Only the id and the whole text (null becomes empty), plus ``more``
    columns; every other column of ``df`` is left behind, so that its name
    cannot clash with a result column."""
    return df.select(F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The given batches cut into pieces of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sized_slices(batches: Iterator[pa.RecordBatch], size: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """The given batches cut into pieces whose texts (in ``column``) have at
    most ``size`` bytes together; a larger text is a piece alone."""
    for batch in batches:
        for start, stop in _bounds(batch.column(column), size):
            yield batch.slice(start, stop - start)


def _bounds(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Start and end of stretches of at most ``size`` bytes together, or of one larger text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield start, stop
        start = stop


def each_text(batches: Iterator[pa.Array], of: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    """``of`` every text (null: None) in order, for an iterator UDF; only
    ``TEXT_BYTES`` of the texts or one larger text are Python strings at once."""
    for texts in batches:
        for start, stop in _bounds(texts, TEXT_BYTES):
            yield pa.array([of(t) for t in texts.slice(start, stop - start).to_pylist()], kind)


def map_texts(df: DataFrame, id_col: str, text_col: str, make: Callable, fields: list[tuple[str, pa.DataType, str]],
              together: int = 0) -> DataFrame:
    """One result row per input row: ``make()`` is called once per task and
    returns a function from a text to the tuple of result values; ``fields``
    are (name, Arrow type, Spark type).  With ``together`` the function takes
    an Arrow array of texts of about so many bytes and returns a list of tuples."""
    rows = text_rows(df, id_col, text_col)
    names = [id_col, *(f[0] for f in fields)]
    id_type = rows.schema["id"].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {id_type}", *(f"`{n}` {t}" for n, _, t in fields)])

    def run(batches):
        each = make()
        for batch in sized_slices(batches, together) if together else slices(batches):
            values = each(batch.column(1)) if together else [each(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*values)) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, t) for v, (_, t, _) in zip(columns, fields))], names=names)

    return rows.mapInArrow(run, schema)
