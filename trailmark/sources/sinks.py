"""Sinks (S7, S8): every row of a result leaves through the executors."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def print_rows(df: DataFrame, label: str | None = None, *, label_col: str | None = None) -> None:
    """Print every row as ``label> {json}``, all under one label or each
    under that of its column ``label_col``, in one pass.  The rows are printed where they
    are, by the executors (their standard error, as Spark's Python workers
    keep it); nothing is collected and nothing is left out."""
    def show(rows) -> None:
        for row in rows:
            print(f"{row[0]}> {row[1]}", file=sys.stderr, flush=True)
    name = F.lit(label) if label_col is None else F.col(label_col)
    df.select(name, F.to_json(F.struct(*[F.col(c) for c in df.columns if c != label_col]))).foreachPartition(show)


def write_stream(df: DataFrame, label: str, *, fmt: str = "print", output_mode: str = "append",
                 checkpoint: str | None = None, path: str | None = None,
                 trigger: dict | None = None, foreach_batch=None,
                 preview_rows: int = 20) -> StreamingQuery:
    """Start a streaming query named ``label`` (the reference's
    ``print(label)``): ``print`` prints every row (see :func:`print_rows`),
    ``memory`` keeps a table named ``label``, any other format is written at
    ``path``, or a ``foreach_batch`` function takes each micro-batch.
    ``console`` is Spark's preview: the first ``preview_rows`` rows of a
    micro-batch only, so ask for it by name."""
    if foreach_batch is not None and path:
        raise ValueError("foreach_batch writes its own output: a path would be ignored")
    w = df.writeStream.queryName(label).outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if foreach_batch is None and fmt == "print":
        foreach_batch = lambda batch, batch_id: print_rows(batch, label)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(fmt)
    if fmt == "console":
        w = w.option("truncate", "false").option("numRows", preview_rows)
    return w.start(path) if path else w.start()


def append_batches(path: str, *, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch completely under
    ``path``; a repeated batch replaces what it wrote before."""
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").format(fmt).save(path))
    return run


def upsert_by_window(path: str, *, window_col: str = "window_end", fmt: str = "parquet"):
    """A ``foreachBatch`` function keeping the newest row per window.

    Each micro-batch (update mode: the windows that changed) overwrites
    only the ``window_col`` partitions it contains (dynamic partition
    overwrite), the file-table form of the reference's keyed ``hset``.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(window_col).format(fmt).save(path))
    return run
