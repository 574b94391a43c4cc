"""Run the reference's jobs on text logs.

    python -m trailmark.cli hot-items   --input behavior.csv [--stream] [--out DIR]
    python -m trailmark.cli hot-urls    --input access.log
    python -m trailmark.cli page-views  --input behavior.csv
    python -m trailmark.cli unique-visitors [--bitmap] --input behavior.csv
    python -m trailmark.cli login-fail  --input logins.csv [--within "2 seconds"]
    python -m trailmark.cli order-timeout --input orders.csv [--within "15 minutes"]
    python -m trailmark.cli tx-match    --input orders.csv --receipts receipts.csv [--bound "5 seconds"] [--one-to-one]
    python -m trailmark.cli tx-join     --input orders.csv --receipts receipts.csv

Batch mode reads the files whole; ``--stream`` treats ``--input`` (and
``--receipts``) as folders watched for new files, with the reference's
watermarks (ascending, or 1 s / 5 s out of order, and 1 min allowed lateness
for URLs).  Every result row is written to ``--out`` as Parquet or, without
it, printed by the executors under the job's label; ``--preview N`` shows
the first N rows (of each micro-batch) on the driver instead.  Jobs with
several outputs carry an ``output`` column, the label of each row, and
``--out`` is partitioned by it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.plans import jobs, streams
from trailmark.session import get_session, scratch_path
from trailmark.sources import logs, sinks

# The labels the reference prints its outputs under.
LABELS = {
    "hot-items": "processedData", "hot-urls": "urlResutl", "page-views": "page view",
    "unique-visitors": "uv", "unique-visitors-bitmap": "uv with bloom job", "login-fail": "结果",
    "order-timeout": "order", "tx-match": "tx", "tx-join": "joined",
}
# The labels of jobs with several outputs, by the value that tells them apart
OUTPUTS = {
    "order-timeout": ("result_msg", {"payed successfully": "payed", "timeout": "timeout"}),
    "tx-match": ("status", {"matched": "matched ", "unmatched_pay": "pay unmatched",
                            "unmatched_receipt": "receipt unmatched"}),
}


def _batch(spark, args):
    read = lambda kind, path: logs.read_log(spark, kind, path)
    job = args.job
    if job == "hot-items":
        return jobs.hot_items(read("behavior", args.input), n=args.n or 3)
    if job == "hot-urls":
        return jobs.hot_urls(read("access", args.input), n=args.n or 5)
    if job == "page-views":
        return jobs.page_views(read("behavior", args.input))
    if job == "unique-visitors":
        b = read("behavior", args.input)
        return jobs.unique_visitors_bitmap(b) if args.bitmap else jobs.unique_visitors(b)
    if job == "login-fail":
        return jobs.login_fail(read("login", args.input), within=args.within or "2 seconds")
    if job == "order-timeout":
        return jobs.order_timeout(read("order", args.input), within=args.within or "15 minutes")
    if job == "tx-match":
        return jobs.tx_match(read("order", args.input), read("receipt", args.receipts), one_to_one=args.one_to_one, **_band(args))
    return jobs.tx_interval_join(read("order", args.input), read("receipt", args.receipts), **_band(args))


def _band(args) -> dict:
    return {"lower": f"-{args.bound}", "upper": args.bound} if args.bound else {}


def _stream(spark, args, sink, state):
    """The stream, its ``foreachBatch`` function if it has its own, and its
    output mode.  ``state`` is a path for tables kept between batches."""
    job = args.job
    if job == "hot-items":
        return *streams.hot_items(spark, args.input, n=args.n or 3, sink=sink), "append"
    if job == "hot-urls":
        return *streams.hot_urls(spark, args.input, n=args.n or 5, sink=sink, table=state), "update"
    if job == "page-views":
        return *streams.page_views(spark, args.input), "update"
    if job == "unique-visitors" and args.bitmap:
        return *streams.running_unique_visitors(spark, args.input, table=state, sink=sink), "append"
    if job == "unique-visitors":
        return *streams.unique_visitors(spark, args.input), "update"
    if job == "login-fail":
        return *streams.login_fail(spark, args.input, within=args.within or "2 seconds"), "append"
    if job == "order-timeout":
        return *streams.order_timeout(spark, args.input, within=args.within or "15 minutes"), "append"
    if job == "tx-match":
        return *streams.tx_match(spark, args.input, args.receipts, bound=args.bound or "5 seconds"), "append"
    return *streams.tx_interval_join(spark, args.input, args.receipts, **_band(args)), "append"


def _labelled(df: DataFrame, job: str) -> DataFrame:
    """With the column ``output`` for a job that has several outputs."""
    if job not in OUTPUTS:
        return df
    column, labels = OUTPUTS[job]
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return df.withColumn("output", F.try_element_at(names, F.col(column)))


def _show(df: DataFrame, args, label: str) -> None:
    if args.preview:
        df.show(args.preview, truncate=False)
    elif args.job in OUTPUTS:
        sinks.print_rows(df, label_col="output")
    else:
        sinks.print_rows(df, label)


def _write(df: DataFrame, args) -> None:
    parts = ["output"] if args.job in OUTPUTS else []
    df.write.mode("overwrite").partitionBy(*parts).parquet(args.out)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="trailmark")
    ap.add_argument("job", choices=sorted(k for k in LABELS if k != "unique-visitors-bitmap"))
    ap.add_argument("--input", required=True)
    ap.add_argument("--receipts")
    ap.add_argument("--n", type=int)
    ap.add_argument("--within")
    ap.add_argument("--bound", help="how far a pay and a receipt may be apart")
    ap.add_argument("--one-to-one", action="store_true", help="use every row at most once (always so with --stream)")
    ap.add_argument("--bitmap", action="store_true")
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--available-now", action="store_true", help="with --stream: stop when all files there are read")
    ap.add_argument("--out")
    ap.add_argument("--checkpoint")
    ap.add_argument("--preview", type=int, metavar="N")
    return ap


def _checked(argv):
    ap = parser()
    args = ap.parse_args(argv)
    for given, jobs_of in ((args.within, ("login-fail", "order-timeout")), (args.bitmap, ("unique-visitors",)),
                           (args.n, ("hot-items", "hot-urls")), (args.receipts, ("tx-match", "tx-join")), (args.bound, ("tx-match", "tx-join")),
                           (args.one_to_one, ("tx-match",))):
        if given and args.job not in jobs_of:
            ap.error(f"an option of {', '.join(jobs_of)} does not apply to {args.job}")
    if args.job in ("tx-match", "tx-join") and not args.receipts:
        ap.error(f"{args.job} needs --receipts")
    if (args.checkpoint or args.available_now) and not args.stream:
        ap.error("--checkpoint and --available-now belong to --stream")
    if args.preview and args.out:
        ap.error("--preview and --out exclude each other")
    return args


def main(argv=None):
    args = _checked(argv)
    spark = get_session()
    label = LABELS["unique-visitors-bitmap" if args.bitmap else args.job]
    if not args.stream:
        df = _labelled(_batch(spark, args), args.job)
        if args.out:
            _write(df, args)
        else:
            _show(df, args, label)
        return df
    # stream state and progress live in the shared checkpoint folder unless given
    checkpoint = args.checkpoint or scratch_path(spark, f"stream-{args.job}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = _labelled(batch, args.job)
        if not args.out:
            _show(batch, args, label)
        elif keeps_newest:
            sinks.upsert_by_window(args.out)(batch, batch_id)
        else:
            sinks.append_batches(args.out)(batch, batch_id)

    df, each_batch, mode = _stream(spark, args, sink, f"{checkpoint}/state")
    # a newer count replaces the one before; reports are kept each time they are made
    keeps_newest = mode == "update" and each_batch is None
    q = sinks.write_stream(df, label.replace(" ", "_"), output_mode=mode, checkpoint=f"{checkpoint}/query",
                           foreach_batch=each_batch or sink,
                           trigger={"availableNow": True} if args.available_now else None)
    q.awaitTermination()
    return None


if __name__ == "__main__":
    main()
