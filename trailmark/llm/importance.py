"""Importance resampling of documents towards a target distribution.

Texts are lower-cased (A-Z) and everything between words, the runs of other
than 0-9, a-z and non-ASCII characters, collapses to single spaces.  One
regular expression for each n, run with ``overlapped=True`` and lookarounds
at word boundaries, then emits the span of every run of n consecutive words,
and the CRC-32 of the span's bytes modulo ``buckets`` is the feature.

Texts are scanned once: a document is kept as the list of its features
(two bytes each, or counts by bucket where that is shorter).  Bucket counts
of all documents and of the target texts are added up by partial sums, the
gains of the buckets follow from them, and a document's weight is the floored
mean of its features' gains.  Adding Gumbel noise that is a hash of the id
and taking the highest scores draws documents in proportion to the exponent
of their weights, without replacement.

The drawn documents are ranked without a global sort: scores are integers of
a range that the gains bound (about 150,000 values), so the counts by score
tell the last score that is drawn and the rank at which each score starts;
only inside a score documents are ordered, by id.  Fully equal rows are
counted and written out again from their count.

Defined cases: a null text has no words, a document without features has
weight 0; an empty target or corpus gives gains from the add-one counts
alone; the hash of a null id is that of the bare prefix, and null ids rank
first among equal scores; repeated rows are drawn each on their own; no rows
give no rows; other columns are not carried.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .rows import slices, text_rows

BUCKETS, MOST_WORDS = 10_000, 2
COPIES_AT_ONCE = 1 << 14

# Bytes that belong to no word, and A-Z in lower case
_PLAIN = bytes(0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F
               else c + 0x20 if 0x41 <= c <= 0x5A else c for c in range(256))


def span_patterns(most_words: int) -> list[regex.Pattern]:
    """For each n up to ``most_words``, what matches n words from a word's
    start to a word's end in a text with single spaces."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(1, most_words + 1)]


def features(text: str, patterns: list[regex.Pattern], buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words of a text and the buckets of all its features."""
    plain = b" ".join(text.encode().translate(_PLAIN).split())
    found = [np.fromiter((crc32(m[0]) for m in p.finditer(plain, overlapped=True)), dtype=np.uint32) for p in patterns]
    return len(found[0]), np.concatenate(found) % buckets


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         most_words: int = MOST_WORDS) -> DataFrame:
    """Columns ``id``, ``n_words``, ``n_features``, ``found`` (binary): the
    buckets of all features as unsigned 16-bit integers or, where
    ``counted``, the 32-bit count of each bucket."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be from 1 to 65536")
    rows = text_rows(docs, id_col, text_col)
    names = ["id", "n_words", "n_features", "counted", "found"]

    def run(batches):
        patterns = span_patterns(most_words)
        for batch in slices(batches):
            values = []
            for text in batch.column(1).to_pylist():
                n_words, found = features(text, patterns, buckets)
                counted = 2 * len(found) > 4 * buckets
                packed = np.bincount(found, minlength=buckets).astype("<u4") if counted else found.astype("<u2")
                values.append((n_words, len(found), counted, packed.tobytes()))
            columns = list(zip(*values)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], names=names)

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_words long, n_features long, counted boolean, found binary")


def _counts(counted: bool, found: bytes, buckets: int) -> np.ndarray:
    return np.frombuffer(found, "<u4") if counted else np.bincount(np.frombuffer(found, "<u2"), minlength=buckets)


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket: partial sums for each task, added up
    by bucket, so ``buckets`` numbers reach the driver."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            short = [f for c, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if not c]
            total += np.bincount(np.frombuffer(b"".join(short), "<u2"), minlength=buckets)
            for c, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c:
                    total += np.frombuffer(f, "<u4")
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], names=["bucket", "n"])

    sums = (scanned.select("counted", "found").mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(buckets, dtype=np.int64)
    for row in sums:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` of each of B buckets."""
    s, t, b = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weights(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """``scanned`` without the features, with ``weight``: the floored mean of their gains."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            kept = batch.select(["id", "n_words", "n_features"])
            weight = [int(gain @ _counts(c, f, buckets)) // n if n else 0 for n, c, f in zip(
                *(batch.column(x).to_pylist() for x in ("n_features", "counted", "found")))]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(weight, pa.int64())],
                                             names=["id", "n_words", "n_features", "weight"])

    id_type = scanned.schema["id"].dataType.simpleString()
    return scanned.mapInArrow(run, f"id {id_type}, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: int) -> F.Column:
    """``floor(-1000 ln(-ln u))`` where u is a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             target_id_col: str = "item_id", percent: int = 25, least_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, most_words: int = MOST_WORDS) -> DataFrame:
    """Columns ``id_col``, ``n_features``, ``weight``, ``score`` and ``rank``
    of every row of ``docs``.  Of the N documents with at least
    ``least_words`` words, ``floor(percent N / 100)`` are drawn and ranked
    from 1; ``rank`` is null for the others."""
    how = dict(text_col=text_col, buckets=buckets, most_words=most_words)
    scanned = materialize(scan(docs, id_col=id_col, **how))
    gain = gains(bucket_counts(scanned, buckets),
                 bucket_counts(scan(target, id_col=target_id_col, **how), buckets))
    scored = materialize(weights(scanned, gain).select(
        "id", "n_features", "weight", (F.col("weight") + gumbel("id", seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible")))
    # as many rows as there are scores, a range bounded by the gains and the hash
    by_score = sorted(((r["score"], r["n"]) for r in scored.where("eligible").groupBy("score")
                       .agg(F.count("*").alias("n")).collect()), reverse=True)
    draw, starts, before = sum(n for _, n in by_score) * percent // 100, [], 0
    for score, n in by_score:
        if before >= draw:
            break
        starts.append((score, before))
        before += n
    starts = docs.sparkSession.createDataFrame(starts, "score long, start long")
    chosen = scored.where("eligible").join(F.broadcast(starts), "score")  # bounded like the scores
    left = (scored.where("not eligible").unionByName(scored.where("eligible").join(F.broadcast(starts), "score", "left_anti"))
            .select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
    inside = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_first(), "n_features", "weight")
    runs = (chosen.groupBy("score", "start", "id", "n_features", "weight").agg(F.count("*").alias("copies"))
            .withColumn("first", F.col("start") + F.sum("copies").over(inside) - F.col("copies")))
    ranked = _copies(runs).withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return ranked.unionByName(left).withColumnRenamed("id", id_col)


def _copies(runs: DataFrame) -> DataFrame:
    """A row for each copy with its rank; long runs are dealt in pieces."""
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    columns = ["id", "n_features", "weight", "score"]
    short = runs.where(F.col("copies") <= COPIES_AT_ONCE).select(*columns, "first", F.explode(upto(F.col("copies"))).alias("at"))
    pieces = (runs.where(F.col("copies") > COPIES_AT_ONCE)
              .withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("long"))))
              .repartition("id", "from"))
    size = F.least(F.col("copies") - F.col("from"), F.lit(COPIES_AT_ONCE))
    long_ = pieces.select(*columns, (F.col("first") + F.col("from")).alias("first"), F.explode(upto(size)).alias("at"))
    return short.unionByName(long_).select(*columns, (F.col("first") + F.col("at") + 1).alias("rank"))
