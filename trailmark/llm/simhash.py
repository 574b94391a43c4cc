"""SimHash near-duplicate detection by pigeonhole blocks.

Every text gets a 64-bit fingerprint: words between ASCII white space after
lower-casing A-Z, shingles of consecutive words (repeats included, a text
with fewer words is one shingle), XXH64 of each shingle, and a bit is set
when it is set in over half the hashes.  Two fingerprints link when they
differ in at most ``max_bits`` bits.

Equal fingerprints are collapsed first.  A fingerprint is cut into
``max_bits + 3`` blocks; two that differ in ``max_bits`` bits agree on at
least three of them, so they meet under one of the keys made of three
blocks (ten keys of 38 bits and more for two bits: at 10^10 texts a bucket
still holds about one fingerprint by chance).  Buckets are joined and every
pair is verified by its Hamming distance.

A bucket may hold many fingerprints when the corpus has a large family of
near copies.  The fingerprints of buckets above ``HOT_BUCKET`` are linked in
another, equally exact way that stays linear: each is written under itself
and its 64 one-bit neighbours.  Two fingerprints differ in at most two bits
exactly if they meet under one such value, and at most 65 can, all within
two bits of each other; they are linked to the smallest.

Defined cases: null and empty texts have fingerprint zero, which links like
any other; repeated rows each give a row; rows without an id take part but
name no component (a component of such rows only has a null id).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components
from .rows import map_texts

HOT_BUCKET = 64
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    digest, join = xxhash.xxh64_digest, b" ".join
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = words[at:min(n, at + HASHES_AT_ONCE) + shingle - 1]
        rows = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = np.frombuffer(b"".join([digest(join(r), seed) for r in rows]), dtype=np.uint8)
        ones += np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """Columns ``id_col`` and ``fingerprint`` (long), one row per row."""
    return map_texts(docs, id_col, text_col, lambda: lambda t: (fingerprint(t, shingle, seed),),
                     [("fingerprint", pa.int64(), "long")])


def near_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly the distinct ``fingerprint``
    values of ``prints`` that differ in at most ``max_bits`` (0 to 2) bits."""
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits must be 0, 1 or 2")
    keys = prints.select("fingerprint", F.posexplode(_block_keys("fingerprint", max_bits)).alias("block", "key"))
    sizes = keys.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(keys.join(sizes, ["block", "key"]))
    a = shared.where(F.col("n") <= HOT_BUCKET).select("block", "key", F.col("fingerprint").alias("a"))
    pairs = (a.join(a.withColumnRenamed("a", "b"), ["block", "key"]).where("a < b")
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b"))
    hot = shared.where(F.col("n") > HOT_BUCKET).select("fingerprint").distinct()
    return pairs.unionByName(_ball_links(hot, max_bits))


def _block_keys(column: str, max_bits: int):
    """Array of the fingerprint masked to every choice of three blocks."""
    blocks = max_bits + 3
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum((1 << hi) - (1 << lo) for lo, hi in chosen)
             for chosen in combinations(list(zip(edges, edges[1:])), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*(F.col(column).bitwiseAND(F.lit(m).cast("long")) for m in signed))


def _ball_links(hot: DataFrame, max_bits: int) -> DataFrame:
    print_ = F.col("fingerprint")
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)),
                        lambda i: print_.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    met = (hot.select("fingerprint", F.explode(F.concat(F.array(print_), flips)).alias("value"))
           .groupBy("value").agg(F.sort_array(F.collect_list("fingerprint")).alias("near")).where(F.size("near") > 1))
    if max_bits == 2:
        star = met.select(F.element_at("near", 1).alias("a"), F.explode("near").alias("b"))
    else:  # only the value's own fingerprint is within one bit of all the others
        star = met.where(F.array_contains("near", F.col("value"))).select(
            F.col("value").alias("a"), F.explode("near").alias("b"))
    return star.where("a != b") if max_bits else star.limit(0)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    seed: int = 42, max_bits: int = 2) -> DataFrame:
    """Columns ``id_col``, ``fingerprint`` (long) and ``component_id`` (the
    smallest id reachable by links, itself included), one row per row."""
    prints = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed)
                         .withColumnRenamed(id_col, "id"))
    distinct = prints.groupBy("fingerprint").agg(F.min("id").alias("first"))
    linked = materialize(connected_components(near_links(distinct, max_bits))
                         .withColumnRenamed("node", "fingerprint"))
    smallest = (linked.join(distinct, "fingerprint").groupBy("component").agg(F.min("first").alias("component_id")))
    named = linked.join(smallest, "component").select("fingerprint", "component_id")
    every = distinct.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(every, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents with one of each component, all columns unchanged: the
    smallest id stays.  An id names the rows that share its text: of rows
    that repeat both, the least in column order stays, and rows of one id
    with other texts stay or go with their own components.  Rows without an
    id cannot be named and stay."""
    digest = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    # rows without an id come last, so that they name no component with others in it
    name = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), digest.alias("digest"))
    found = near_duplicates(docs.select(name.alias("name"), F.col(text_col).alias("text")), id_col="name", text_col="text", **how)
    kept = found.where((F.col("name") == F.col("component_id")) & ~F.col("name.unnamed")).select("name.id", "name.digest").distinct()
    # by plain columns: structs that differ in nullability would be cast, and the documents dealt again
    named = docs.where(F.col(id_col).isNotNull()).select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), digest.alias("digest"))
    # rows of one name have one text (or null and empty ones): ordering by it would only carry it twice
    ordered = [F.col("doc")[f.name].isNotNull() if f.name == text_col else F.col("doc")[f.name] for f in docs.schema.fields
               if f.dataType.typeName() not in ("map", "variant", "struct", "array")]
    # grouped first: the join then finds the documents dealt by name already
    one = (named.groupBy("id", "digest")
           .agg(F.min_by("doc", F.struct(*ordered)).alias("doc"))
           .join(kept, ["id", "digest"], "left_semi").select("doc.*"))
    return one.unionByName(docs.where(F.col(id_col).isNull()))
