"""Corpus preparation in stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the docs of the next one:

1. ``toxicity`` drops the documents that the classifier rejects;
2. ``near_duplicates`` keeps one document of each SimHash group;
3. ``pii`` replaces personal data in the texts by its kind;
4. ``packing`` returns the pieces of the remaining documents with their
   sequence and offset.

All but the last return the columns of ``documents``.  Rows with a null
text are scored, grouped and packed as empty texts and stay null in
between; an empty table gives empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import packing, pii, simhash, toxicity
from trailmark.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the classifier
    learns from the labels of the documents at hand."""
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_column(docs, network) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows that repeat an
    id with another text stay or go with their own group."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without personal data; the lengths of changed texts are counted anew."""
    clean = pii.redacted("text")
    length = F.when(clean == F.col("text"), F.col("n_chars")).otherwise(F.length(clean))
    new = {"text": clean.alias("text"), "n_chars": F.coalesce(length, "n_chars").cast("long").alias("n_chars")}
    return docs.select(*(new.get(c, F.col(f"`{c}`")) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("pii", redact), ("packing", pack)]

#: DuckDB cannot tokenize, train or hash as the stages do; tests/llm hold them against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for number, (name, stage) in enumerate(STAGES):
        written = f"{place}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
