"""Kafka source of behaviour lines.

The reference consumes topic ``hotitems`` with group ``consumer-group`` from
the latest offsets and parses each value as a behaviour line.  The Kafka
connector jar is not part of a plain PySpark install, so this is only the
stream definition; without the jar ``load()`` raises, and tests feed the
same parser from the file source instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.sources.logs import parse_behavior_lines


def kafka_lines(spark: SparkSession, *, bootstrap_servers: str, topic: str = "hotitems",
                group_id: str = "consumer-group", starting_offsets: str = "latest",
                **options) -> DataFrame:
    """A streaming DataFrame with one ``value STRING`` column per record."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("kafka.group.id", group_id)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def kafka_behavior_stream(spark: SparkSession, **kwargs) -> DataFrame:
    """S2 + S1: parsed behaviour records from Kafka."""
    return parse_behavior_lines(kafka_lines(spark, **kwargs))
