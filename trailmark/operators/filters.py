"""Row filters, as plain column predicates Catalyst pushes into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_behavior(df: DataFrame, value: str = "pv", col: str = "behavior") -> DataFrame:
    """Keep rows whose behaviour column equals ``value``."""
    return df.where(F.col(col) == F.lit(value))


def filter_nonempty_key(df: DataFrame, col: str = "tx_id") -> DataFrame:
    """Drop rows whose key is empty (or NULL)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != F.lit("")))
