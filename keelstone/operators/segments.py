"""Segmented scans: the rows of one segment of a table, and the segment of each row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def segment(df: DataFrame, key: str, i: int, n: int) -> DataFrame:
    """Segment i of n: rows are dealt by the hash of their key, so all segments together are the table."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def with_segment(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn("segment", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
