"""A keyed table followed as a stream: the same predicate, applied to rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.access import read
from ..operators.predicate import Predicate


def follow(spark: SparkSession, path: str, predicate: Predicate | None = None) -> DataFrame:
    """An unbounded DataFrame of the Parquet files that land in path."""
    schema = spark.read.parquet(path).schema
    return read(spark.readStream.schema(schema).parquet(path), predicate)
