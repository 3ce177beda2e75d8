"""Keyed layouts: a table in folders by the hash of its key, read by access path.

A row's bucket is crc32 of its hash key as text, modulo the number of buckets. A predicate that fixes hash keys reads the buckets of these keys
alone, which the plan shows as a partition filter; any other reads the table. Keys must be texts, whole numbers or booleans.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.access import classify, read
from ..operators.predicate import Predicate
from .tables import TableDef

BUCKET = "key_bucket"
FILES = 4


def bucket_of(value: object, buckets: int) -> int:
    text = str(value).lower() if isinstance(value, bool) else str(value)
    return zlib.crc32(text.encode()) % buckets


def bucket_column(key: str, buckets: int) -> Column:
    return (F.crc32(F.col(key).cast("string").cast("binary")) % buckets).cast("int")


def write_layout(df: DataFrame, path: str, table: TableDef, buckets: int = 64, format: str = "parquet") -> None:
    """Each bucket in up to FILES files, sorted by key; a hot key's rows are dealt to these files by their content, not to one task."""
    keys = [k for k in (table.hash_key, table.range_key) if k]
    deal = F.pmod(F.xxhash64(*df.columns), F.lit(FILES))
    rows = df.withColumn(BUCKET, bucket_column(table.hash_key, buckets)).repartition(buckets * FILES, BUCKET, deal)
    rows.sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).format(format).save(path)


def read_layout(spark: SparkSession, path: str, table: TableDef, predicate: Predicate | None, schema, buckets: int = 64, format: str = "parquet") -> DataFrame:
    """The rows that the predicate holds for. schema: that of the table; rows with a null key lie in a folder of their own."""
    df = spark.read.schema(f"{_ddl(schema)}, {BUCKET} int").format(format).load(path)
    plan = classify(table, predicate)
    if plan.kind == "branches":
        df = df.where(F.col(BUCKET).isin(sorted({bucket_of(b.hash_value, buckets) for b in plan.branches})))
    return read(df, predicate).drop(BUCKET)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
