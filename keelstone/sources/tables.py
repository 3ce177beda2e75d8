"""Table definitions and the catalogue that resolves them to read-only views."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableDef:
    """A table with a hash key and perhaps a range key; mapper: a key mapper's configuration."""

    name: str
    hash_key: str
    range_key: str | None = None
    mapper: tuple | None = None


#: Keys of the bundled star schema. lineitem's pair is not unique: no row is ever dropped by key.
STAR = [TableDef("region", "r_regionkey"), TableDef("nation", "n_nationkey"), TableDef("customer", "c_custkey"), TableDef("supplier", "s_suppkey"), TableDef("part", "p_partkey"), TableDef("orders", "o_orderkey"), TableDef("lineitem", "l_orderkey", "l_linenumber"), TableDef("events", "user_id", "ts"), TableDef("conversations", "conv_id", "turn")]


class Catalog:
    """Tables of a folder of Parquet files. mappers: (pattern, configuration); the first whose pattern is the whole name is taken."""

    def __init__(self, spark: SparkSession, path: str, tables: list[TableDef] = STAR, mappers: list[tuple[str, dict]] = ()):  # noqa: B006
        self.spark, self.path, self.mappers = spark, path, list(mappers)
        self.tables = {t.name: t for t in tables}

    def names(self) -> list[str]:
        return sorted(self.tables)

    def get(self, name: str) -> TableDef:
        own = next((c for p, c in self.mappers if re.fullmatch(p, name)), None)
        table = self.tables[name]
        return replace(table, mapper=tuple(own.items())) if own else table

    def load(self, name: str) -> DataFrame:
        from ..operators.keymap import map_keys, mapper

        table, df = self.get(name), self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return map_keys(df, mapper(dict(table.mapper)), table.hash_key, table.range_key) if table.mapper else df

    def register(self) -> None:
        """A temporary view for every table."""
        for name in self.names():
            self.load(name).createOrReplaceTempView(name)

    def stats(self) -> DataFrame:
        """name and row count of every table: counted, in one job that reads no column."""
        from functools import reduce

        each = [self.load(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in self.names()]
        return reduce(DataFrame.union, each)

    def listing(self) -> DataFrame:
        return self.spark.createDataFrame([(t.name, t.hash_key, t.range_key) for t in map(self.get, self.names())], "name string, hash_key string, range_key string")
