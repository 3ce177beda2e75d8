"""A Python data source over JSON-lines items: keys as columns, the whole item as JSON text.

    spark.dataSource.register(ItemSource)
    spark.read.format("keyed_items").options(path=..., hash="pk", range="sort").load()

A scan reads every file once: a partition is a run of split_bytes of one file, and a line belongs to the run in which it starts. Rows come in
pages of rows_per_request. hash_value, range_from and range_to (inclusive) route the read: only items with these keys are handed over, and where
the files lie in folders by key (key_bucket=n, as write_layout makes them) only the key's folder is read. Bounds are compared as numbers where key_type
is number, else as text. Items without a hash key are no items of the table and are passed over; of those without a range key the column is null.
Filters on the DataFrame are Spark's own; they aren't taken over, as a source that remembers pushed filters answers a later query on
the same DataFrame with those of an earlier one. Files are listed and read with the standard library: the path must be
visible to all executors. Parquet and JSON tables in other stores are read with Spark's own readers (layout.py).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, fields
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .layout import BUCKET, bucket_of


@dataclass(frozen=True)
class ItemOptions:
    path: str
    hash: str
    range: str | None = None
    key_type: str = "string"
    hash_value: str | None = None
    range_from: str | None = None
    range_to: str | None = None
    rows_per_request: int = 10_000
    split_bytes: int = 64 << 20
    buckets: int = 64

    @classmethod
    def of(cls, options: dict) -> ItemOptions:
        """Options by their names, of their types; what is missing, unknown or out of range is refused."""
        kinds = {f.name: f.type for f in fields(cls)}
        if unknown := set(options) - set(kinds):
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        if missing := {"path", "hash"} - {k for k, v in options.items() if v}:
            raise ValueError(f"missing options: {', '.join(sorted(missing))}")
        own = cls(**{k: int(v) if kinds[k] == "int" else v for k, v in options.items()})
        if own.key_type not in ("string", "number"):
            raise ValueError(f"key_type is string or number, not {own.key_type}")
        if min(own.rows_per_request, own.split_bytes, own.buckets) < 1:
            raise ValueError("rows_per_request, split_bytes and buckets are 1 or more")
        if not own.range and (own.range_from is not None or own.range_to is not None):
            raise ValueError("range bounds need a range key")
        return own


@dataclass(frozen=True)
class Split(InputPartition):
    path: str
    start: int
    end: int


class ItemSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_items"

    def schema(self) -> str:
        own = ItemOptions.of(dict(self.options))
        return ", ".join(f"`{n}` string" for n in (own.hash, own.range) if n) + ", item string"

    def reader(self, schema) -> DataSourceReader:
        return ItemReader(ItemOptions.of(dict(self.options)))


class ItemReader(DataSourceReader):
    def __init__(self, options: ItemOptions):
        self.options = options

    def files(self) -> list[str]:
        o = self.options
        if not os.path.isdir(o.path):
            return [o.path]
        found = sorted(os.path.join(at, f) for at, _, names in os.walk(o.path) for f in names if ".json" in f and f[0] not in "._")
        if o.hash_value is not None and any(f"{BUCKET}=" in f for f in found):
            found = [f for f in found if f"{os.sep}{BUCKET}={bucket_of(o.hash_value, o.buckets)}{os.sep}" in f]
        return found

    def partitions(self) -> list[Split]:
        out = [Split(f, a, a + self.options.split_bytes) for f in self.files() for a in range(0, os.path.getsize(f), self.options.split_bytes)]
        return out or [Split("", 0, 0)]

    def inside(self, key: str | None) -> bool:
        o, order = self.options, Decimal if self.options.key_type == "number" else str
        if o.range_from is None and o.range_to is None:
            return True
        return key is not None and (o.range_from is None or order(key) >= order(o.range_from)) and (o.range_to is None or order(key) <= order(o.range_to))

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        o = self.options
        names = [n for n in (o.hash, o.range) if n]
        page: list[tuple] = []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*page, strict=True)], names=[*names, "item"])
        text = lambda v: None if v is None else v if isinstance(v, str) else json.dumps(v) if isinstance(v, (bool, dict, list)) else format(v, "f") if isinstance(v, Decimal) else str(v)
        with open(partition.path, "rb") as lines:
            lines.seek(max(0, partition.start - 1))
            if partition.start:
                lines.readline()  # the line that starts before this run, or the end of it
            while lines.tell() < partition.end and (line := lines.readline()):
                if not line.strip():
                    continue
                item = json.loads(line, parse_float=Decimal)
                keys = [text(item.get(n)) for n in names]
                if keys[0] is not None and o.hash_value in (None, keys[0]) and self.inside(keys[1] if o.range else None):
                    page.append((*keys, line.decode().strip()))
                    if len(page) == o.rows_per_request:
                        yield batch()
                        page = []
        if page:
            yield batch()
