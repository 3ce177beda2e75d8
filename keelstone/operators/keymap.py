"""Key mappers: logical columns out of compound keys. A mapper gives Column expressions; the key columns themselves stay."""

from __future__ import annotations

from dataclasses import dataclass
from importlib import import_module
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeyMapper(Protocol):
    def hash_columns(self, key: Column) -> dict[str, Column]: ...

    def range_columns(self, key: Column) -> dict[str, Column]: ...


@dataclass(frozen=True)
class LengthSplit:
    """The first `length` characters of the hash key and the rest, as two columns. It doesn't map range keys."""

    length: int
    names: tuple[str, ...]

    def hash_columns(self, key: Column) -> dict[str, Column]:
        return {self.names[0]: F.substring(key, 1, self.length), self.names[1]: F.substr(key, F.lit(self.length + 1))}

    def range_columns(self, key: Column) -> dict[str, Column]:
        raise ValueError("this mapper has no range columns")


@dataclass(frozen=True)
class LengthSplitBoth(LengthSplit):
    """The same for the range key, whose parts are numbers; parts that are none are null."""

    def range_columns(self, key: Column) -> dict[str, Column]:
        parts = F.substring(key, 1, self.length), F.substr(key, F.lit(self.length + 1))
        return {n: p.try_cast("decimal(38,0)") for n, p in zip(self.names[2:4], parts, strict=True)}


MAPPERS = {"length-split": LengthSplit, "length-split-both": LengthSplitBoth}


def mapper(config: dict) -> KeyMapper:
    """{"type": name, "length": n, "names": [...]} of a bundled mapper, or {"class": "package.module:Class", ...} with the arguments of a mapper of one's own."""
    if "class" in config:
        module, _, name = config["class"].partition(":")
        own = getattr(import_module(module), name)(**{k: v for k, v in config.items() if k != "class"})
        if not all(callable(getattr(own, m, None)) for m in ("hash_columns", "range_columns")):
            raise TypeError(f"{config['class']} is no key mapper")
        return own
    return MAPPERS[config["type"]](int(config["length"]), tuple(config["names"]))


def map_keys(df: DataFrame, own: KeyMapper, hash_key: str, range_key: str | None = None) -> DataFrame:
    columns = own.hash_columns(F.col(hash_key))
    if range_key:
        columns |= own.range_columns(F.col(range_key))
    return df.withColumns(columns)
