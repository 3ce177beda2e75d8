"""Predicates over schema-flexible items: keys are columns, every other attribute lies in one VARIANT column.

A comparison holds between values of one kind only: text with text, numbers with numbers, booleans with booleans. An attribute of another
kind is unequal to the value, and neither below nor above it. With an attribute that is absent or null, a comparison is unknown, as in SQL.
All of it is built from Spark's own functions, so conditions on keys still reach the scan.
"""

from __future__ import annotations

from collections.abc import Collection
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import attribute, attribute_exists, attribute_is_null, attribute_not_exists
from .predicate import And, Compare, Exists, In, IsNull, Not, Or, Predicate, balanced

#: What schema_of_variant says of numbers begins so.
NUMBERS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def _wide(number: Column, p: Compare) -> Column:
    """The comparison of a number that DECIMAL(38, 18) can't hold: by its digits where they are whole, else as a double."""
    whole = F.try_variant_get(number, "$", "decimal(38,0)")
    exact = whole.cast("string") == number.cast("string")
    fits = p.value == int(p.value) and abs(p.value) < 10**38 if p.value == p.value and abs(p.value) != float("inf") else False
    double = Compare.apply(F.try_variant_get(number, "$", "double"), p.op, F.lit(float(p.value)))
    return F.when(exact, Compare.apply(whole, p.op, F.lit(Decimal(int(p.value))))).otherwise(double) if fits else double


def _among(item: Column, p: In) -> Column:
    """The attribute is one of the values, each compared with its own kind."""
    path = f"$.{p.name}"
    own = F.variant_get(item, path, "variant")
    texts = [v for v in p.values if isinstance(v, str)]
    others = [_compared(item, Compare(p.name, "=", v)) for v in p.values if not isinstance(v, str)]
    if texts:
        others.append(F.coalesce((F.schema_of_variant(own) == "STRING") & attribute(item, path, "string").isin(texts), F.lit(False)))
    found = balanced([F.coalesce(x, F.lit(False)) for x in others] or [F.lit(False)], lambda a, b: a | b)
    return F.when(own.isNull() | F.is_variant_null(own), F.lit(None).cast("boolean")).otherwise(found) if p.values else F.lit(False)


def _compared(item: Column, p: Compare) -> Column:
    path = f"$.{p.name}"
    own = F.variant_get(item, path, "variant")
    kind = F.schema_of_variant(own)
    holds = lambda x, v=p.value: Compare.apply(x, p.op, F.lit(v))
    if isinstance(p.value, bool):
        same, result = kind == "BOOLEAN", holds(attribute(item, path, "boolean"))
    elif isinstance(p.value, (int, float, Decimal)):
        exact = holds(attribute(item, path, "decimal(38,18)"), Decimal(p.value) if isinstance(p.value, int) else p.value)
        same, result = kind.rlike(NUMBERS), F.coalesce(exact, _wide(own, p))
    else:
        same, result = kind == "STRING", holds(attribute(item, path, "string"))
    return F.when(own.isNull() | F.is_variant_null(own), F.lit(None).cast("boolean")).when(same, result).otherwise(F.lit(p.op == "<>"))


def condition(p: Predicate, item: Column, keys: Collection[str]) -> Column:
    """The predicate as one Column; names in keys are columns, all others paths (a.b, a[0]) into the item. Opaque SQL sees the columns."""
    if isinstance(p, (And, Or)):
        return balanced([condition(part, item, keys) for part in p.parts], (lambda a, b: a & b) if isinstance(p, And) else (lambda a, b: a | b))
    if isinstance(p, Not):
        return ~condition(p.part, item, keys)
    if getattr(p, "name", None) in (None, *keys):
        return p.column()
    if isinstance(p, Exists):
        return (attribute_not_exists if p.absent else attribute_exists)(item, f"$.{p.name}")
    if isinstance(p, IsNull):
        return attribute_is_null(item, f"$.{p.name}")
    return _among(item, p) if isinstance(p, In) else _compared(item, p)


def read_items(df: DataFrame, predicate: Predicate | None, item: str = "item", keys: Collection[str] = ("pk",)) -> DataFrame:
    """The rows whose keys and item the predicate holds for."""
    return df if predicate is None else df.where(condition(predicate, F.col(item), keys))
