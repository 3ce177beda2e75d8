"""Attributes of items: absent and null told apart, nested paths, list elements, numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attribute_exists(item: Column, path: str) -> Column:
    """Whether the VARIANT item has the attribute, null or not. path: $.a.b[0]"""
    return F.variant_get(item, path, "variant").isNotNull()


def attribute_not_exists(item: Column, path: str) -> Column:
    return F.variant_get(item, path, "variant").isNull()


def attribute_is_null(item: Column, path: str) -> Column:
    """Whether the attribute is there and null."""
    return F.coalesce(F.is_variant_null(F.variant_get(item, path, "variant")), F.lit(False))


def attribute(item: Column, path: str, kind: str) -> Column:
    """The attribute as the type, null where it is absent, null or of a type that can't be read so."""
    return F.try_variant_get(item, path, kind)


def element(values: Column, i: int) -> Column:
    """Element i from 0, null beyond the end."""
    return F.get(values, F.lit(i))


def elements(values: Column, indexes: list[int]) -> Column:
    """A list that has the elements of these indexes in their places and nulls between them."""
    return F.array(*(F.get(values, F.lit(i)) if i in indexes else F.lit(None) for i in range(max(indexes) + 1)))


def as_set(values: Column) -> Column:
    """A set as a list: each value once, in ascending order, nulls last."""
    return F.array_sort(F.array_distinct(values))


def number_as_text(number: Column, scale: int | None = None) -> Column:
    """All digits of a number, never an exponent and no zeros that say nothing; with a scale, rounded to so many digits after the point.

    Without a scale nothing is rounded: the digits are those Spark writes, moved to where the exponent says. NaN and infinities keep their names.
    """
    if scale is not None:
        return number.cast(f"decimal(38,{scale})").cast("string")
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))  # noqa: E731  worked out once, however often f names it
    return bound(number.cast("string"), lambda text: F.when(text.rlike("^-?[0-9]"), bound(_parts(text), _moved)).otherwise(text))


def _parts(text: Column) -> Column:
    """Sign, digits and the place of the point of a number as Spark writes it."""
    body = F.regexp_replace(text, "^-", "")
    mantissa, power = F.substring_index(body, "E", 1), F.coalesce(F.regexp_extract(body, "E([+-]?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    point = F.length(F.substring_index(mantissa, ".", 1)) + power
    return F.struct(F.when(text.startswith("-"), "-").otherwise("").alias("sign"), F.regexp_replace(mantissa, "[.]", "").alias("digits"), point.alias("point"))


def _moved(x: Column) -> Column:
    digits, point, size = x["digits"], x["point"], F.length(x["digits"])
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size)))
        .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1)))
    )
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, "([.][0-9]*?)0+$", "$1"), "[.]$", ""), "^0+(?=[0-9])", "")
    return F.regexp_replace(F.concat(x["sign"], plain), "^-0$", "0")
