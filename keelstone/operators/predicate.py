"""A small predicate tree: built with `attr` or from SQL, turned into one Column, or into disjunctive normal form for the access-path classifier."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

NEGATED = {"=": "<>", "<>": "=", "<": ">=", ">=": "<", ">": "<=", "<=": ">"}
MIRRORED = {"=": "=", "<>": "<>", "<": ">", ">": "<", "<=": ">=", ">=": "<="}


def balanced(columns: list[Column], join) -> Column:
    """All columns joined as a tree of logarithmic depth."""
    while len(columns) > 1:
        columns = [join(*columns[i : i + 2]) if i + 1 < len(columns) else columns[i] for i in range(0, len(columns), 2)]
    return columns[0]


def quoted(name: str) -> str:
    """A column's name, perhaps dotted or quoted already, for SQL text."""
    return name if "`" in name else ".".join(f"`{part}`" for part in name.split("."))


class Predicate:
    def __and__(self, other: Predicate) -> Predicate:
        return And((self, other))

    def __or__(self, other: Predicate) -> Predicate:
        return Or((self, other))

    def __invert__(self) -> Predicate:
        return Not(self)

    def column(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class Compare(Predicate):
    """attribute op literal; a dotted name is a nested field."""

    name: str
    op: str
    value: Any

    @staticmethod
    def apply(a: Column, op: str, b: Column) -> Column:
        return {"=": a == b, "<>": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]

    def column(self) -> Column:
        return self.apply(F.col(self.name), self.op, F.lit(self.value))

    def __str__(self) -> str:
        return f"{self.name} {self.op} {self.value!r}"


@dataclass(frozen=True)
class In(Predicate):
    """attribute IN (literals), however many; of none it is false."""

    name: str
    values: tuple[Any, ...]

    def column(self) -> Column:
        if not self.values:
            return F.lit(False)
        kinds = {type(v) for v in self.values}
        if len(self.values) > 16 and kinds <= {int} and all(abs(v) < 1 << 63 for v in self.values):
            return F.expr(f"{quoted(self.name)} IN ({', '.join(f'{v}L' for v in self.values)})")  # parsed at once, not literal by literal
        if len(self.values) > 16 and kinds <= {str}:
            text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
            return F.expr(f"{quoted(self.name)} IN ({', '.join(map(text, self.values))})")
        return F.col(self.name).isin(list(self.values))

    def __str__(self) -> str:
        return f"{self.name} IN ({', '.join(map(repr, self.values))})"


@dataclass(frozen=True)
class Exists(Predicate):
    """IS NOT NULL, or with absent IS NULL."""

    name: str
    absent: bool = False

    def column(self) -> Column:
        return F.col(self.name).isNull() if self.absent else F.col(self.name).isNotNull()

    def __str__(self) -> str:
        return f"attribute_{'not_' * self.absent}exists({self.name})"


@dataclass(frozen=True)
class IsNull(Predicate):
    """The attribute is there and null. A plain column can't tell this from absent."""

    name: str

    def column(self) -> Column:
        return F.col(self.name).isNull()

    def __str__(self) -> str:
        return f"{self.name} = NULL"


@dataclass(frozen=True)
class Opaque(Predicate):
    """SQL that no access path can use: evaluated as it stands on what is read."""

    sql: str

    def column(self) -> Column:
        return F.expr(self.sql)

    def __str__(self) -> str:
        return self.sql


@dataclass(frozen=True)
class And(Predicate):
    parts: tuple[Predicate, ...]

    def column(self) -> Column:
        return balanced([p.column() for p in self.parts], lambda a, b: a & b)

    def __str__(self) -> str:
        return "(" + " AND ".join(map(str, self.parts)) + ")"


@dataclass(frozen=True)
class Or(Predicate):
    parts: tuple[Predicate, ...]

    def column(self) -> Column:
        return balanced([p.column() for p in self.parts], lambda a, b: a | b)

    def __str__(self) -> str:
        return "(" + " OR ".join(map(str, self.parts)) + ")"


@dataclass(frozen=True)
class Not(Predicate):
    part: Predicate

    def column(self) -> Column:
        return ~self.part.column()

    def __str__(self) -> str:
        return f"NOT {self.part}"


@dataclass(frozen=True)
class attr:  # noqa: N801
    """attr("a") >= 3, attr("a").between(1, 5), attr("a").exists() ..."""

    name: str

    def __eq__(self, v) -> Predicate:  # type: ignore[override]
        return Compare(self.name, "=", v)

    def __ne__(self, v) -> Predicate:  # type: ignore[override]
        return Compare(self.name, "<>", v)

    def __lt__(self, v) -> Predicate:
        return Compare(self.name, "<", v)

    def __le__(self, v) -> Predicate:
        return Compare(self.name, "<=", v)

    def __gt__(self, v) -> Predicate:
        return Compare(self.name, ">", v)

    def __ge__(self, v) -> Predicate:
        return Compare(self.name, ">=", v)

    def between(self, low, high) -> Predicate:
        return And((self >= low, self <= high))

    def isin(self, *values) -> Predicate:
        return In(self.name, tuple(values))

    def exists(self) -> Predicate:
        return Exists(self.name)

    def not_exists(self) -> Predicate:
        return Exists(self.name, absent=True)

    def is_null(self) -> Predicate:
        return IsNull(self.name)


def pushed_down(p: Predicate, negate: bool = False) -> Predicate:
    """Negation moved to the leaves; what it can't enter becomes opaque. (Three-valued logic is kept: each step is an SQL identity.)"""
    if isinstance(p, Not):
        return pushed_down(p.part, not negate)
    if isinstance(p, (And, Or)):
        kind = type(p) if not negate else (Or if isinstance(p, And) else And)
        return kind(tuple(pushed_down(x, negate) for x in p.parts))
    if not negate:
        return p
    if isinstance(p, Compare):
        return Compare(p.name, NEGATED[p.op], p.value)
    if isinstance(p, Exists):
        return Exists(p.name, not p.absent)
    return Opaque(f"NOT ({p})")


def dnf(p: Predicate, most: int = 64) -> list[tuple[Predicate, ...]] | None:
    """Disjuncts, each a tuple of leaves; None beyond `most` of them."""
    p = pushed_down(p)
    if isinstance(p, Or):
        out: list = []
        for part in p.parts:
            own = dnf(part, most)
            if own is None or len(out) + len(own) > most:
                return None
            out += own
        return out
    if isinstance(p, And):
        out = [()]
        for part in p.parts:
            own = dnf(part, most)
            if own is None or len(out) * len(own) > most:
                return None
            out = [a + b for a in out for b in own]
        return out
    return [(p,)]


def _tree(rows: list[dict]) -> tuple[dict, list]:
    """Catalyst writes a tree as its nodes in preorder, each with its number of children."""
    node = rows.pop(0)
    return node, [_tree(rows) for _ in range(node["num-children"])]


def _simple(tree: tuple[dict, list]):
    """("name", x), ("value", x) or None."""
    node, children = tree
    kind = node["class"].rpartition(".")[2]
    if kind == "UnresolvedAttribute":
        parts = node["nameParts"]
        return "name", ".".join(json.loads(parts) if parts.startswith('["') else parts.strip("[]").split(", "))
    if kind == "Literal":
        of, v = node["dataType"], node["value"]
        if v is None:
            return None
        if of in ("integer", "long", "short", "byte"):
            return "value", int(v)
        if of == "double" or of == "float":
            return "value", float(v)
        if of == "string":
            return "value", v
        if of == "boolean":
            return "value", v == "true"
        if str(of).startswith("decimal"):
            from decimal import Decimal

            return "value", Decimal(v)
    return None


WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _uncast(tree: tuple[dict, list], op: str, other: tuple[dict, list], types: dict[str, str]) -> tuple[str, Any] | None:
    """The column under a cast and the literal it may be compared with instead, where that selects the same rows.

    Safe are casts to the column's own type, of whole numbers to wider ones, and of whole numbers to text where = meets their only spelling. Nested
    casts come off one by one. All others compare in another domain and are left to Spark.
    """
    value = _simple(other)
    if not value or value[0] != "value":
        return None
    v = value[1]
    while tree[0]["class"].rpartition(".")[2] == "Cast":
        to, tree = str(tree[0]["dataType"]), tree[1][0]
        to = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint"}.get(to, to)
        inner = tree
        while inner[0]["class"].rpartition(".")[2] == "Cast":
            inner = inner[1][0]
        name = _simple(inner)
        own = types.get(name[1]) if name and name[0] == "name" else None
        if own is None:
            return None
        if own in WHOLE and to == "string":
            if not (op == "=" and isinstance(v, str) and v.lstrip("-").isdecimal() and v.isascii() and str(int(v)) == v):
                return None
            v = int(v)
        elif not (own == to or (own in WHOLE and WHOLE.get(to, 0) >= WHOLE[own])) or isinstance(v, str) != (own == "string"):
            return None
    name = _simple(tree)
    return (name[1], v) if name and name[0] == "name" else None


OPS = {"EqualTo": "=", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}


def _null(tree: tuple[dict, list]) -> bool:
    """Whether this is NULL, perhaps cast to a type."""
    node, children = tree
    kind = node["class"].rpartition(".")[2]
    return _null(children[0]) if kind == "Cast" else kind == "Literal" and node["value"] is None


def parse(spark: SparkSession, sql: str, explicit_nulls: bool = False, types: dict[str, str] | None = None) -> Predicate:
    """The predicate of an SQL condition. Spark's own parser reads it; parts outside the tree's forms stay opaque.

    types: names and types of the columns (dict(df.dtypes)); with it casts of columns come off where that is safe, so a key stays a key.
    explicit_nulls: a = NULL, also a cast one, asks for an attribute that is there and null, as items can have it; in SQL it is never true.
    """
    expression = spark._jsparkSession.sessionState().sqlParser().parseExpression(sql)
    return _convert(_tree(json.loads(expression.toJSON())), expression, explicit_nulls, types or {})


def _convert(tree: tuple[dict, list], source, nulls: bool, types: dict[str, str]) -> Predicate:
    node, children = tree
    kind = node["class"].rpartition(".")[2]
    below = lambda i: source.children().apply(i)
    if kind in ("And", "Or"):
        return (And if kind == "And" else Or)(tuple(_convert(c, below(i), nulls, types) for i, c in enumerate(children)))
    if kind == "Not":
        return Not(_convert(children[0], below(0), nulls, types))
    if nulls and kind == "EqualTo":
        for a, b in (children, children[::-1]):
            if _null(b) and (x := _simple(a)) and x[0] == "name":
                return IsNull(x[1])
    if kind in ("IsNull", "IsNotNull") and (x := _simple(children[0])) and x[0] == "name":
        return Exists(x[1], absent=kind == "IsNull")
    simple = [_simple(c) for c in children]
    if kind in OPS and all(simple):
        (a, x), (b, y) = simple
        if (a, b) == ("name", "value"):
            return Compare(x, OPS[kind], y)
        if (a, b) == ("value", "name"):
            return Compare(y, MIRRORED[OPS[kind]], x)
    if kind in OPS:
        for (a, b), op in ((children, OPS[kind]), (children[::-1], MIRRORED[OPS[kind]])):
            if a[0]["class"].endswith(".Cast") and (own := _uncast(a, op, b, types)):
                return Compare(own[0], op, own[1])
    if kind == "In" and all(simple) and simple[0][0] == "name" and all(s[0] == "value" for s in simple[1:]):
        return attr(simple[0][1]).isin(*(v for _, v in simple[1:]))
    if kind in ("UnresolvedFunction", "Between") and "between" in str(node.get("nameParts", kind)).lower() and len(simple) == 3 and all(simple) and simple[0][0] == "name" and simple[1][0] == simple[2][0] == "value":
        return attr(simple[0][1]).between(simple[1][1], simple[2][1])
    return Opaque(source.sql())
