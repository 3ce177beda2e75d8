import random

import pytest
from pyspark.sql import functions as F

from keelstone.operators.access import classify, read
from keelstone.operators.predicate import And, Compare, Not, Opaque, Or, attr, dnf, parse
from keelstone.operators.segments import segment
from keelstone.sources.tables import TableDef

H, R = TableDef("h", "pk"), TableDef("r", "pk", "sort")
pk, sort, c = attr("pk"), attr("sort"), attr("col1")


@pytest.mark.parametrize(
    "table, predicate, want",
    [
        (H, pk == "2", "Get(hash='2')"),
        (R, (pk == "p1") & (sort == "s1"), "Get(hash='p1', range=sort = 's1')"),
        (R, (pk == "p1") & (sort >= "s1"), "Query(hash='p1', range=sort >= 's1')"),
        (R, pk == "p1", "Query(hash='p1')"),
        (H, (pk == "pk") & (c == 1), "Query(hash='pk', filter=col1 = 1)"),
        (H, (pk == "pk") & c.not_exists(), "Query(hash='pk', filter=attribute_not_exists(col1))"),
        (H, c == 1, "Scan(filter=col1 = 1; a condition fixes no single hash key)"),
        (H, (pk == "pk") | (pk == "pk2"), "Get(hash='pk') + Get(hash='pk2')"),
        (H, (pk == "pk") | ((pk == "pk2") & (c >= 2)), "Get(hash='pk') + Query(hash='pk2', filter=col1 >= 2)"),
        (H, ((pk == "a") & (c == 1)) | ((pk == "b") & (c == 2)), "Query(hash='a', filter=col1 = 1) + Query(hash='b', filter=col1 = 2)"),
        (R, (pk == "pk") & (sort >= "1") & (sort <= "2"), "Query(hash='pk', range=sort BETWEEN '1' AND '2')"),
        (R, (pk == "pk") & (sort == "1") & (sort >= "2"), "Query(hash='pk', range=sort >= '2' AND sort = '1')"),
        (H, c.between("1", "2"), "Scan(filter=col1 BETWEEN '1' AND '2'; a condition fixes no single hash key)"),
        (H, (pk == "pk") & c.between(1, 2), "Query(hash='pk', filter=col1 BETWEEN 1 AND 2)"),
        (H, c.between(1, 10) & (c >= 4) & (c <= 7), "Scan(filter=col1 BETWEEN 4 AND 7; a condition fixes no single hash key)"),
        (H, (pk == "a") & ((c == 1) | (c == 2)), "Query(hash='a', filter=col1 = 1) + Query(hash='a', filter=col1 = 2)"),
        (R, (pk == "a") & (sort != "x"), "Query(hash='a', filter=sort <> 'x')"),
        (H, pk.isin("a", "b", "a"), "Get(hash='a') + Get(hash='b')"),
        (H, pk.isin("a", "b") & (pk == "b") & (c == 1), "Query(hash='b', filter=col1 = 1)"),
        (R, pk.isin("a") & (sort == "x"), "Get(hash='a', range=sort = 'x')"),
        (H, pk.isin("a") & c.isin(1, 2), "Query(hash='a', filter=col1 IN (1, 2))"),
        (H, pk.isin(), "Scan(filter=pk IN (); a condition fixes no single hash key)"),
    ],
)
def test_paths(table, predicate, want):
    assert classify(table, predicate).explain() == want


def test_scans():
    for p in [(pk == "a") & (pk == "b"), ((pk == "a") & (c == 1)) | (c >= 2), pk > "a", (pk == "a") & (pk != "b"), sort == "x", (pk == "a") | Opaque("upper(col1) = 'X'"), None]:
        assert classify(R, p).kind == "scan"
    many = And(tuple(Or((Compare("pk", "=", i), Compare("pk", "=", -i))) for i in range(1, 9)))
    assert classify(H, many).reason == "too many alternatives"
    assert classify(H, (pk == "a") & Opaque("col1 like 'x%'")).residual


def test_parse(spark):
    same = {"5 < a": attr("a") > 5, "a = 'x' and b >= 2.5": (attr("a") == "x") & (attr("b") >= __import__("decimal").Decimal("2.5")), "a is null or m.f is not null": attr("a").not_exists() | attr("m.f").exists(), "not a = 1": Not(attr("a") == 1), "a in (1, 2)": attr("a").isin(1, 2)}
    for text, want in same.items():
        assert parse(spark, text) == want
    assert all(isinstance(parse(spark, t), Opaque) for t in ["a = b", "a like 'x%'", "cast(a as int) = 1", "a = cast(null as string)"])


def test_casts_come_off_where_that_is_safe(spark):
    types = {"pk": "bigint", "n": "int", "s": "string"}
    own = lambda t: parse(spark, t, types=types)
    assert own("cast(pk as string) = '5'") == (pk == 5) and own("cast(cast(n as bigint) as bigint) >= 3") == (attr("n") >= 3)
    assert own("'x' = cast(s as string)") == (attr("s") == "x") and own("cast(n as bigint) < 3") == (attr("n") < 3)
    for text in ["cast(pk as string) = '05'", "cast(pk as string) > '5'", "cast(pk as int) = 5", "cast(s as int) = 5", "cast(pk as double) = 5", "cast(other as string) = 'x'"]:
        assert isinstance(own(text), Opaque), text


def test_long_lists(spark):
    keys = tuple(range(0, 20_000, 2))
    df = spark.range(30_000).withColumnRenamed("id", "pk")
    assert read(df, pk.isin(*keys)).count() == len(keys) and len(classify(H, pk.isin(*keys)).branches) == len(keys)
    assert read(df, Or(tuple(pk == k for k in range(1500)))).count() == 1500
    texts = ["it's", "a\\b", "", "%"] + [f"k{i}" for i in range(30)]
    odd = spark.createDataFrame([(t,) for t in [*texts, "no", "itXs"]], "`a b` string")
    assert read(odd, attr("a b").isin(*texts)).count() == len(texts)
    assert read(df, pk.isin()).count() == 0 and read(df, ~pk.isin(*keys)).count() == 20_000


def random_predicate(rng, depth):
    if depth == 0 or rng.random() < 0.3:
        name, op = rng.choice(["pk", "sort", "x"]), rng.choice(["=", "=", "<>", "<", "<=", ">", ">="])
        return rng.choice([Compare(name, op, rng.randint(0, 3)), attr("x").exists(), attr("x").not_exists(), Opaque("x + sort > 3")] if rng.random() < 0.3 else [Compare(name, op, rng.randint(0, 3))])
    if rng.random() < 0.2:
        return Not(random_predicate(rng, depth - 1))
    return rng.choice([And, Or])(tuple(random_predicate(rng, depth - 1) for _ in range(2)))


def truth(p, row):
    if isinstance(p, Compare):
        v = row[p.name]
        return None if v is None else {"=": v == p.value, "<>": v != p.value, "<": v < p.value, "<=": v <= p.value, ">": v > p.value, ">=": v >= p.value}[p.op]
    if isinstance(p, Opaque):
        return None if row["x"] is None else row["x"] + row["sort"] > 3
    if isinstance(p, Not):
        v = truth(p.part, row)
        return None if v is None else not v
    if isinstance(p, (And, Or)):
        vs = [truth(q, row) for q in p.parts]
        end = isinstance(p, Or)
        return end if end in vs else None if None in vs else not end
    return (row[p.name] is None) == p.absent


def test_branches_cover_what_the_predicate_selects(spark):
    rng = random.Random(11)
    rows = [{"id": i, "pk": rng.randint(0, 3), "sort": rng.randint(0, 3), "x": rng.choice([None, 0, 1, 2, 3])} for i in range(150)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, pk int, sort int, x int").cache()
    table, routed = TableDef("t", "pk", "sort"), 0
    for n in range(3000):
        p = random_predicate(rng, 3)
        plan, want = classify(table, p), {r["id"] for r in rows if truth(p, r)}
        if plan.kind == "branches":
            routed += 1
            keys = {b.hash_value for b in plan.branches}
            assert all(r["pk"] in keys for r in rows if r["id"] in want)
        if n < 40:
            assert {r.id for r in read(df, p).collect()} == want
    assert routed > 50


def test_segments(spark):
    df = spark.range(1000)
    parts = [segment(df, "id", i, 7) for i in range(7)]
    assert sum(p.count() for p in parts) == 1000 and sum(p.agg(F.sum("id")).first()[0] or 0 for p in parts) == 499_500
