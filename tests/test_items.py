import json

import pytest
from pyspark.sql import functions as F

from keelstone.functions.attributes import attribute, attribute_exists, attribute_is_null, attribute_not_exists, element, elements, number_as_text
from keelstone.operators.access import classify
from keelstone.operators.item_filter import read_items
from keelstone.operators.keymap import LengthSplit, LengthSplitBoth, map_keys, mapper
from keelstone.operators.predicate import attr, parse
from keelstone.sources.items import ItemSource
from keelstone.sources.layout import BUCKET, read_layout, write_layout
from keelstone.sources.tables import Catalog, TableDef
from keelstone.streaming.follow import follow


def items(spark, *rows):
    return spark.createDataFrame([(r["pk"], json.dumps(r)) for r in rows], "pk string, j string").select("pk", F.parse_json("j").alias("item"))


def keys(df):
    return sorted(r.pk for r in df.collect())


def test_absent_and_null(spark):
    df = items(spark, {"pk": "a"}, {"pk": "b", "x": None}, {"pk": "c", "x": 1}, {"pk": "d", "x": "1"})
    v = F.col("item")
    assert keys(df.where(attribute_not_exists(v, "$.x"))) == ["a"]
    assert keys(df.where(attribute_exists(v, "$.x"))) == ["b", "c", "d"]
    assert keys(df.where(attribute_is_null(v, "$.x"))) == ["b"]
    assert keys(df.where(attribute(v, "$.x", "bigint") == 1)) == ["c", "d"]


def test_predicates_over_items(spark):
    df = items(spark, {"pk": "a"}, {"pk": "b", "x": None}, {"pk": "c", "x": 1}, {"pk": "d", "x": "1"}, {"pk": "e", "x": True}, {"pk": "f", "x": 2.5, "m": {"l": [4, 9]}}, {"pk": "g", "x": 1e30})
    x = attr("x")
    cases = {
        "c": x == 1, "d": x == "1", "b": x.is_null(), "a": x.not_exists(), "e": x == True, "cf": (x >= 1) & (x < 3), "fg": x > 1.5, "defg": x != 1, "f": attr("m.l[1]") == 9,  # noqa: E712
        "": (attr("pk") == "a") & (x == 1), "ac": (attr("pk") == "a") | (x == 1), "bd": (attr("pk") == "b") | (x == "1"), "defg ": ~(x == 1), "abcdeg": attr("m").not_exists(),
    }
    for want, p in cases.items():
        assert keys(read_items(df, p)) == list(want.strip()), str(p)
    assert keys(read_items(df, parse(spark, "x = cast(null as string) and pk <> 'z'", explicit_nulls=True))) == ["b"]
    assert keys(read_items(df, parse(spark, "null = x", explicit_nulls=True))) == ["b"]
    assert read_items(df, None).count() == 7
    assert classify(TableDef("h", "pk"), (attr("pk") == "b") & x.is_null()).explain() == "Query(hash='b', filter=x = NULL)"


def test_nesting(spark):
    df = items(spark, {"pk": "a", "m": {"x": "y", "n": {"z": 1}}, "l": [10, 20, 30], "b": True}, {"pk": "b", "l": [1]})
    v = F.col("item")
    got = {r.pk: tuple(r)[1:] for r in df.select("pk", attribute(v, "$.m.x", "string"), attribute(v, "$.m.n.z", "bigint"), attribute(v, "$.l[2]", "bigint"), attribute(v, "$.b", "boolean")).collect()}
    assert got == {"a": ("y", 1, 30, True), "b": (None, None, None, None)}
    own = df.select("pk", attribute(v, "$.l", "array<bigint>").alias("l")).select("pk", element(F.col("l"), 5).alias("e"), elements(F.col("l"), [0, 2]).alias("x"))
    assert sorted(map(tuple, own.collect())) == [("a", None, [10, None, 30]), ("b", None, [1, None, None])]


def test_numbers(spark):
    own = spark.sql("select 12345678901234567890.123456789BD n, 1.0E10D d").select(number_as_text(F.col("n"), 9), number_as_text(F.col("d"), 0)).first()
    assert tuple(own) == ("12345678901234567890.123456789", "10000000000")
    numbers = {"1.234": "1.234", "5": "5", "5.00": "5", "-1.50E3": "-1500", "1.0E-7": "0.0000001", "-0.0": "0", "100": "100", "1.5E300": "15" + "0" * 299, "12345678901234567890.123456789": "12345678901234567890.123456789", "NaN": "NaN"}
    got = spark.createDataFrame([(k,) for k in numbers], "n string").select("n", number_as_text(F.col("n"))).collect()
    assert dict(map(tuple, got)) == numbers
    double = spark.sql("select 1.0E-9D a, 123456789.125D b, cast(null as double) c, 0.1D d").select(*(number_as_text(F.col(c)) for c in "abcd")).first()
    assert tuple(double) == ("0.000000001", "123456789.125", None, "0.1")


def test_mappers(spark):
    one = map_keys(spark.createDataFrame([("ab",)], "pk string"), LengthSplit(1, ("h1", "h2")), "pk").first()
    assert (one.h1, one.h2, one.pk) == ("a", "b", "ab")
    own = mapper({"type": "length-split-both", "length": 1, "names": ["h1", "h2", "h3", "h4"]})
    two = map_keys(spark.createDataFrame([("ab", "12"), ("cd", "xy"), (None, None)], "pk string, sort string"), own, "pk", "sort").collect()
    assert [(r.h1, r.h2, r.h3, r.h4) for r in two] == [("a", "b", 1, 2), ("c", "d", None, None), (None, None, None, None)]
    assert isinstance(own, LengthSplitBoth)
    mine = mapper({"class": "keelstone.operators.keymap:LengthSplit", "length": 2, "names": ("a", "b")})
    assert map_keys(spark.createDataFrame([("xyz",)], "pk string"), mine, "pk").first().b == "z"
    with pytest.raises(TypeError):
        mapper({"class": "fractions:Fraction"})
    with pytest.raises(ValueError):
        map_keys(spark.createDataFrame([("ab", "1")], "pk string, sort string"), LengthSplit(1, ("h1", "h2")), "pk", "sort")


def test_source_reads_by_key(spark, tmp_path):
    rows = [{"pk": f"p{i % 5}", "sort": f"s{i}", "v": i, "deep": {"k": [i]}} for i in range(40)]
    for n in range(2):
        (tmp_path / f"{n}.jsonl").write_text("\n".join(json.dumps(r) for r in rows[n::2]) + "\n")
    spark.dataSource.register(ItemSource)
    df = spark.read.format("keyed_items").options(path=str(tmp_path), hash="pk", range="sort", rows_per_request=7, split_bytes=300).load()
    assert df.count() == 40
    assert df.where("pk = 'p1' and sort >= 's2'").count() == sum(r["pk"] == "p1" and r["sort"] >= "s2" for r in rows)
    assert df.where("pk = 'p1' and sort = 's6'").count() == 1 and df.where("pk = 'zzz'").count() == 0
    assert df.where("pk = 'p1' or pk = 'p2'").count() == 16
    own = spark.read.format("keyed_items").options(path=str(tmp_path), hash="pk", range="sort", hash_value="p1", range_from="s2", range_to="s3").load()
    assert sorted(r.sort for r in own.collect()) == sorted(r["sort"] for r in rows if r["pk"] == "p1" and "s2" <= r["sort"] <= "s3")
    got = df.where("pk = 'p3'").select(attribute(F.parse_json("item"), "$.deep.k[0]", "int").alias("k")).collect()
    assert sorted(r.k for r in got) == [r["v"] for r in rows if r["pk"] == "p3"]


def test_catalogue(spark, tmp_path):
    spark.createDataFrame([("ab", 1)], "pk string, x int").write.parquet(str(tmp_path / "t_one.parquet"))
    own = Catalog(spark, str(tmp_path), [TableDef("t_one", "pk")], [("other", {}), ("t_.*", {"type": "length-split", "length": 1, "names": ("a", "b")})])
    own.register()
    assert own.names() == ["t_one"] and spark.table("t_one").columns == ["pk", "x", "a", "b"]
    assert tuple(own.listing().first()) == ("t_one", "pk", None)


def test_follow(spark, tmp_path):
    spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, k int").write.parquet(str(tmp_path / "in"))
    stream = follow(spark, str(tmp_path / "in"), attr("k") == 1)
    assert stream.isStreaming
    query = stream.writeStream.format("memory").queryName("followed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("followed").count() == 3


def test_source_options_and_odd_items(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"pk": 9, "sort": 10}\n\n{"sort": 1}\n{"pk": 9, "sort": 9, "t": "\u00e9"}\n{"pk": 9}\n{"pk": null, "sort": 1}\n{"pk": 10.50, "sort": 2}')
    spark.dataSource.register(ItemSource)
    read = lambda **o: spark.read.format("keyed_items").options(path=str(tmp_path), hash="pk", range="sort", **o).load()
    for split in (1, 7, 1000):
        assert sorted((r.pk, r.sort or "") for r in read(split_bytes=split).collect()) == [("10.50", "2"), ("9", ""), ("9", "10"), ("9", "9")]
    assert [r.sort for r in read(hash_value="9", range_from="10", key_type="number").collect()] == ["10"]
    assert sorted(r.sort for r in read(hash_value="9", range_from="10").collect()) == ["10", "9"]
    for wrong in ({"colour": "red"}, {"key_type": "date"}, {"split_bytes": "0"}):
        with pytest.raises(Exception):
            read(**wrong)


def test_layout_reads_the_keys_buckets_alone(spark, tmp_path):
    rows = [(f"k{i % 40}" if i % 3 else "hot", i) for i in range(600)] + [(None, 1000)]
    df = spark.createDataFrame(rows, "pk string, sort long")
    table = TableDef("t", "pk", "sort")
    write_layout(df, str(tmp_path / "t"), table, buckets=8)
    own = lambda p: read_layout(spark, str(tmp_path / "t"), table, p, df.schema, buckets=8)
    one = own((attr("pk") == "hot") & (attr("sort") >= 300))
    assert one.count() == sum(k == "hot" and i >= 300 for k, i in rows) and one.columns == df.columns
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan and f"{BUCKET}#" in plan
    assert own(attr("pk").isin("k1", "k2", "none")).count() == sum(k in ("k1", "k2") for k, _ in rows)
    assert own(None).count() == 601 and own(attr("pk").not_exists()).count() == 1 and own(attr("sort") == 1000).count() == 1


def test_lists_and_wide_numbers_over_items(spark):
    df = items(spark, {"pk": "a"}, {"pk": "b", "x": None}, {"pk": "c", "x": 1}, {"pk": "d", "x": "1"}, {"pk": "e", "x": 123456789012345678901234567890}, {"pk": "f", "x": 123456789012345678901234567891})
    x = attr("x")
    assert keys(read_items(df, x.isin(1, "1"))) == ["c", "d"] and keys(read_items(df, x.isin())) == [] and keys(read_items(df, ~x.isin(1))) == ["d", "e", "f"]
    assert keys(read_items(df, x == 123456789012345678901234567890)) == ["e"] and keys(read_items(df, x > 123456789012345678901234567890)) == ["f"]
