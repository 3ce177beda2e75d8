"""The registered queries over the engine's own operators and their SQL.

Queries on keyed tables are given as predicates; each is executed as one filter, whatever branches it is classified into.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.attributes import as_set, attribute, attribute_exists, attribute_is_null, attribute_not_exists, element, elements, number_as_text
from ..operators.access import classify, read
from ..operators.item_filter import read_items
from ..operators.keymap import LengthSplit, LengthSplitBoth, map_keys
from ..operators.predicate import Opaque, Predicate, attr, parse
from ..operators.segments import with_segment
from ..sources.items import ItemSource
from ..sources.layout import read_layout, write_layout
from ..sources.shared import local_path, shared_path
from ..sources.tables import STAR, Catalog, TableDef

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return Catalog(spark, sf_dir).load(name)


def _keyed(name: str, table: str, predicate: Predicate, columns: str, sql: str) -> None:
    QUERIES[name] = lambda spark, d: read(_table(spark, d, table), predicate).select(*columns.split(", "))
    ORACLES[name] = f"select {columns} from {table} where {sql}"


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


ORDERS, LINES, EVENTS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity", "event_id, user_id, event_type, value"

# point reads, key queries, scans
_keyed("get_hash", "orders", attr("o_orderkey") == 42, ORDERS, "o_orderkey = 42")
_keyed("get_hash_range", "conversations", (attr("conv_id") == 3) & (attr("turn") == 1), "conv_id, turn, role, text", "conv_id = 3 and turn = 1")
_keyed("multi_get", "orders", (attr("o_orderkey") == 1) | (attr("o_orderkey") == 7), ORDERS, "o_orderkey = 1 or o_orderkey = 7")
_keyed("query_hash", "lineitem", attr("l_orderkey") == 10, LINES, "l_orderkey = 10")
_keyed("query_hash_range_gte", "lineitem", (attr("l_orderkey") == 10) & (attr("l_linenumber") >= 3), LINES, "l_orderkey = 10 and l_linenumber >= 3")
_keyed("query_hash_range_lt", "lineitem", (attr("l_orderkey") == 10) & (attr("l_linenumber") < 5), LINES, "l_orderkey = 10 and l_linenumber < 5")
_keyed("query_hash_range_between", "lineitem", (attr("l_orderkey") == 10) & attr("l_linenumber").between(2, 5), LINES, "l_orderkey = 10 and l_linenumber between 2 and 5")
_keyed("query_hash_multi_range", "lineitem", (attr("l_orderkey") == 10) & (attr("l_linenumber") >= 2) & (attr("l_linenumber") != 4), LINES, "l_orderkey = 10 and l_linenumber >= 2 and l_linenumber <> 4")
_keyed("query_hash_attr", "events", (attr("user_id") == 3) & (attr("event_type") == "click"), EVENTS, "user_id = 3 and event_type = 'click'")
_keyed("get_or_query", "orders", (attr("o_orderkey") == 1) | ((attr("o_orderkey") == 2) & (attr("o_totalprice") >= 2)), ORDERS, "o_orderkey = 1 or (o_orderkey = 2 and o_totalprice >= 2)")
_keyed("query_or_query", "orders", ((attr("o_orderkey") == 1) & (attr("o_totalprice") > 0)) | ((attr("o_orderkey") == 2) & (attr("o_totalprice") > 0)), ORDERS, "(o_orderkey = 1 and o_totalprice > 0) or (o_orderkey = 2 and o_totalprice > 0)")
_keyed("overlapping_branches", "orders", (attr("o_orderkey") == 1) | ((attr("o_orderkey") == 1) & (attr("o_totalprice") > 0)), ORDERS, "o_orderkey = 1 or (o_orderkey = 1 and o_totalprice > 0)")
_keyed("query_and_query_scan", "orders", (attr("o_orderkey") == 1) & (attr("o_orderkey") == 2), ORDERS, "o_orderkey = 1 and o_orderkey = 2")
_keyed("query_or_attr_scan", "events", ((attr("user_id") == 3) & (attr("value") > 100)) | (attr("event_type") == "error"), EVENTS, "(user_id = 3 and value > 100) or event_type = 'error'")
_keyed("or_under_and", "orders", ((attr("o_orderkey") == 1) | (attr("o_orderkey") == 2)) & (attr("o_totalprice") > 0), ORDERS, "(o_orderkey = 1 or o_orderkey = 2) and o_totalprice > 0")
_keyed("scan_eq", "lineitem", attr("l_returnflag") == "R", LINES, "l_returnflag = 'R'")
_keyed("scan_ne", "lineitem", attr("l_returnflag") != "R", LINES, "l_returnflag <> 'R'")
_keyed("scan_gt", "lineitem", attr("l_quantity") > 45, LINES, "l_quantity > 45")
_keyed("scan_lt", "lineitem", attr("l_quantity") < 5, LINES, "l_quantity < 5")
_keyed("scan_lte", "lineitem", attr("l_quantity") <= 3, LINES, "l_quantity <= 3")
_keyed("scan_between", "lineitem", attr("l_quantity").between(10, 12), LINES, "l_quantity between 10 and 12")
_keyed("scan_between_tightened", "lineitem", attr("l_quantity").between(1, 10) & (attr("l_quantity") >= 4) & (attr("l_quantity") <= 7), LINES, "l_quantity between 4 and 7")
_keyed("scan_between_ne", "lineitem", attr("l_quantity").between(1, 10) & (attr("l_quantity") != 5), LINES, "l_quantity between 1 and 10 and l_quantity <> 5")
_keyed("scan_is_null", "orders", attr("o_orderstatus").not_exists(), ORDERS, "o_orderstatus is null")
_keyed("scan_is_not_null", "orders", attr("o_orderstatus").exists(), ORDERS, "o_orderstatus is not null")
_keyed("or_with_unpushable", "orders", (attr("o_orderkey") == 1) | Opaque("upper(o_orderstatus) = 'F'"), ORDERS, "o_orderkey = 1 or upper(o_orderstatus) = 'F'")
_keyed("col_eq_col", "lineitem", Opaque("l_partkey = l_suppkey"), LINES, "l_partkey = l_suppkey")
_keyed("like_residual", "part", Opaque("p_name like '%a%'"), "p_partkey, p_name", "p_name like '%a%'")
_keyed("not_residual", "orders", ~((attr("o_orderkey") <= 100) | (attr("o_orderstatus") == "O")), ORDERS, "not (o_orderkey <= 100 or o_orderstatus = 'O')")
_keyed("in_list", "orders", attr("o_orderkey").isin(3, 5, 9, 70), ORDERS, "o_orderkey in (3, 5, 9, 70)")
_keyed("in_list_large", "orders", attr("o_orderkey").isin(*range(1, 20_001, 2)), ORDERS, "o_orderkey % 2 = 1 and o_orderkey between 1 and 20000")
_keyed("in_list_empty", "orders", attr("o_orderkey").isin(), ORDERS, "false")
_keyed("in_list_not", "orders", ~attr("o_orderkey").isin(1, 2, 3), ORDERS, "o_orderkey not in (1, 2, 3)")


# keyed layouts, file sources
def _layout(name: str, table: str, predicate: Predicate, columns: str, sql: str, format: str = "parquet") -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tables, path = Catalog(spark, d), shared_path(spark, "layout")
        own, df = tables.get(table), tables.load(table).select(*columns.split(", "))
        write_layout(df, path, own, buckets=16, format=format)
        return read_layout(spark, path, own, predicate, df.schema, buckets=16, format=format)

    QUERIES[name], ORACLES[name] = run, f"select {columns} from {table} where {sql}"


_layout("layout_get", "orders", attr("o_orderkey") == 42, ORDERS, "o_orderkey = 42")
_layout("layout_multi_get", "orders", attr("o_orderkey").isin(*range(10, 400, 3)), ORDERS, "o_orderkey between 10 and 399 and (o_orderkey - 10) % 3 = 0")
_layout("layout_query", "lineitem", (attr("l_orderkey") == 10) & (attr("l_linenumber") >= 2), "l_orderkey, l_linenumber, l_quantity", "l_orderkey = 10 and l_linenumber >= 2")
_layout("layout_scan", "customer", attr("c_acctbal") > 0, "c_custkey, c_acctbal", "c_acctbal > 0", "json")


@_query("json_source", "select c_custkey, c_name, c_acctbal from customer")
def json_source(spark: SparkSession, d: str) -> DataFrame:
    path, own = shared_path(spark, "json"), _table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    own.write.json(path)
    return spark.read.schema(own.schema).json(path)


def _item_files(spark: SparkSession, d: str, **options: str) -> DataFrame:
    """conversations as JSON items in folders by conv_id, read through the Python source."""
    tables, path = Catalog(spark, d), shared_path(spark, "items")
    if not (files := local_path(spark, path)):
        raise ValueError("the item source reads files that all executors see: spark.checkpoint.dir must be such a folder")
    write_layout(tables.load("conversations").select("conv_id", "turn", "role"), path, tables.get("conversations"), buckets=16, format="json")
    spark.dataSource.register(ItemSource)
    found = spark.read.format("keyed_items").options(path=files, hash="conv_id", range="turn", key_type="number", buckets="16", **options).load()
    return found.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), attribute(F.parse_json("item"), "$.role", "string").alias("role"))


@_query("item_source_scan", "select conv_id, turn, role from conversations")
def item_source_scan(spark: SparkSession, d: str) -> DataFrame:
    return _item_files(spark, d)


@_query("item_source_key", "select conv_id, turn, role from conversations where conv_id = 3 and turn between 1 and 2")
def item_source_key(spark: SparkSession, d: str) -> DataFrame:
    return _item_files(spark, d, hash_value="3", range_from="1", range_to="2")


@_query("transposed_compare", f"select {LINES} from lineitem where 45 < l_quantity")
def transposed_compare(spark: SparkSession, d: str) -> DataFrame:
    return read(_table(spark, d, "lineitem"), parse(spark, "45 < l_quantity")).select(*LINES.split(", "))


@_query("cast_column_compare", f"select {ORDERS} from orders where cast(round(o_totalprice) as bigint) >= 200000")
def cast_column_compare(spark: SparkSession, d: str) -> DataFrame:
    return read(_table(spark, d, "orders"), parse(spark, "cast(round(o_totalprice) as bigint) >= 200000")).select(*ORDERS.split(", "))


@_query("cast_key_compare", f"select {ORDERS} from orders where cast(o_orderkey as varchar) = '5' or cast(o_orderkey as decimal(38,0)) = 9")
def cast_key_compare(spark: SparkSession, d: str) -> DataFrame:
    own = _table(spark, d, "orders")
    return read(own, parse(spark, "cast(o_orderkey as string) = '5' or cast(cast(o_orderkey as bigint) as bigint) = 9", types=dict(own.dtypes))).select(*ORDERS.split(", "))


@_query("scan_full", "select count(*) as n, sum(l_orderkey) as keys, sum(l_linenumber)::bigint as numbers from lineitem")
def scan_full(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "lineitem").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.sum("l_linenumber").alias("numbers"))


# projection, nesting, lists, numbers, compound keys
@_query("project_star", "select * from nation")
def project_star(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "nation").select("*")


@_query("project_columns", "select c_custkey, c_mktsegment from customer")
def project_columns(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "customer").select("c_custkey", "c_mktsegment")


@_query("nested_field", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def nested_field(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").select("event_id", attribute(F.parse_json("props"), "$.k", "bigint").alias("k"))


@_query("nested_filter", "select event_id, user_id from events where cast(json_extract_string(props, '$.k') as bigint) >= 50")
def nested_filter(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").where(attribute(F.parse_json("props"), "$.k", "bigint") >= 50).select("event_id", "user_id")


@_query("list_index", "select vec_id, embedding[1] as first, embedding[64] as last, embedding[65] as beyond from embeddings")
def list_index(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    return spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", element(e, 0).alias("first"), element(e, 63).alias("last"), element(e, 64).alias("beyond"))


@_query("list_indexes", "select vec_id, x[1] is null as gap, x[3] as third, x[6] as sixth, len(x)::int as n from (select vec_id, [null, null, embedding[3], null, null, embedding[6]] as x from embeddings)")
def list_indexes(spark: SparkSession, d: str) -> DataFrame:
    own = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", elements(F.col("embedding"), [2, 5]).alias("x"))
    return own.select("vec_id", element(F.col("x"), 0).isNull().alias("gap"), element(F.col("x"), 2).alias("third"), element(F.col("x"), 5).alias("sixth"), F.size("x").alias("n"))


@_query("number_as_text", "select o_orderkey, regexp_replace(cast(o_totalprice as varchar), '[.]0$', '') as price, cast(cast(o_totalprice as decimal(18,2)) as varchar) as rounded, (o_orderkey + 1) || '0000000000000000000000' as large from orders")
def number_text(spark: SparkSession, d: str) -> DataFrame:
    price, large = F.col("o_totalprice"), F.concat((F.col("o_orderkey") + 1).cast("string"), F.lit("E22"))
    return _table(spark, d, "orders").select("o_orderkey", number_as_text(price).alias("price"), number_as_text(price, 2).alias("rounded"), number_as_text(large).alias("large"))


@_query("item_map_decode", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, 'k' as names from events")
def item_map_decode(spark: SparkSession, d: str) -> DataFrame:
    own = _table(spark, d, "events").select("event_id", F.parse_json("props").alias("item"))
    own = own.select("event_id", attribute(F.col("item"), "$", "struct<k: bigint>").alias("m"), attribute(F.col("item"), "$", "map<string, bigint>").alias("names"))
    return own.select("event_id", "m.k", F.array_join(F.map_keys("names"), ",").alias("names"))


@_query("item_list_decode", "select vec_id, embedding[1] as a, embedding[3] as c, 3 as n from embeddings")
def item_list_decode(spark: SparkSession, d: str) -> DataFrame:
    text = F.to_json(F.struct(F.slice("embedding", 1, 3).alias("l")))
    own = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", attribute(F.parse_json(text), "$.l", "array<double>").alias("l"))
    return own.select("vec_id", element(F.col("l"), 0).cast("float").alias("a"), element(F.col("l"), 2).cast("float").alias("c"), F.size("l").alias("n"))


@_query("item_set_decode", "select conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') as roles from conversations group by conv_id")
def item_set_decode(spark: SparkSession, d: str) -> DataFrame:
    own = _table(spark, d, "conversations").groupBy("conv_id").agg(as_set(F.collect_list("role")).alias("roles"))
    return own.select("conv_id", F.array_join("roles", ",").alias("roles"))


@_query("mapper_hash_split", "select c_name, substr(c_name, 1, 9) as kind, substr(c_name, 10) as number from customer")
def mapper_hash_split(spark: SparkSession, d: str) -> DataFrame:
    return map_keys(_table(spark, d, "customer").select("c_name"), LengthSplit(9, ("kind", "number")), "c_name")


@_query("mapper_range_numeric", "select c_name, s_name, substr(c_name, 1, 9) as h1, substr(c_name, 10) as h2, try_cast(substr(s_name, 1, 9) as bigint) as r1, try_cast(substr(s_name, 10) as bigint) as r2 from customer join supplier on c_custkey = s_suppkey")
def mapper_range_numeric(spark: SparkSession, d: str) -> DataFrame:
    both = _table(spark, d, "customer").join(_table(spark, d, "supplier"), F.col("c_custkey") == F.col("s_suppkey")).select("c_name", "s_name")
    own = map_keys(both, LengthSplitBoth(9, ("h1", "h2", "r1", "r2")), "c_name", "s_name")
    return own.withColumns({c: F.col(c).cast("bigint") for c in ("r1", "r2")})


@_query("mapper_part_filter", "select c_custkey, substr(c_name, 10) as number from customer where substr(c_name, 10) >= '000000100'")
def mapper_part_filter(spark: SparkSession, d: str) -> DataFrame:
    own = Catalog(spark, d, [TableDef("customer", "c_name")], [("custo.*", {"type": "length-split", "length": 9, "names": ("kind", "number")})]).load("customer")
    return read(own, attr("number") >= "000000100").select("c_custkey", "number")


# absent and null attributes: items with a note that is absent, null or there, by the remainder of k
ITEMS = "case when event_id % 3 = 0 then '{\"id\": 1}' when event_id % 3 = 1 then '{\"note\": null}' else '{\"note\": \"x\"}' end"


def _items(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "events").select("event_id", F.parse_json(F.expr(ITEMS)).alias("item"))


@_query("attr_not_exists", "select event_id from events where event_id % 3 = 0")
def attr_not_exists(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where(attribute_not_exists(F.col("item"), "$.note")).select("event_id")


@_query("attr_exists", "select event_id from events where event_id % 3 <> 0")
def attr_exists(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where(attribute_exists(F.col("item"), "$.note")).select("event_id")


@_query("attr_is_null", "select event_id from events where event_id % 3 = 1")
def attr_is_null(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).where(attribute_is_null(F.col("item"), "$.note")).select("event_id")


# predicates over items: text and numbers under one name, null and absent
DRIFT = "case when event_id % 4 = 0 then '{\"v\": \"1\"}' when event_id % 4 = 1 then '{\"v\": 1}' when event_id % 4 = 2 then '{\"v\": null}' else '{\"w\": {\"x\": [5, 7]}}' end"


def _drift(name: str, predicate: Predicate, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        items = _table(spark, d, "events").select("event_id", "user_id", F.parse_json(F.expr(DRIFT)).alias("item"))
        return read_items(items, predicate, keys=("event_id", "user_id")).select("event_id")

    QUERIES[name], ORACLES[name] = run, f"select event_id from events where {sql}"


_drift("item_text", attr("v") == "1", "event_id % 4 = 0")
_drift("item_number", attr("v") == 1, "event_id % 4 = 1")
_drift("item_unequal", attr("v") != 1, "event_id % 4 = 0")
_drift("item_null", attr("v").is_null(), "event_id % 4 = 2")
_drift("item_query_null", (attr("user_id") == 3) & attr("v").is_null(), "user_id = 3 and event_id % 4 = 2")
_drift("item_absent", attr("v").not_exists(), "event_id % 4 = 3")
_drift("item_nested", (attr("w.x[1]") >= 6) & attr("w.x").exists(), "event_id % 4 = 3")


# predicates over the items that the table has
def _stored(name: str, predicate: Predicate, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        items = _table(spark, d, "events").select("event_id", "user_id", F.parse_json("props").alias("item"))
        return read_items(items, predicate, keys=("event_id", "user_id")).select("event_id")

    QUERIES[name], ORACLES[name] = run, f"select event_id from events where {sql}"


K = "cast(json_extract_string(props, '$.k') as bigint)"
_stored("stored_number", attr("k") >= 50, f"{K} >= 50")
_stored("stored_in", attr("k").isin(3, 7, 11), f"{K} in (3, 7, 11)")
_stored("stored_key_and_number", (attr("user_id") == 3) & (attr("k") < 50), f"user_id = 3 and {K} < 50")
_stored("stored_exists", attr("k").exists() & attr("other").not_exists(), f"{K} is not null")


# segments, catalogue
@_query("table_stats", " union all ".join(f"select '{t}' as name, count(*) as n from {t}" for t in sorted(t.name for t in STAR)))
def table_stats(spark: SparkSession, d: str) -> DataFrame:
    return Catalog(spark, d).stats()


ASKED = [
    ("orders", "o_orderkey = 1 or (o_orderkey = 2 and o_totalprice >= 2)", "Get(hash=1) + Query(hash=2, filter=o_totalprice >= 2)"),
    ("lineitem", "l_orderkey = 10 and l_linenumber between 2 and 5", "Query(hash=10, range=l_linenumber BETWEEN 2 AND 5)"),
    ("events", "user_id = 3 or event_type = 'error'", "Scan(filter=(user_id = 3 OR event_type = 'error'); a condition fixes no single hash key)"),
    ("orders", "o_orderkey in (3, 4)", "Get(hash=3) + Get(hash=4)"),
    ("orders", "cast(o_orderkey as string) = '5'", "Get(hash=5)"),
]
quoted = lambda row: "(" + ", ".join("'" + x.replace("'", "''") + "'" if x is not None else "cast(null as varchar)" for x in row) + ")"


@_query("explain_access", f"select * from (values {', '.join(map(quoted, ASKED))}) as t(name, predicate, path)")
def explain_access(spark: SparkSession, d: str) -> DataFrame:
    tables = Catalog(spark, d)
    paths = [(t, p, classify(tables.get(t), parse(spark, p, types=dict(tables.load(t).dtypes))).explain()) for t, p, _ in ASKED]
    return spark.createDataFrame(paths, "name string, predicate string, path string")


@_query("segment_scan", "select count(*) as n, sum(l_orderkey) as keys, 8::bigint as segments from lineitem")
def segment_scan(spark: SparkSession, d: str) -> DataFrame:
    each = with_segment(_table(spark, d, "lineitem"), "l_orderkey", 8).groupBy("segment").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))
    return each.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.count("*").alias("segments"))


@_query("table_listing", f"select * from (values {', '.join(quoted((t.name, t.hash_key, t.range_key)) for t in STAR)}) as t(name, hash_key, range_key)")
def table_listing(spark: SparkSession, d: str) -> DataFrame:
    return Catalog(spark, d).listing()


# what the host engine supplies: joins, aggregates, windows, sorts, set operations
def _sql(name: str, text: str, oracle: str | None = None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tables = Catalog(spark, d)
        own = {t: tables.load(t) for t in tables.names() if f"{{{t}}}" in text}
        return spark.sql(text, **own)

    QUERIES[name] = run
    plain = text
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations"):
        plain = plain.replace(f"{{{t}}}", t)
    ORACLES[name] = oracle or plain


_sql("join_inner", "select n_name, r_name from {nation} join {region} on n_regionkey = r_regionkey")
_sql("join_left", "select c_custkey, o_orderkey from {customer} left join {orders} on c_custkey = o_custkey")
_sql("join_right", "select c_custkey, s_suppkey from {customer} right join {supplier} on c_custkey = s_suppkey + 1000000")
_sql("join_full", "select c_custkey, s_suppkey from {customer} full join {supplier} on c_custkey = s_suppkey + 10")
_sql("join_semi", "select c_custkey from {customer} left semi join {orders} on c_custkey = o_custkey", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)")
_sql("join_anti", "select c_custkey from {customer} left anti join {orders} on c_custkey = o_custkey", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
_sql("join_theta", "select a.n_nationkey as a, b.n_nationkey as b from {nation} a join {nation} b on a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")
_sql("join_three", "select r_name, count(*) as n, round(sum(o_totalprice), 2) as total from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey group by r_name")
_sql("join_broadcast", "select /*+ BROADCAST(n) */ c_custkey, n_name from {customer} c join {nation} n on c_nationkey = n_nationkey")
_sql("join_merge", "select /*+ MERGE(c) */ o_orderkey, c_mktsegment from {orders} o join {customer} c on o_custkey = c_custkey")
_sql("join_shuffled_hash", "select /*+ SHUFFLE_HASH(c) */ c_mktsegment, count(*) as n from {orders} o join {customer} c on o_custkey = c_custkey group by c_mktsegment")
_sql("agg_group","select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity, round(avg(l_discount), 6) as discount from {lineitem} group by l_returnflag, l_linestatus")
_sql("agg_having", "select o_custkey, count(*) as n from {orders} group by o_custkey having count(*) > 12")
_sql("agg_distinct", "select count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers from {lineitem}")
_sql("distinct_rows", "select distinct l_returnflag, l_linestatus from {lineitem}")
_sql("agg_grouping_sets", "select o_orderstatus, o_orderpriority, count(*) as n from {orders} group by grouping sets ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
_sql("agg_rollup", "select l_returnflag, l_linestatus, count(*) as n from {lineitem} group by rollup (l_returnflag, l_linestatus)")
_sql("agg_cube", "select l_returnflag, l_linestatus, count(*) as n from {lineitem} group by cube (l_returnflag, l_linestatus)")
_sql("window_rank", "select o_custkey, o_orderkey, r from (select o_custkey, o_orderkey, rank() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as r from {orders}) where r <= 2")
_sql("window_lag", "select event_id, lag(event_id) over (partition by user_id order by ts, event_id) as before from {events}")
_sql("sort_limit", "select o_orderkey, o_totalprice from {orders} order by o_totalprice desc, o_orderkey limit 20")
_sql("range_order", "select conv_id, turn, role from {conversations} where conv_id = 3 order by turn")
_sql("set_union", "select c_nationkey as k from {customer} union select s_nationkey as k from {supplier}")
_sql("set_union_all", "select n_regionkey as k from {nation} union all select r_regionkey as k from {region}")
_sql("set_intersect", "select c_nationkey as k from {customer} intersect select s_nationkey as k from {supplier}")
_sql("set_except", "select p_partkey as k from {part} except select l_partkey as k from {lineitem}")
_sql("set_intersect_all", "select c_nationkey as k from {customer} intersect all select s_nationkey as k from {supplier}")
_sql("set_except_all", "select c_nationkey as k from {customer} except all select s_nationkey as k from {supplier}")
_sql("scalar_functions","select n_nationkey, upper(n_name) as u, lower(n_name) as l, length(n_name) as n, concat(n_name, '-', n_regionkey) as c, abs(n_regionkey - 3) as a, coalesce(nullif(n_regionkey, 1), -1) as q from {nation}", "select n_nationkey, upper(n_name) as u, lower(n_name) as l, length(n_name)::int as n, concat(n_name, '-', n_regionkey) as c, abs(n_regionkey - 3) as a, coalesce(nullif(n_regionkey, 1), -1) as q from nation")


@_query("window_frame", "select o_orderkey, count(*) over (partition by o_custkey order by o_orderkey rows between 2 preceding and current row) as n from orders")
def window_frame(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(-2, 0)
    return _table(spark, d, "orders").select("o_orderkey", F.count("*").over(w).alias("n"))


_sql("join_non_equi", "select n_nationkey, r_regionkey from {nation} join {region} on n_nationkey < r_regionkey * 5")
_sql("join_cross", "select n_nationkey, r_regionkey from {nation} cross join {region}")
_sql("agg_approx_distinct", "select abs(approx_count_distinct(l_partkey, 0.01) - count(distinct l_partkey)) <= 0.05 * count(distinct l_partkey) as near from {lineitem}", "select true as near")
_sql("agg_statistics", "select o_orderpriority, round(stddev_samp(o_totalprice), 4) as spread, min(o_totalprice) as low, max(o_totalprice) as high, round(percentile(o_totalprice, 0.5), 4) as middle from {orders} group by o_orderpriority", "select o_orderpriority, round(stddev_samp(o_totalprice), 4) as spread, min(o_totalprice) as low, max(o_totalprice) as high, round(quantile_cont(o_totalprice, 0.5), 4) as middle from orders group by o_orderpriority")
_sql("date_functions", "select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, date_format(o_orderdate, 'yyyy-MM-dd') as d, datediff(date_add(to_date(o_orderdate), 30), to_date(o_orderdate)) as gap, date_format(date_trunc('MONTH', o_orderdate), 'yyyy-MM-dd') as first from {orders}", "select o_orderkey, year(o_orderdate)::int as y, month(o_orderdate)::int as m, strftime(o_orderdate, '%Y-%m-%d') as d, 30 as gap, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as first from orders")
_sql("array_functions", "select p_partkey, size(split(p_name, ' ')) as n, array_join(array_sort(split(p_name, ' ')), ' ') as sorted, array_contains(split(p_name, ' '), 'red') as red, aggregate(sequence(1, p_size), 0, (a, x) -> a + x) as total from {part}", "select p_partkey, len(string_split(p_name, ' '))::int as n, array_to_string(list_sort(string_split(p_name, ' ')), ' ') as sorted, list_contains(string_split(p_name, ' '), 'red') as red, (p_size * (p_size + 1) // 2)::int as total from part")
_sql("map_functions", "select n_nationkey, element_at(map('key', n_nationkey, 'region', n_regionkey), 'region') as region, cardinality(map('a', 1, 'b', n_nationkey)) as n, array_join(map_keys(map_filter(map('a', 1, 'b', n_nationkey), (k, v) -> v > 3)), ',') as above from {nation}", "select n_nationkey, n_regionkey as region, 2 as n, case when n_nationkey > 3 then 'b' else '' end as above from nation")
_sql("regexp_functions", "select c_custkey, regexp_extract(c_name, '([0-9]+)$', 1) as digits, regexp_replace(c_name, '[0-9]+', '#') as plain, c_name rlike '1$' as one from {customer}", "select c_custkey, regexp_extract(c_name, '([0-9]+)$', 1) as digits, regexp_replace(c_name, '[0-9]+', '#') as plain, regexp_matches(c_name, '1$') as one from customer")
_sql("math_functions", "select p_partkey, round(sqrt(p_retailprice), 6) as root, round(power(p_size, 2), 2) as square, p_size % 7 as rest, sign(p_size - 25) as side, greatest(p_size, 10) as most from {part}", "select p_partkey, round(sqrt(p_retailprice), 6) as root, round(power(p_size, 2), 2) as square, p_size % 7 as rest, sign(p_size - 25)::double as side, greatest(p_size, 10) as most from part")
_sql("json_functions", "select event_id, get_json_object(props, '$.k') as k, json_array_length(concat('[', get_json_object(props, '$.k'), ', 1]')) as n from {events}", "select event_id, json_extract_string(props, '$.k') as k, 2 as n from events")


# functions of one's own: in SQL, over Arrow batches, over groups, and one that makes rows
@_query("udf_sql", "select o_orderkey, o_totalprice / 2 as half from orders")
def udf_sql(spark: SparkSession, d: str) -> DataFrame:
    spark.sql("create or replace temporary function half(x double) returns double return x / 2")
    _table(spark, d, "orders").createOrReplaceTempView("udf_orders")
    return spark.sql("select o_orderkey, half(o_totalprice) as half from udf_orders")


@_query("udf_arrow", "select n_nationkey, length(n_name)::int as n from nation")
def udf_arrow(spark: SparkSession, d: str) -> DataFrame:
    @F.pandas_udf("int")
    def size(names: pd.Series) -> pd.Series:
        return names.str.len()

    return _table(spark, d, "nation").select("n_nationkey", size("n_name").alias("n"))


@_query("udaf_arrow", "select o_orderpriority, max(o_totalprice) - min(o_totalprice) as spread from orders group by o_orderpriority")
def udaf_arrow(spark: SparkSession, d: str) -> DataFrame:
    @F.pandas_udf("double")
    def spread(prices: pd.Series) -> float:
        return prices.max() - prices.min()

    return _table(spark, d, "orders").groupBy("o_orderpriority").agg(spread("o_totalprice").alias("spread"))


@_query("udtf", "select n_nationkey, unnest(range(1, n_regionkey + 1))::int as i from nation")
def udtf(spark: SparkSession, d: str) -> DataFrame:
    class Count:
        def eval(self, n: int):
            for i in range(1, n + 1):
                yield (i,)

    spark.udtf.register("count_to", F.udtf(Count, returnType="i int"))
    _table(spark, d, "nation").createOrReplaceTempView("udtf_nation")
    return spark.sql("select n_nationkey, i from udtf_nation, lateral count_to(n_regionkey)")
