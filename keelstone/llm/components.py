"""Connected components by alternating large-star and small-star steps, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop, staged

SALT = 32


def with_least(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pairs (u, v) with m, the least v of their u, and m of every u, SALT times at most. The pairs of one u meet in SALT parts, each reduced before they are put together."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALT))).repartition("u", "salt")
    some = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = some.withColumn("m", F.min("m").over(Window.partitionBy("u")))
    return salted.join(least, ["u", "salt"]), least.select("u", "m")


def settled(edges: DataFrame) -> bool:
    """Whether every u of the distinct edges has one v, and no v is a u: then a further step changes nothing."""
    ends = edges.selectExpr("u x", "1 low", "0 top").union(edges.selectExpr("v x", "0 low", "1 top"))
    both = ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    return not both.where("low + top > 1").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """id and root (least id reachable) of every id in the links (a, b), of any type that has an order. Links may repeat and join an id to itself; nulls are ignored."""
    edges = staged(links.where("a <> b").selectExpr("greatest(a, b) u", "least(a, b) v").distinct(), "links")
    while not settled(edges):
        both = edges.select("u", "v").union(edges.selectExpr("v u", "u v"))
        near, _ = with_least(both)
        near, lowest = with_least(near.where("v > u").selectExpr("v u", "least(u, m) v"))
        small = near.where("v <> m").selectExpr("v u", "m v").union(lowest.selectExpr("u", "m v")).distinct()
        last, edges = edges, staged(small, "links")
        drop(last)
    return edges.selectExpr("u id", "v root").union(edges.selectExpr("v id", "v root").distinct())
