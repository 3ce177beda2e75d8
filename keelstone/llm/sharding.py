"""Sharding by sampled splitters, with DataFrame operations only.

Records are put into the total order (hash of the text, hash of the id, row number). Splitters are quantiles of a sample
in which a record's chance is proportional to its size; they cut the order into ranges. As a splitter has all three
parts of the order, a text or an id that fills more than a range is subdivided by the parts after it. Each range is
sorted by one task; from the ranges' totals every record knows how many bytes and rows come before it in all, and the
shard follows from that: law "bytes" cuts the bytes, law "rows" the rows, into equal runs.

The text is read once; what is shuffled is some 50 bytes a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import staged

ORDER = ("k", "sub", "rid")
PER_RANGE = 64
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType()), T.StructField("law", T.StringType()), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()), T.StructField("grown_shard", T.IntegerType())])


def range_of(splitters: list[tuple[int, int, int]]) -> Column:
    """How many splitters are at or below a record: a binary search over three parallel arrays."""
    if not splitters:
        return F.lit(0)
    parts = [F.array(*(F.lit(int(x[i])).cast("long") for x in splitters)) for i in range(3)]
    k, sub, rid = (F.col(c) for c in ORDER)

    def step(at: Column, jump: Column) -> Column:
        to = at + jump
        own = [F.get(p, to - 1) for p in parts]
        below = (own[0] < k) | ((own[0] == k) & ((own[1] < sub) | ((own[1] == sub) & (own[2] <= rid))))
        return F.when((to <= len(splitters)) & below, to).otherwise(at)

    jumps = [1 << i for i in reversed(range(len(splitters).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, jumps)), F.lit(0), step)


def shard(docs: DataFrame, shards: int = 24, law: str = "bytes", rows_per_range: int = 4_000_000, least_ranges: int = 192) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot, grown_shard (null) of every row of docs.

    law "bytes": a shard's bytes differ from the mean by less than the largest record. law "rows": counts differ by one
    at most. Slots are gapless from 0 in each shard. Equal texts are neighbours in the order, so a group of copies lies
    in as few shards as its bytes need. A null text has size 8 and a null text_crc32, and stands before the others; a null
    doc_id is kept; rows that are alike in both get slots of their own. No rows give none. Only doc_id and text are read.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law: {law}")
    text = F.col("text")
    meta = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k"),
            F.xxhash64(F.lit("id"), F.col("doc_id").cast("long")).alias("sub"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "shard-meta",
    )
    n, total = meta.agg(F.count(F.lit(1)), F.sum("size")).first()
    if not n:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    ranges = max(least_ranges, -(-n // rows_per_range))
    chance = F.col("size") * (PER_RANGE * ranges / total)
    drawn = F.pmod(F.xxhash64(F.lit("draw"), *ORDER), F.lit(1 << 40)) / float(1 << 40)
    sample = sorted(tuple(r) for r in meta.where(drawn < chance).select(*ORDER).collect())
    splitters = sorted(set(sample[PER_RANGE::PER_RANGE]))
    ranged = meta.withColumn("r", range_of(splitters))
    before = {r["r"]: (r["b"], r["n"]) for r in ranged.groupBy("r").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    offsets, at = [], (0, 0)
    for r in range(len(splitters) + 1):
        offsets.append(at)
        at = tuple(x + y for x, y in zip(at, before.get(r, (0, 0)), strict=True))
    offset = lambda i: F.get(F.array(*(F.lit(x[i]).cast("long") for x in offsets)), F.col("r"))
    own = Window.partitionBy("r").orderBy(*ORDER)
    placed = (
        ranged.repartition(len(splitters) + 1, "r")
        .withColumn("bytes_before", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") + offset(0))
        .withColumn("rows_before", F.row_number().over(own) - 1 + offset(1))
    )
    done, most = (F.col("bytes_before"), total) if law == "bytes" else (F.col("rows_before"), n)
    number = F.floor((done.cast("decimal(38,0)") * shards) / F.lit(most).cast("decimal(20,0)")).cast("int")
    placed = staged(placed.select("doc_id", "size", "text_crc32", F.least(number, F.lit(shards - 1)).alias("shard"), "rows_before"), "shard-placed")
    first = {r["shard"]: r["f"] for r in placed.groupBy("shard").agg(F.min("rows_before").alias("f")).collect()}
    start = F.get(F.array(*(F.lit(first.get(s)).cast("long") for s in range(shards))), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("rows_before") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
