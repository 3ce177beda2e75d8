"""Exact top-k inner products by MaxScore.

A vector is a document over signed terms (dimension, sign); its impact for a term is the magnitude of the component.
Each shard of candidates (a task's rows, in parts of bounded size) holds postings for every term, sorted by position and
cut into blocks of positions. For a query the terms whose sign agrees with it score up to |q| * (largest impact), the
others can only lower a score. Terms are ordered by that bound; those whose bounds together stay below the k-th best score
so far are non-essential. A block's candidates come from the essential postings alone; the others are probed from the largest
bound down while a candidate can still compete, then the lowering terms finish the exact score. The shards' best k of each query
are merged by Spark.

Queries and candidates meet in tiles: a shard of bounded size and a block of queries, which are read one batch after the other.
A shard travels once for each block of queries, a query once for each shard; the driver sees neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import drop, staged

SCHEMA = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])
BLOCK = 1024
LARGEST = 1 << 26
MOST_TASKS = 1 << 15


class Shard:
    """Postings of a part of the candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, self.dims = self.vectors.shape
        self.blocks = -(-n // BLOCK)
        cuts = np.minimum(np.arange(self.blocks + 1) * BLOCK, n)
        self.docs, self.impacts, self.at, self.largest = [], [], [], np.zeros(2 * self.dims, np.int64)
        for term in range(2 * self.dims):
            column = self.vectors[:, term >> 1] * (-1 if term & 1 else 1)
            docs = np.flatnonzero(column > 0)
            self.docs.append(docs)
            self.impacts.append(column[docs])
            self.at.append(np.searchsorted(docs, cuts))
            self.largest[term] = column[docs].max(initial=0)

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the id own; ties to smaller ids."""
        dims = np.flatnonzero(query[: self.dims])
        terms = 2 * dims + (query[dims] < 0)
        weights = np.abs(query[dims])
        bounds = weights * self.largest[terms]
        order = np.argsort(bounds, kind="stable")
        terms, weights, bounds = terms[order], weights[order], bounds[order]
        below = np.cumsum(bounds)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in range(self.blocks):
            lo = b * BLOCK
            size = min(BLOCK, len(self.ids) - lo)
            # a score of the k-th best or less can't enter: equal scores of later (larger) ids lose
            least = scores[-1] if len(scores) == k else None
            split = int(np.searchsorted(below, least, "right")) if least is not None and least >= 0 else 0
            if least is not None and least >= 0 and split == len(terms):
                break
            sums = np.zeros(size, np.int64)
            seen = np.zeros(size, bool)
            for t in range(split, len(terms)):
                a, z = self.at[terms[t]][b : b + 2]
                at = self.docs[terms[t]][a:z] - lo
                sums[at] += weights[t] * self.impacts[terms[t]][a:z]
                seen[at] = True
            if least is None or least < 0:
                alive = np.arange(size)  # rows with no agreeing term can still be among the best
            else:
                alive = np.flatnonzero(seen & (sums + (below[split - 1] if split else 0) > least))
            for t in range(split - 1, -1, -1):
                if not len(alive):
                    break
                term = terms[t]
                sign = -1 if term & 1 else 1
                sums[alive] += weights[t] * np.maximum(sign * self.vectors[lo + alive, term >> 1], 0)
                alive = alive[sums[alive] + (below[t - 1] if t else 0) > least]
            if not len(alive):
                continue
            alive = alive[self.ids[lo + alive] != own]
            exact = self.vectors[lo + alive] @ query[: self.dims]
            ids, scores = np.concatenate([ids, self.ids[lo + alive]]), np.concatenate([scores, exact])
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
        return ids, scores


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The first dims components of each row, zeros where a row has fewer."""
    values = np.asarray(column.flatten(), dtype=np.int64)
    sizes = np.asarray(column.value_lengths(), dtype=np.int64)
    out = np.zeros((len(sizes), dims), np.int64)
    if len(values):
        rows = np.repeat(np.arange(len(sizes)), sizes)
        places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        first = places < dims
        out[rows[first], places[first]] = values[first]
    return out


def whole(vector: Column) -> Column:
    """The vector as integers floor(1024 * x); null where it or a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("long")))


def search(vectors: DataFrame, queries: Column, k: int = 10, query_block: int = 16_384, shard_rows: int = 32_768) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products with the rows of other ids.

    vectors: vec_id, embedding. queries tells which rows are queries. Rows with a null id, or whose vector is null or holds
    a null or a non-finite component, take no part. Vectors of different lengths are padded with zeros. A repeated candidate row
    counts as often as it stands there; queries that are alike in id and vector are answered once, and different vectors of
    one id in turn, each with ranks of its own. A component beyond 2**26 in magnitude after scaling is refused, as sums could
    pass 64 bits. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v"), F.coalesce(queries, F.lit(False)).alias("q")).where("vec_id is not null and v is not null")
    rows = staged(rows, "topk-vectors")  # row numbers of the written table are the same in every attempt
    total, count, dims, most = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("q"), 1)), F.max(F.when(F.col("q"), F.size("v"))), F.max(F.greatest(F.array_max(F.transform("v", F.abs)), F.lit(0)))).first()
    if not count or most >= LARGEST:
        drop(rows)
        if count:
            raise ValueError(f"a component of {most} after scaling passes {LARGEST}")
        return spark.createDataFrame([], SCHEMA)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards, blocks = max(-(-total // shard_rows), min(parts, -(-total // BLOCK))), -(-count // query_block)
    number, small = F.xxhash64(F.monotonically_increasing_id()), F.col("v").cast("array<int>").alias("v")
    asked = staged(rows.where("q").select("vec_id", "v").distinct(), "topk-queries").select("vec_id", small, F.monotonically_increasing_id().alias("copy"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("copy"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = rows.select("vec_id", small, F.lit(-1).cast("long").alias("copy"), F.pmod(number, F.lit(shards)).alias("shard")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tile = (F.col("block").cast("long") * shards + F.col("shard")).alias("tile")
    both = held.select(tile, F.lit(0).alias("kind"), "copy", "vec_id", "v").union(asked.select(tile, F.lit(1).alias("kind"), "copy", "vec_id", "v"))
    both = both.repartitionById(min(blocks * shards, MOST_TASKS), F.pmod("tile", F.lit(MOST_TASKS)).cast("int")).sortWithinPartitions("tile", "kind")
    out = both.mapInArrow(_searcher(max(dims, 1), k), "query_id long, copy long, vec_id long, score long")
    first = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(dims: int, k: int):
    """Of rows (tile, kind, copy, vec_id, v) in order of tile and kind, each tile's best k of every query (kind 1) among its candidates (kind 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, None
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            tile, kind, copy, own = (np.asarray(batch.column(c), dtype=np.int64) for c in ("tile", "kind", "copy", "vec_id"))
            cuts = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (kind[1:] != kind[:-1]), [True]])) if len(tile) else np.zeros(1, np.int64)
            for a, b in zip(cuts, cuts[1:], strict=False):
                rows = matrix(batch.column("v").slice(a, b - a), dims)
                if tile[a] != at:
                    at, shard, ids, vectors = tile[a], None, [], []
                if kind[a] == 0:
                    ids.append(own[a:b])
                    vectors.append(rows)
                elif ids or shard:
                    if shard is None:
                        shard, ids, vectors = Shard(np.concatenate(ids), np.concatenate(vectors)), [], []
                    found = [shard.best(q, w, k) for q, w in zip(own[a:b], rows, strict=True)]
                    sizes = [len(x) for x, _ in found]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own[a:b], sizes)), pa.array(np.repeat(copy[a:b], sizes)), pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([s for _, s in found]))], names=["query_id", "copy", "vec_id", "score"])

    return run
