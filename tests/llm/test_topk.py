import math
import random

import pytest
from pyspark.sql import functions as F

from keelstone.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, every, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found, 1)]
    return sorted(out)


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = random.Random(3)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.0, 0.25]) for _ in range(12)], 1, "x") for i in range(400)]
    rows += [(400 + i, rows[5][1], 1, "x") for i in range(20)]  # ties
    rows += [(500, None, 0, ""), (501, [1.0, None], 0, ""), (502, [float("nan")] * 12, 0, ""), (503, [float("inf")] * 12, 0, ""), (None, [1.0] * 12, 0, ""), (510, [-0.5] * 5, 0, ""), (520, [], 0, "")]
    rows = [(i, None if v is None else [None if x is None else float(__import__("numpy").float32(x)) for x in v], a, b) for i, v, a, b in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block in (10_000, 7):
        got = topk.search(df, F.col("vec_id") % 20 == 0, 10, query_block=block, shard_rows=64)
        assert sorted(map(tuple, got.collect())) == brute(rows, 20, 10)


def test_few_rows(spark):
    assert topk.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    df = spark.createDataFrame([(0, [1.0], 1, ""), (1, [-1.0], 1, ""), (2, [0.0], 1, "")], SCHEMA)
    assert sorted(map(tuple, topk.search(df, F.col("vec_id") == 0).collect())) == [(0, 1, 2, 0), (0, 2, 1, -1024 * 1024)]
    alike = spark.createDataFrame([(0, [1.0], 1, ""), (0, [1.0], 1, ""), (3, [1.0], 1, ""), (3, [1.0], 1, "")], SCHEMA)
    assert sorted(map(tuple, topk.search(alike, F.col("vec_id") == 0).collect())) == [(0, 1, 3, 1 << 20), (0, 2, 3, 1 << 20)]


def test_hot_id_and_queries_of_several_vectors(spark):
    """A third of the rows have one id: its different vectors are answered each, its equal rows once, in tiles of few rows."""
    rng = random.Random(4)
    rows = [(i + 1, [float(rng.randint(-2, 2)) for _ in range(4)], 0, "") for i in range(80)] + [(0, [1.0, 2.0, 0.0, -1.0], 0, "")] * 30 + [(0, [0.0, -1.0, 1.0, 1.0, 7.0], 0, "")] * 10
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = []
    for q in ([1, 2, 0, -1], [0, -1, 1, 1]):
        found = sorted((-sum(int(1024 * a) * 1024 * b for a, b in zip(v, q)), i) for i, v, *_ in rows if i)[:10]
        want += [(0, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    for block, shard in ((1, 9), (50, 1000)):
        assert sorted(map(tuple, topk.search(df, F.col("vec_id") == 0, 10, query_block=block, shard_rows=shard).collect())) == sorted(want)


def test_refused(spark):
    with pytest.raises(ValueError, match="passes"):
        topk.search(spark.createDataFrame([(0, [1e6], 0, "")], SCHEMA), F.col("vec_id") == 0)
