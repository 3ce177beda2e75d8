import zlib

import pytest

from keelstone.llm.sharding import shard

DOCS = "doc_id long, text string, size string, shard string"


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_laws(spark, law):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " * (i % 40), "x", "y") for i in range(3000)] + [(None, None, None, None)] * 3 + [(5, "", "", "")] * 2
    got = shard(spark.createDataFrame(rows, DOCS), law=law).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32 if r.text_crc32 is not None else -1) for r in got) == sorted((i if i is not None else -1, 8 + len((t or "").encode()), zlib.crc32(t.encode()) if t is not None else -1) for i, t, *_ in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert set(by) == set(range(24))
    for s in by.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    sums, counts = [sum(r.size for r in s) for s in by.values()], [len(s) for s in by.values()]
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        assert max(sums) - min(sums) <= 2 * max(r.size for r in got)


def test_small_and_unlike_tables(spark):
    assert shard(spark.createDataFrame([], DOCS)).collect() == []
    one = shard(spark.createDataFrame([(7, "é", "", "")], DOCS)).collect()
    assert [(r.doc_id, r.size, r.law, r.slot, r.grown_shard) for r in one] == [(7, 10, "bytes", 0, None)]
    with pytest.raises(ValueError):
        shard(spark.createDataFrame([], DOCS), law="none")


def test_same_again(spark):
    docs = spark.createDataFrame([(i, "ab" * (i % 7), "", "") for i in range(500)], DOCS)
    one = {r.doc_id: (r.shard, r.slot) for r in shard(docs).collect()}
    assert one == {r.doc_id: (r.shard, r.slot) for r in shard(docs.repartition(7)).collect()}
