"""The pipeline on planted rows; it is skipped where the pipeline has been taken away."""

import random

import pytest

pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_each_decision(spark, tmp_path):
    rng = random.Random(8)
    words = {"en": [f"th{a}{b}" for a in "aeiou" for b in ["ng", "nk", "st", "re", "ly", "er"]], "de": [f"{a}sch{b}" for a in "aeiouäöü" for b in ["en", "er", "ung", "keit"]]}
    text = lambda k, n: " ".join(rng.choice(words[k]) + rng.choice(words[k]) for _ in range(n))
    rows = [(i, text("en" if i % 2 else "de", 80), "en" if i % 2 else "de", "s", 1) for i in range(60)]
    items = [(i, f"{text('en', 14)}. {text('en', 8)}.") for i in range(5)]
    copy = rows[7][1].split()
    copy[40] = "changed"
    rows += [(100, " ".join(copy), "en", "s", 1), (101, rows[8][1].replace(" ", "\n").title().replace("Ä", "ä").replace("Ö", "ö").replace("Ü", "ü"), "de", "s", 1), (102, f"{text('en', 40)} {items[2][1]} {text('en', 40)}", "en", "s", 1)]
    rows += [(103, None, None, None, None), (104, "12 34 !!", "en", "s", 1), (105, "漢字かな交じり文", None, "s", 1)] + rows[:1]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(60))
    assert all(r.same and r.n_tokens == len(r.ids) for r in got)
    assert len(pipeline.STAGES) == 4 and pipeline.ORACLE_SQL is None


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []
