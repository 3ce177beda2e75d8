"""The corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, piece encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelstone.llm import decontamination, language_id, ngram_join, sentence_pieces
from keelstone.llm.common import drop, staged
from keelstone.llm.queries import vocabulary_path


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a letter and parses into phrases of a learned language; with nothing to learn from, rows with a letter.

    Null and empty texts go. Rows may repeat, ids may be null; whole texts are read, however long. An empty table gives no rows.
    """
    return language_id.in_a_language(docs, language_id.train(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row, that with the least id; rows without words, rows without an id and every other text of an id stay."""
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item: all of them where there are no items. Rows may repeat; any column may be null."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and same (the ids decode to the text) of every row; a null or empty text has no ids."""
    pieces = sentence_pieces.load(vocabulary_path("piece_bpe_32k.model"))
    return sentence_pieces.tokenize(docs, pieces).select("doc_id", "ids", "n_tokens", "same")


STAGES = [("language_id", in_a_language), ("near_duplicates", one_of_each_group), ("decontamination", without_benchmark), ("sentencepiece", encoded)]

#: SQL can't express language ID by cross-parsing or the piece encoding: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all stages applied to documents, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop(before)
    return docs
