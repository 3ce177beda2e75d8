"""The registered queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, id_files, language_id, license_scan, ngram_join, recurrent_lm, sentence_pieces, sharding, token_counts, topk


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.tokenize(_documents(spark, sf_dir), sentence_pieces.load(vocabulary_path("piece_bpe_32k.model")), ("doc_id", "ids", "n_tokens", "n_bytes", "score", "text_crc32", "same"))


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, k=10)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir), shards=24, law="bytes")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentence_pieces.load(vocabulary_path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_documents(spark, sf_dir), token_counts.greedy(vocabulary))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(_documents(spark, sf_dir))


def held_out(parts: int, part: int):
    """Whether crc32(doc_id as text) mod parts is part; a null id is in no part."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language_id.train(docs.where(~held_out(4, 2)))
    return language_id.identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "phrase_rate")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return license_scan.scan(docs, license_scan.train(license_scan.sample(docs)))


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.stored(_documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(_documents(spark, sf_dir), held_out(5, 1))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_maxscore": op3_maxscore,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_join": op6_ngram_join,
    "op7_language_id": op7_language_id,
    "op8_license_scan": op8_license_scan,
    "op9_id_files": op9_id_files,
    "op10_recurrent_lm": op10_recurrent_lm,
}

ORACLES: dict[str, str] = {
    "op3_maxscore": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 10
""",
}
