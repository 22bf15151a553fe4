"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_automaton, hilbert, kneser_ney, minhash_join, mpegts, packing, pii, quality_forest, sstable, token_cache
from .common import documents, fresh_dir, stored


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_cache.count_documents(documents(spark, sf_dir), fresh_dir(spark, "token-cache"))


def op2_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.tables_of(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality_forest.measure(documents(spark, sf_dir)), "quality-measured")
    return quality_forest.judge(measured, quality_forest.fit_measured(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    placed = hilbert.shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "cell")


def op5_transport_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpegts.read_streams(mpegts.store_streams(documents(spark, sf_dir)))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.join_documents(documents(spark, sf_dir))


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    # order 3 takes 6.5 times the input of disk, above what the check allows (README)
    return kneser_ney.score_documents(documents(spark, sf_dir), order=2)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_token_tables, op3_quality_forest, op4_hilbert_shards, op5_transport_streams, op6_personal_data, op7_jaccard_join, op8_bpe_automaton, op9_best_fit_packing, op10_kneser_ney)}
ORACLES: dict[str, str] = {}
