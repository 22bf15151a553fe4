"""The corpus pipeline: quality rules, near duplicates, personal data, packing.

Each stage works on all that the one before it kept. All but the last return the columns of
``documents`` (and further ones that the table has, whatever their names); the last returns a row per
piece of a document and its place in a sequence. Every stage takes an empty table and gives one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eqspark.llm import minhash_join, packing, pii, quality_forest
from eqspark.llm.common import documents, fresh_dir, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the isolation forest keep. The rules reject null and empty texts;
    equal texts have equal verdicts; very long ones are read whole."""
    return quality_forest.keep_good(docs, quality_forest.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar texts: of the kept text, the one of least identifier,
    null identifiers last. Repeated rows are copies."""
    return minhash_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind. Null and empty texts stay as they are."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens. A null or empty text is a piece of one token,
    its end; repeated rows have a place each; null identifiers stay."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("pack", pack)]

#: The forest, the signatures and the tokenizer have no SQL form; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next. What a stage has
    stored on its way, and the stage before it, goes when its result stands."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"stage-{name}")
        with scratch(spark, before):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
