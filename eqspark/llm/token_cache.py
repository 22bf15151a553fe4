"""Token counts through a digest cache.

Each text gets the SHA-256 digest of its normalised content; the tokenizer's version is the digest
of its model file. Counts are looked up by both digests in a stored table, partitioned by version; only
the distinct texts that it lacks are encoded, and their counts are appended to it.
"""

from __future__ import annotations

import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_one, map_rows, stored

CACHE = "content_digest binary, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(path: str):
    """A function from a text to its number of tokens, by the library that the file is for."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


#: What normalisers change: compatibility forms, runs of blanks, control characters, case, marks.
PROBE = "  ﬁ  Ａ\t x\n\ne\u0301 ½ \u200b\x01Zz\u3000. "


def normaliser(path: str):
    """The model's own normalisation as a function from text to text; None where it leaves all characters
    as they are (blanks may have a stand-in, and one may be put in front)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        same = model.normalize(PROBE).replace("\u2581", " ") in (PROBE, " " + PROBE)
        return None if same else model.normalize
    from tokenizers import Tokenizer

    rules = Tokenizer.from_file(path).normalizer
    return None if rules is None else rules.normalize_str


def normalised(docs: DataFrame, path: str, id_column: str, text_column: str) -> DataFrame:
    """``doc_id, n_bytes, text, content_digest``; ``text`` in the model's normal form where it has one that
    changes texts, so that texts of one form share an entry."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    if normaliser(path) is not None:

        def make():
            form = normaliser(path)
            return lambda c: {"doc_id": c[0], "n_bytes": c[1], "text": list(map(form, c[2]))}

        rows = map_rows(rows, make, "doc_id long, n_bytes long, text string")
    return rows.withColumn("content_digest", F.unhex(F.sha2("text", 256)))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Counts of one tokenizer version, one row per content; None while nothing was stored.

    Two writers may both have appended a text; the counts are equal, and one is kept.
    """
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return None
    table = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer_digest") == version)
    return table.groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``.

    A null text is the empty text (no bytes, and no tokens with the public models). Repeated rows, ties
    and null ids stay as they are, a row each; an empty table gives no rows; other columns are not read.

    The distinct misses come from a partial aggregation, so a text that a third of the rows share reaches
    the encoder once. On the way back, texts with more than a quarter of a task's fair share of the rows
    (at most four a task, so their counts are few) are joined by broadcast, the others by digest.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    rows = normalised(docs, path, id_column, text_column)
    known = read_cache(spark, cache, version)
    missing = rows if known is None else rows.join(known, "content_digest", "left_anti")
    distinct = missing.groupBy("content_digest").agg(F.first("text").alias("text"))

    def make():
        count = counter(path)

        def work(columns):
            digests, texts = columns
            return {"content_digest": digests, "tokenizer_digest": [version] * len(texts), "n_tokens": [count(t) for t in texts]}

        return work

    found = map_rows(distinct.select("content_digest", "text"), make, CACHE)
    found.write.mode("append").partitionBy("tokenizer_digest").parquet(cache)
    counts = read_cache(spark, cache, version)
    if counts is None:  # nothing was stored, as there are no rows
        counts = found.select("content_digest", "n_tokens")
    sized = stored(rows.select("doc_id", "content_digest", "n_bytes"), "digests")
    return join_one(sized, counts, "content_digest", "hot-digests").select("doc_id", "n_bytes", "n_tokens")


def count_documents(docs: DataFrame, cache: str, limit: int = 4096) -> DataFrame:
    counted = count_tokens(docs, cache, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
