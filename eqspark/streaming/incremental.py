"""Incremental extraction: new Markdown files are extracted and upserted, a batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import dataset
from ..operators.resolve import extract_equations
from ..sources.sinks import append_version, last_of_each


def stream_markdown(spark: SparkSession, path: str) -> DataFrame:
    files = spark.readStream.text(path, wholetext=True, pathGlobFilter="*.md")
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.md$", 1).alias("doc_id"), F.col("value").alias("markdown"))


def start(spark: SparkSession, source: str, target: str, checkpoint: str, limit: int = 200, **trigger):
    """A query that keeps ``target`` up to date, to be read with ``sinks.newest``.

    Each batch adds its own documents' entries, also those without equations, which take the place of
    what an earlier text gave; a batch that is run again writes the same rows.
    """

    def batch(docs: DataFrame, number: int) -> None:
        docs = last_of_each(docs, "doc_id")
        append_version(dataset(extract_equations(docs, limit), docs), target, number)

    return stream_markdown(spark, source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
