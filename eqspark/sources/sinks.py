"""Sinks: keyed upserts and JSON exports."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def last_of_each(rows: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """One row a key: the one with the greatest ``order``, or the last in the order of partitions."""
    rest = [c for c in rows.columns if c != key]
    best = rows.withColumn("order_", F.monotonically_increasing_id() if order is None else order).groupBy(key).agg(F.max_by(F.struct(*rest), "order_").alias("r_"))
    return best.select(key, "r_.*").select(*rows.columns)


def upsert(existing: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those of the same key; of a key that ``new``
    repeats, its last row."""
    return existing.join(new.select(key), key, "left_anti").unionByName(last_of_each(new, key))


def append_version(new: DataFrame, path: str, batch: int, key: str = "doc_id") -> None:
    """Add a batch's rows to a versioned table. Nothing that is there is read or rewritten, and a batch
    that is run again replaces only its own rows."""
    last_of_each(new, key).write.mode("overwrite").parquet(f"{path}/version={2 * batch}")


def newest(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """A versioned table's rows: of each key the one of the highest version."""
    rows = spark.read.option("basePath", path).parquet(path)
    return last_of_each(rows, key, F.col("version")).drop("version")


def compact(spark: SparkSession, path: str, key: str = "doc_id") -> None:
    """Merge all versions into one that stands right behind the newest, then delete them. Readers see the
    same rows before, between and after."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("version=")]
    last = max(int(p.getName()[len("version=") :]) for p in found)
    newest(spark, path, key).write.mode("overwrite").parquet(f"{path}/version={last // 2 * 2 + 1}")
    for p in found:
        if p.getName() != f"version={last // 2 * 2 + 1}":
            fs.delete(p, True)


def write_markdown(docs: DataFrame, folder: str, name: Column | None = None) -> int:
    """A file per document (``name``, or its identifier with ``.md``), as conversions are kept for a later
    run. A null text is an empty file. Returns the number of files; characters beyond letters, digits and
    ``._-`` in a name become ``_``."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".md")) if name is None else name
    named = docs.select(F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_").alias("name"), F.encode(F.coalesce("markdown", F.lit("")), "UTF-8").alias("data"))
    uri = folder if "://" in folder or folder.startswith("file:") else "file://" + os.path.abspath(folder)

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(uri)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = f"{inner}/.{file}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data.as_py())
                system.move(part, f"{inner}/{file}")  # whole or not at all, however often a task runs
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return named.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def to_json(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """A line of JSON per document: its key and its record."""
    rest = [c for c in records.columns if c != key]
    record = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest)
    return records.select(F.to_json(F.create_map(F.col(key).cast("string"), record), {"ignoreNullFields": "false"}).alias("value"))


def export_lines(records: DataFrame, path: str, key: str = "doc_id") -> None:
    """A folder of files with a line of JSON per document, for tables of any size."""
    to_json(records, key).write.mode("overwrite").text(path)


def export_json(records: DataFrame, path: str, merge: bool = False, key: str = "doc_id") -> None:
    """One indented JSON file, for a table small enough for a file; ``merge`` keeps other keys of the file."""
    whole: dict = {}
    if merge:
        try:
            with open(path, encoding="utf-8") as f:
                whole = json.load(f)
        except FileNotFoundError:
            pass
    for row in to_json(records, key).toLocalIterator():
        whole.update(json.loads(row[0]))
    with open(path, "w", encoding="utf-8") as f:
        json.dump(whole, f, indent=2, ensure_ascii=False)
        f.write("\n")
