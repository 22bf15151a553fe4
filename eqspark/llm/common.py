"""Shared plumbing: shipping the package to executors, stable 64-bit word hashes, and distributed ranking without a single-partition window."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import fresh_dir, scratch, shared_dir, stored  # noqa: F401

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+``; bytes.split() splits at exactly these.
SPACE = " \t\n\r\x0b\x0c"


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as keep it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(names: list[str]) -> list[Column]:
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors (once per Spark context)."""
    sc = spark.sparkContext
    if getattr(sc, "_eqspark_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="eqspark-src-")) / "eqspark_src.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, f"{package.name}/{p.relative_to(package)}")
    sc.addPyFile(str(target))
    atexit.register(shutil.rmtree, str(target.parent), ignore_errors=True)
    sc._eqspark_shipped = True


def local_path(uri: str) -> str | None:
    """The mounted path of a ``file:`` URI or a plain path; None for other file systems."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


@contextlib.contextmanager
def shared_writer(uri: str):
    """A binary file in the shared folder that appears under its name only when it is whole, so
    that a retried or speculative task is harmless."""
    path, part = local_path(uri), uuid.uuid4().hex
    if path is None:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(uri)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{inner}.{part}") as out:
            yield out
        system.move(f"{inner}.{part}", inner)
    else:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.{part}", "wb") as out:
            yield out
        os.replace(f"{path}.{part}", path)


@contextlib.contextmanager
def shared_reader(uri: str):
    """A file of the shared folder, open for reading anywhere in it."""
    path = local_path(uri)
    if path is None:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(uri)
        with system.open_input_file(inner) as f:
            yield f
    else:
        with open(path, "rb") as f:
            yield f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_rows(df: DataFrame, make: Callable[[], Callable[[list[list]], Iterator[dict] | dict | None]], schema: str) -> DataFrame:
    """mapInArrow over column lists. ``make`` runs once a task and returns a function from the
    columns of a batch (Python lists) to a dict of output columns."""
    ship(df.sparkSession)
    arrow = arrow_schema(schema)

    def run(batches):
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # Python copies of a part at a time
                out = work([c.to_pylist() for c in batch.slice(at, 1024).columns])
                if out is not None:
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class Bounded(dict):
    """A memo for per-word results that holds at most ``limit`` entries, so that a worker's memory
    stays bounded however many distinct words it meets. Half of them are older: when the newer half
    is full, it takes the older one's place, and an older entry that is asked for becomes new again."""

    def __init__(self, compute, limit: int = 600_000, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest, self.older = compute, limit // 2, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def ranked(df: DataFrame, order: list[str], label: str) -> tuple[DataFrame, str]:
    """``df`` with the 0-based place of each row in the total order of ``order``, and that column's
    name: ``rank``, or one like it that ``df`` doesn't have.

    Rows are dealt by range and sorted within partitions; a stored copy fixes the partitions and
    one count per partition gives the offsets, so no task sees more than its range. ``order`` should
    end in columns that tell rows apart, so that a hot leading value is split between ranges. ``df``
    is read twice (once to find the ranges) and should be a stored table.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank, at, part, before = free_names(df, "rank", "at", "part", "before")
    place = F.monotonically_increasing_id()  # partition << 33 | place in the partition
    kept = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(at, place), label)
    counts = kept.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count(F.lit(1)).alias(before)).collect()
    n, rows = 0, []
    for r in sorted(counts, key=lambda r: r[0]):
        rows.append((r[0], n))
        n += r[1]
    offsets = spark.createDataFrame(rows, f"{part} long, {before} long")  # a row a partition: small at any size
    joined = kept.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(offsets), part)
    return joined.select(*quoted(df.columns), (F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).alias(rank)), rank


def join_one(left: DataFrame, right: DataFrame, key: str, label: str) -> DataFrame:
    """Inner join of a stored table with one that has a row a key, however many rows of ``left`` share a key.

    Keys with more than a quarter of a task's fair share of the rows, of which there are at most four a
    task, are joined by broadcast, all others by a shuffle. Rows whose key is null are dropped.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(left.count() // (4 * parts), 2)
    often = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") >= least).select(key)
    hot = stored(right.join(F.broadcast(often), key), label)
    columns = quoted([*left.columns, *[c for c in right.columns if c != key]])
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right, key)
    return left.join(F.broadcast(hot), key).select(*columns).union(cold.select(*columns))
