"""Intermediate tables: the folder that all machines share, and tables in it that cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors can reach.

    It is ``spark.checkpoint.dir`` of the session. Only where that is unset in local mode (tests)
    a folder of our own is made and set as the checkpoint folder; it goes when Python ends. A cluster
    without the setting is refused, as its executors could not see the driver's folders.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = getattr(spark.sparkContext, "_eqspark_dir", None)
        if not configured:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="eqspark-")
            spark.sparkContext._eqspark_dir = configured
            spark.sparkContext.setCheckpointDir(configured)
            atexit.register(shutil.rmtree, configured, ignore_errors=True)
    return configured.rstrip("/")


_scopes: list[list[str]] = []


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    path = f"{shared_dir(spark)}/eqspark/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession, *more: str | None):
    """Deletes, at its end, the folders that ``fresh_dir`` named in it, and ``more``. For a step whose
    result is written in it to a folder that was named before."""
    _scopes.append([m for m in more if m is not None])
    try:
        yield
    finally:
        made = _scopes.pop()
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(hadoop).delete(where, True)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts lineage: a lost executor costs no more than the tasks that ran on it.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
