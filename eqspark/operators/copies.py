"""Documents of equal inputs: what follows from the inputs alone is made once for all of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stored import fresh_dir, scratch

_SUMS = ["s0", "s1", "s2", "s3"]
_DIGEST = ["none_", "n_", *_SUMS]


def _halves(table: DataFrame, number: int) -> list[Column]:
    """Two 64-bit hashes of a row but for its key, in halves, so that their sums stay in range. Nulls count as such."""
    values = [x for c in table.columns if c != "doc_id" for x in (F.col(c).isNull(), F.col(c))]
    hashes = [F.xxhash64(F.lit(2 * number + k), *values) for k in (0, 1)]
    return [half for h in hashes for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]


def digests(tables: list[DataFrame]) -> DataFrame:
    """Per ``doc_id`` a digest of its rows in all tables, whatever their order: the number of rows and the
    sums of their 128-bit hashes; and whether the identifier is null. One partial aggregate; no text is shuffled."""
    rows = [t.select("doc_id", F.lit(1).alias("n_"), *[h.alias(s) for h, s in zip(_halves(t, i), _SUMS, strict=True)]) for i, t in enumerate(tables)]
    return reduce(DataFrame.unionAll, rows).groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in ("n_", *_SUMS)]).withColumn("none_", F.col("doc_id").isNull())


def once(make: Callable[..., DataFrame], *tables: DataFrame) -> DataFrame:
    """The rows of ``make(*tables)``, with the work done for one document of each group of equal inputs.

    Each table has ``doc_id``, and what ``make`` returns for a document must follow from the rows that have
    its identifier; the identifier itself is only a key. Every document gets its rows, whether it has copies
    or none. A null identifier, which joins treat unlike others, is a group of its own.

    Groups that hold more than a quarter of a task's fair share of the documents, of which there are at
    most four a task, meet their documents by broadcast, all others by a shuffle (or as Spark plans it).
    """
    spark = tables[0].sparkSession
    label = getattr(make, "__name__", "once").strip("_")
    paths = {name: fresh_dir(spark, f"{label}-{name}") for name in ("members", "firsts", "made")}

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name])

    members = kept(digests(list(tables)), "members")
    with scratch(spark, paths["firsts"]):
        firsts = kept(members.groupBy(*_DIGEST).agg(F.min("doc_id").alias("first_"), F.count(F.lit(1)).alias("copies_")), "firsts")
        made = make(*[t.join(firsts, t["doc_id"].eqNullSafe(firsts["first_"]), "left_semi") for t in tables])
        columns = made.columns
        made = kept(made.join(firsts, made["doc_id"].eqNullSafe(firsts["first_"])).drop("doc_id", "first_"), "made")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col("copies_") >= max(members.count() // (4 * parts), 2)
    often, rest = made.where(hot).drop("copies_"), made.where(~hot).drop("copies_")
    return members.join(F.broadcast(often), _DIGEST).select(*columns).unionAll(members.join(rest, _DIGEST).select(*columns))
