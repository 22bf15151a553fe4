"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to the same number of bits, the cell's place on the curve orders the
rows, and shards are runs of that order. Rows that are near in all dimensions lie in few shards,
so the ranges in a shard's statistics prune files for filters on any of them. Sizes are quantised on a
logarithmic scale, names by their place in the alphabetical order of all names, so that ranges of cells
are ranges of values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, quoted, ranked, stored


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def curve_index(cells: list[Column], bits: int) -> Column:
    """Hilbert index of a cell's coordinates (each below ``2**bits``), by the transposed form: undo the
    rotations from the highest bit down, Gray-code, then interleave.

    The steps are folds over short literal arrays, whose state is computed once a step; written out as
    one expression, it would double with each of them.
    """
    n = len(cells)
    number = lambda **parts: F.struct(*[F.lit(v).alias(k) for k, v in parts.items()])
    levels = [number(q=1 << b, i=i) for b in range(bits - 1, 0, -1) for i in range(n)]
    places = [number(b=b, i=i) for b in range(bits - 1, -1, -1) for i in range(n)]

    def undo(x: Column, at: Column) -> Column:
        low, first, own = at["q"] - 1, F.get(x, F.lit(0)), F.get(x, at["i"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        flipped = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        swapped = F.transform(x, lambda v, j: F.when((j == 0) | (j == at["i"]), v.bitwiseXOR(swap)).otherwise(v))
        return F.when(own.bitwiseAND(at["q"]) != 0, flipped).when(at["i"] == 0, x).otherwise(swapped)

    def gray(x: Column) -> Column:
        return F.transform(x, lambda _, i: F.aggregate(F.slice(x, F.lit(1), i + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))

    def turned(x: Column) -> Column:
        last, masks = F.get(x, F.lit(n - 1)), F.array(*[F.lit(1 << b) for b in range(1, bits)]).cast("array<int>")
        turn = F.aggregate(masks, F.lit(0), lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a))
        return let(turn, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def woven(x: Column) -> Column:
        bit = lambda at: F.call_function("shiftright", F.get(x, at["i"]), at["b"]).bitwiseAND(F.lit(1)).cast("long")
        return F.aggregate(F.array(*places), F.lit(0).cast("long"), lambda a, at: a * 2 + bit(at))

    start = F.array(*[c.cast("int") for c in cells])
    x = F.aggregate(F.array(*levels), start, undo) if levels else start
    return let(x, lambda x: let(gray(x), lambda x: let(turned(x), woven)))


def log_cell(value: Column, bits: int, per_doubling: int = 2) -> Column:
    """A size's cell on a logarithmic scale, the same at every scale of the table."""
    cell = F.floor(F.log2(F.coalesce(value, F.lit(0)).cast("double") + 1) * per_doubling)
    return F.least(F.greatest(cell, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")


def name_bounds(rows: DataFrame, names: list[str], bits: int) -> list[list[str]]:
    """Of each column of names, at most ``2**bits - 1`` values, ascending, that cut its distinct values
    into parts of equal numbers: each value of its own where there are few enough.

    The distinct values are ranked in the cluster; only the bounds come to the driver.
    """
    most = (1 << bits) - 1
    value, at = F.col("value"), F.col("dimension")
    each = F.array(*[F.struct(F.lit(i).alias("dimension"), c.cast("string").alias("value")) for i, c in enumerate(quoted(names))])
    found = stored(rows.select(F.inline(each)).where(value.isNotNull()).distinct(), "names")
    placed, rank = ranked(found, ["dimension", "value"], "names")
    spans = placed.groupBy(at).agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))  # a row a dimension
    nth, size = F.col(rank) - F.col("first"), F.greatest("n", F.lit(most))
    begins = (nth == 0) | (F.floor(nth * most / size) > F.floor((nth - 1) * most / size))
    bounds: list[list[str]] = [[] for _ in names]
    for r in placed.join(F.broadcast(spans), "dimension").where(begins).select("dimension", "value").collect():
        bounds[r[0]].append(r[1])
    return [sorted(b, key=str.encode) for b in bounds]


def name_cell(value: Column, bounds: list[str]) -> Column:
    """A name's cell: the number of bounds that aren't behind it; a null is before all."""
    name, all_ = value.cast("string"), F.array(*[F.lit(b) for b in bounds]).cast("array<string>")
    return F.when(name.isNull(), 0).otherwise(F.size(F.filter(all_, lambda b: b <= name)))


def shard_by_curve(rows: DataFrame, dimensions: list[Column], shards: int, bits: int = 6, order: tuple[str, ...] = ("text_crc32", "doc_id", "size")) -> DataFrame:
    """``rows`` with ``cell`` (curve index), ``shard`` and ``slot``: ``shards`` runs along the curve
    whose row counts differ by at most one. Columns of these three names are replaced.

    Within a cell, rows are ordered by ``order``, which spreads a cell that holds a large share of
    all rows over as many ranges as it needs and keeps equal texts together. Rows equal in all of
    these are interchangeable. Nulls come first. Fewer rows than shards leave the last shards empty.
    An empty table stays empty.
    """
    kept = [c for c in rows.columns if c.lower() not in ("cell", "shard", "slot")]
    placed = stored(rows.select(*quoted(kept), curve_index(dimensions, bits).alias("cell")), "cells")
    inside, name = ranked(placed, ["cell", *order], "curve")
    each, more = divmod(placed.count(), shards)
    rank = F.col(name)
    edge = more * (each + 1)
    first = rank < edge  # the first ``more`` shards hold one row more
    shard = F.when(first, F.floor(rank / (each + 1))).otherwise(more + F.floor((rank - edge) / max(each, 1)))
    slot = F.when(first, rank % (each + 1)).otherwise((rank - edge) % max(each, 1))
    return inside.select(*quoted(kept), "cell", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, bits: int = 6, more: tuple[Column, ...] = ()) -> DataFrame:
    """Documents in shards over length, language and source, a row each: ``doc_id, size, text_crc32``, the
    three dimensions' cells, ``cell, shard, slot``.

    A null text is the empty text; null names have the first cell. Repeated rows and null identifiers keep
    their rows; an empty table gives none. Columns ``more`` of ``docs`` pass through, other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lang, source = name_bounds(docs, ["lang", "source"], bits)
    rows = docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        log_cell(F.length(text), bits).alias("length_cell"), name_cell(F.col("lang"), lang).alias("lang_cell"), name_cell(F.col("source"), source).alias("source_cell"), *more,
    )
    return shard_by_curve(rows, [F.col("length_cell"), F.col("lang_cell"), F.col("source_cell")], shards, bits)


def write_shards(docs: DataFrame, folder: str, shards: int = 40, bits: int = 6) -> DataFrame:
    """Write the rows of ``docs`` by shard and slot; return each shard's ranges, for pruning.

    Whole rows go through placing, so null and repeated identifiers lose and multiply none. The two
    columns are named ``shard`` and ``slot``, with underscores behind where ``docs`` has such columns.
    Rows are dealt by ranges of (shard, slot): a shard that outgrows a task is several files, in order.
    An empty table writes a folder without rows.
    """
    row = F.struct(*quoted(docs.columns)).alias("row")
    placed = shard_documents(docs, shards, bits, (row,))
    shard, slot = free_names(docs, "shard", "slot")
    table = placed.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table.repartitionByRange(max(parts, shards), shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
    ranges = [f(c).alias(f"{f.__name__}_{c}") for c in ("length_cell", "lang_cell", "source_cell") for f in (F.min, F.max)]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges)
