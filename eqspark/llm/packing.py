"""Packing documents into training sequences by large-item matching and best fit.

Documents are cut only where they are longer than a sequence. The packing is planned on the
histogram of piece lengths (at most one entry per length, however many documents there are):
at most two pieces above a third of the capacity fit in a bin, so these are matched greedily, the
longest with the longest that fits; shorter ones go, longest first, to the bin with the smallest
sufficient gap. The plan is a list of runs of equal pieces in equal bins; each piece finds its run
by its rank in the order of lengths.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, quoted, ranked, stored
from .word_bpe import word_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs ``(length, first, count, bin, per_bin, offset)`` and the number of bins.

    Of the pieces of a length, number ``first`` to ``first + count - 1`` go to bins from ``bin`` on,
    ``per_bin`` each, one after the other from ``offset``.
    """
    left = {n: c for n, c in histogram.items() if c}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: groups of (first bin, bins)
    order: list[int] = []  # the gaps there are, ascending
    bins = 0

    def place(length: int, count: int, at: int, per_bin: int, offset: int) -> None:
        runs.append((length, used[length], count, at, per_bin, offset))
        used[length] += count
        left[length] -= count

    def put_gap(gap: int, at: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((at, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        length = large[-1]
        k = bisect.bisect_right(large, capacity - length) - 1
        partner = large[k] if k >= 0 else None
        if partner == length and left[length] == 1:
            partner = large[k - 1] if k else None
        if partner is None:
            count = left[length]
            place(length, count, bins, 1, 0)
            put_gap(capacity - length, bins, count)
        elif partner == length:
            count = left[length] // 2
            place(length, 2 * count, bins, 2, 0)
            put_gap(capacity - 2 * length, bins, count)
        else:
            count = min(left[length], left[partner])
            place(length, count, bins, 1, 0)
            place(partner, count, bins, 1, length)
            put_gap(capacity - length - partner, bins, count)
        bins += count
        large = [n for n in large if left[n]]
    for length in sorted((n for n in left if left[n]), reverse=True):
        while left[length]:
            k = bisect.bisect_left(order, length)
            if k == len(order):  # no gap is left: open as many bins as this length needs
                count = -(-left[length] // (capacity // length))
                put_gap(capacity, bins, count)
                bins += count
                continue
            gap = order[k]
            at, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[k]
            each = gap // length
            full = min(count, left[length] // each)
            if full:
                place(length, full * each, at, each, capacity - gap)
                put_gap(gap - each * length, at, full)
            if full < count and left[length]:  # the last few, in one more bin
                rest = left[length]
                place(length, rest, at + full, rest, capacity - gap)
                put_gap(gap - rest * length, at + full, 1)
                full += 1
            put_gap(gap, at + full, count - full)
    return runs, bins


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's pieces.

    A null text is the empty text, which is one piece of the end id. Repeated rows each give their
    pieces; null ids stay null.
    """
    tail = struct.pack("<I", end_id)

    def make():
        encode = word_encoder(tokenizer).encode

        def work(columns):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for i, text in zip(*columns, strict=True):
                ids = memoryview(encode(text) + tail)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for k, v in zip(out, (i, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[k].append(v)
            return out

        return work

    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), make, PIECES)


def pack(pieces: DataFrame, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """``pieces`` (any table with a ``length``) with ``sequence_id`` and ``offset``.

    ``pieces`` is read twice and should be a stored table. Only its histogram of lengths, at most
    ``capacity`` rows, comes to the driver. Equal rows get different places. An empty table stays empty.
    Columns named like the two new ones are replaced; all others pass through.
    """
    pieces = pieces.drop("sequence_id", "offset")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(histogram, capacity)
    base, before = {}, 0
    for length in sorted(histogram):
        base[length] = before
        before += histogram[length]
    table = np.array(sorted((base[r[0]] + r[1], r[0], *r[3:]) for r in runs) or [(0, 1, 0, 1, 0)], np.int64)
    rows, last = ranked(pieces, ["length", *order], "pack")
    names = pieces.columns

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            rank = batch.column(len(names)).to_numpy()
            run = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
            nth = rank - run[:, 0]
            columns = [*batch.columns[:-1], pa.array(run[:, 2] + nth // run[:, 3]), pa.array(run[:, 4] + nth % run[:, 3] * run[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return rows.select(*quoted([*names, last])).mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096) -> DataFrame:
    return pack(stored(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """``sequence_id, ids``: the packed token ids themselves, each row at most a capacity long.

    Every row of ``placed`` takes a piece of ``docs`` with its identifier (or null), place, length and
    checksum; of several such, each takes another one, so no piece is lost or comes twice.
    """
    tail = struct.pack("<I", end_id)
    cut = placed.where("piece = 1").agg(F.max("start")).first()[0]  # the capacity, if any document is longer

    def make():
        encode = word_encoder(tokenizer).encode

        def work(columns):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for i, text in zip(*columns, strict=True):
                ids = np.frombuffer(encode(text) + tail, "<u4")
                for piece, at in enumerate(range(0, len(ids), cut or len(ids))):
                    part = ids[at : at + (cut or len(ids))]
                    for k, v in zip(out, (i, piece, at, len(part), zlib.crc32(part.tobytes()), part.tolist()), strict=True):
                        out[k].append(v)
            return out

        return work

    coded = map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, f"{PIECES}, ids array<int>")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    left = placed.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("sequence_id", "offset"))).alias("l")
    right = coded.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("ids"))).alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*key, "nth"]]
    parts = left.join(right, same).select("sequence_id", "offset", "ids")
    grouped = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
