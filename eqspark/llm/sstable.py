"""Sorted-string-table shards of token ids.

File layout: data blocks, sparse index, Bloom filter, footer. A block holds entries in key order,
each ``shared, unshared, value length`` as varints, the key's unshared bytes and the value; it is
zstd-compressed. A key shares its prefix with the key before it in the block. The index has the
first key, place and length of every block; the footer says where index and filter are.

A key is the identifier as 8 big-endian bytes with the sign bit flipped (byte order is numeric
order); a null identifier is the empty key and comes first.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, fresh_dir, map_rows, shared_reader, shared_writer, ship
from .word_bpe import word_encoder

MAGIC = b"EQSSTBL1"
FOOTER = struct.Struct("<QQQQQQ8s")  # index at, index bytes, filter at, filter bytes, entries, ids
HASHES, BITS_PER_KEY = 7, 10


def encode_key(identifier: int | None) -> bytes:
    return b"" if identifier is None else struct.pack(">Q", identifier + (1 << 63))


def decode_key(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def key_hashes(key: bytes) -> tuple[int, int]:
    return struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())


def bloom(hashes: list[tuple[int, int]]) -> bytes:
    """A filter over keys given by their hashes, by double hashing."""
    size = max(64, BITS_PER_KEY * len(hashes))
    bits = np.zeros((size + 7) // 8 * 8, np.uint8)
    if hashes:
        h = np.array(hashes, np.uint64)
        for i in range(HASHES):
            bits[(h[:, 0] + np.uint64(i) * h[:, 1]) % np.uint64(size)] = 1
    return struct.pack("<Q", size) + np.packbits(bits, bitorder="little").tobytes()


class Writer:
    """Writes entries that come in key order to an open binary file, a block at a time."""

    def __init__(self, out, block_bytes: int = 1 << 18):
        self.out, self.block_bytes = out, block_bytes
        self.at = self.entries = self.ids = 0
        self.index: list[tuple[bytes, int, int]] = []
        self.hashes: list[tuple[int, int]] = []
        self.block, self.first, self.last = bytearray(), b"", None
        self.zstd = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, value: bytes) -> None:
        if self.last is not None and key < self.last:
            raise ValueError("keys must come in order")
        shared = 0
        if self.block:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        if key != self.last:
            self.hashes.append(key_hashes(key))
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.last = key
        self.entries += 1
        self.ids += len(value) // 4
        if len(self.block) >= self.block_bytes:
            self.flush()

    def flush(self) -> None:
        if self.block:
            data = self.zstd.compress(bytes(self.block))
            self.out.write(data)
            self.index.append((self.first, self.at, len(data)))
            self.at += len(data)
            self.block = bytearray()

    def close(self) -> None:
        self.flush()
        index = b"".join(varint(len(k)) + k + varint(at) + varint(n) for k, at, n in self.index)
        bits = bloom(self.hashes)
        self.out.write(index + bits + FOOTER.pack(self.at, len(index), self.at + len(index), len(bits), self.entries, self.ids, MAGIC))


class Reader:
    """Lookup by filter and binary search over the sparse index, and a scan in key order.

    ``file`` is open for reading anywhere; footer, index and filter are read at once, blocks when needed.
    """

    def __init__(self, file):
        self.file = file
        end = file.seek(0, 2)
        index_at, index_n, bloom_at, bloom_n, self.entries, self.ids, magic = FOOTER.unpack(self._bytes(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a table file")
        index, at = self._bytes(index_at, index_n), 0
        self.keys, self.blocks = [], []
        while at < index_n:
            size, at = read_varint(index, at)
            self.keys.append(index[at : at + size])
            place, at = read_varint(index, at + size)
            length, at = read_varint(index, at)
            self.blocks.append((place, length))
        bits = self._bytes(bloom_at, bloom_n)
        self.bits, self.filter = struct.unpack_from("<Q", bits)[0], bits[8:]

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def may_hold(self, key: bytes) -> bool:
        a, b = key_hashes(key)
        places = (((a + i * b) & (1 << 64) - 1) % self.bits for i in range(HASHES))
        return all(self.filter[p >> 3] >> (p & 7) & 1 for p in places)

    def block(self, number: int) -> Iterator[tuple[bytes, bytes]]:
        data, at, key = zstandard.ZstdDecompressor().decompress(self._bytes(*self.blocks[number])), 0, b""
        while at < len(data):
            shared, at = read_varint(data, at)
            own, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + data[at : at + own]
            at += own
            yield key, data[at : at + size]
            at += size

    def get(self, identifier: int | None) -> list[bytes]:
        """All values of an identifier (several where rows repeat it)."""
        key, found = encode_key(identifier), []
        if not self.may_hold(key):
            return found
        for number in range(max(0, bisect.bisect_left(self.keys, key) - 1), len(self.keys)):
            if self.keys[number] > key:
                break
            found += [v for k, v in self.block(number) if k == key]
        return found

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for number in range(len(self.blocks)):
            yield from self.block(number)


def write_tables(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write one table file per key range below ``folder``; return the stored manifest:
    ``part, path, entries, n_ids, first_key, last_key`` (encoded keys), ordered by ``part`` as by key.

    Texts are dealt by ranges of (identifier, text hash), so repeated identifiers don't meet in one
    task, and are encoded where they land. A null text is the empty text (only the end id). Ties
    in the identifier are in order of text hash, then text. An empty table writes no file.
    """
    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie", "text")
    schema = "part int, path string, entries long, n_ids long, first_key binary, last_key binary"
    arrow = arrow_schema(schema)
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def write(batches):
        encode, part = word_encoder(tokenizer).encode, TaskContext.get().partitionId()
        path, first, key, writer = f"{folder}/{part:06d}.sst", None, None, None
        batches = (b for b in batches if b.num_rows)
        batch = next(batches, None)
        if batch is None:
            return
        with shared_writer(path) as out:
            writer = Writer(out)
            while batch is not None:
                for at in range(0, batch.num_rows, 1024):
                    part_of = batch.slice(at, 1024)
                    for i, text in zip(part_of.column(0).to_pylist(), part_of.column(1).to_pylist(), strict=True):
                        key = encode_key(i)
                        if not writer.entries:
                            first = key
                        writer.add(key, encode(text) + tail)
                batch = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "entries": [writer.entries], "n_ids": [writer.ids], "first_key": [first], "last_key": [key]}, schema=arrow)

    manifest = f"{folder}/manifest"
    dealt.select("id", "text").mapInArrow(write, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def scan_tables(manifest: DataFrame) -> DataFrame:
    """Read every file of a manifest: ``doc_id, start, n_tokens, ids_crc32``, a file a task."""
    spark = manifest.sparkSession
    files = sorted(manifest.select("part", "path", "n_ids").collect(), key=lambda r: r["part"])  # a row a file
    before, rows = 0, []
    for r in files:
        rows.append((r["path"], before))
        before += r["n_ids"]
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    frame = spark.createDataFrame(rows, "path string, before long").repartition(len(rows), "path")

    def make():
        def work(columns):
            ids, starts, sizes, sums = [], [], [], []
            for path, start in zip(*columns, strict=True):
                with shared_reader(path) as file:
                    for key, value in Reader(file):
                        ids.append(decode_key(key))
                        starts.append(start)
                        sizes.append(len(value) // 4)
                        sums.append(zlib.crc32(value))
                        start += len(value) // 4
            return {"doc_id": ids, "start": starts, "n_tokens": sizes, "ids_crc32": sums}

        return work

    return map_rows(frame, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, manifest: DataFrame, identifier: int | None) -> list[bytes]:
    """Values of one identifier (null has its own key): files by key range, then filter, index and
    the blocks that may hold it; nothing else of a file is read. Several where rows repeat it."""
    key, found = F.lit(encode_key(identifier)), []
    for r in manifest.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("part").collect():
        with shared_reader(r["path"]) as file:
            found += Reader(file).get(identifier)
    return found


def tables_of(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the tables of ``docs`` to a fresh shared folder and read them back."""
    return scan_tables(write_tables(docs, fresh_dir(docs.sparkSession, "sst"), tokenizer))
