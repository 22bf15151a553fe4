"""An interpolated modified Kneser-Ney n-gram model of any order.

Counted in Spark, kept as sorted arrays of 64-bit hashes in the shared folder, and mapped into
memory by the workers that score. Nothing of the model passes through the driver but a few sums.

A text is preceded by as many START as the order asks for. The highest order has the n-grams' counts; a
lower one the number of different words before an n-gram, or its count where it begins with START.

Words are counted first (with their own counts for the add-one base), then n-grams of the highest
order. These are brought together by the word before the last: all of the lower orders and all
contexts follow within such a bucket, but for single words, whose continuations are added up at last.
Each task reduces what it reads to sorted arrays, cuts them into buckets by the high bits of a hash, and
shuffles one compressed row a bucket. A word with more than an eighth of a bucket's fair share of the
tokens is hot, and so is START: n-grams behind it are dealt over all buckets by their last two words,
and the partial sums of its contexts are brought together by another shuffle.
"""

from __future__ import annotations

import atexit
import os
import shutil
import struct
import tempfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, fresh_dir, local_path, map_rows, shared_writer, ship, stored

#: Hashes of the end and of the place before a text's first word; they can't be words, which have no blank.
END, START = (np.uint64(xxhash.xxh3_64_intdigest(s)) for s in (b" end", b" start"))
TOKENS_A_FLUSH, TOKENS_A_BUCKET = 1 << 21, 1 << 21
MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts, one after the other, each text with its end; and their numbers."""
    digest, out, sizes = xxhash.xxh3_64_intdigest, [], []
    end = int(END)
    for text in texts:
        words = tokens_of(text)
        out += map(digest, words)
        out.append(end)
        sizes.append(len(words) + 1)
    return np.array(out, np.uint64), np.array(sizes, np.int64)


def history(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """The n-grams that end at each token, as ``order`` columns of words; START before a text's beginning."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    place = np.arange(len(tokens)) - np.repeat(starts, sizes)
    columns = [tokens]
    for back in range(1, order):
        before = np.full_like(tokens, START)
        before[back:] = np.where(place[back:] >= back, tokens[:-back], START)
        columns.insert(0, before)
    return columns


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """Of one word its own hash, of more the words folded from the left."""
    h = words[0]
    for w in words[1:]:
        h = pair_hash(h, w)
    return h


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (context ^ context >> np.uint64(31)) * MIX + word
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def packed(*arrays: np.ndarray) -> bytes:
    zstd, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        data = zstd.compress(a.tobytes())
        out += [struct.pack("<2sI", a.dtype.str[1:].encode(), len(data)), data]
    return b"".join(out)


def unpacked(data: bytes) -> list[np.ndarray]:
    zstd, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<2sI", data, at)
        at += 6
        out.append(np.frombuffer(zstd.decompress(data[at : at + n]), np.dtype(kind.decode())))
        at += n
    return out


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) if len(keys) else v.astype(np.int64) for v in values)


def cut(bucket: np.ndarray) -> list[tuple[int, slice]]:
    """Slices of equal values of an ascending bucket column."""
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(edge[:-1], edge[1:])]


def high(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def bucket_of(before: np.ndarray, last: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """An n-gram's bucket: by the word before the last; where that is hot, by the last two."""
    return np.where(hot, high(pair_hash(before, last), bits), high(before, bits))


def count_shuffle(rows: DataFrame, emit, reduce, schema: str, parts: int) -> DataFrame:
    """Rows ``bucket, data`` from ``emit`` (batches -> pairs), brought together by bucket, and for
    each bucket the row that ``reduce`` makes of its list of data. Stored."""
    ship(rows.sparkSession)
    between, arrow = arrow_schema("bucket long, data binary"), arrow_schema(schema)

    def map_side(batches):
        for bucket, data in emit(batches):
            yield pa.RecordBatch.from_pydict({"bucket": [bucket], "data": [data]}, schema=between)

    def reduce_side(batches):
        now, held = None, []
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != now:
                    if held:
                        yield pa.RecordBatch.from_pylist([reduce(now, held)], schema=arrow)
                    now, held = bucket, []
                held.append(unpacked(data.as_py()))
        if held:
            yield pa.RecordBatch.from_pylist([reduce(now, held)], schema=arrow)

    dealt = F.pmod(F.col("bucket"), F.lit(parts)).cast("int")  # evenly: hashes would bring several buckets to one task
    shuffled = rows.mapInArrow(map_side, "bucket long, data binary").repartitionById(parts, dealt).sortWithinPartitions("bucket")
    return stored(shuffled.mapInArrow(reduce_side, schema), "counts")


def flushes(batches):
    """Arrays of (tokens, sizes) of about TOKENS_A_FLUSH tokens, from batches of texts."""
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            tokens, sizes = hashed(batch.column(0).slice(at, 512).to_pylist())
            if len(tokens):
                held.append((tokens, sizes))
                n += len(tokens)
            if n >= TOKENS_A_FLUSH:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def save(uri: str, key: np.ndarray, *values: np.ndarray) -> None:
    """Ascending keys and, for each, its values: a small table of all different ones and their numbers."""
    code = np.zeros(len(key), np.int64)
    for v in values:  # ranked after each column, so that numbers stay small
        _, rank = np.unique(v, return_inverse=True)
        _, code = np.unique(code * (int(rank.max(initial=0)) + 1) + rank, return_inverse=True)
    first = np.unique(code, return_index=True)[1]
    table = np.stack([v[first].astype(np.int64) for v in values], 1)
    for name, array in (("key", key), ("code", code.astype(np.min_scalar_type(len(first)))), ("table", table)):
        with shared_writer(f"{uri}.{name}.npy") as out:
            out.write(npy_header(array) + array.tobytes())


def npy_header(array: np.ndarray) -> bytes:
    import io

    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, np.lib.format.header_data_from_array_1_0(array))
    return out.getvalue()


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of items counted once to four times; 0.5, 1, 1.5 where too few to tell."""
    n1, n2, n3, n4 = counts
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    return tuple(float(min(max(k - (k + 1) * y * b / a, 0.0), k)) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


@dataclass
class Model:
    """Where a model's arrays lie, and its sums. Small, whatever the corpus."""

    folder: str
    order: int
    word_bits: int
    gram_bits: int
    hot_from: int  #: words with this count or more are hot
    train_tokens: int
    vocabulary: int
    discounts: list[tuple[float, float, float]]  #: of orders 1, 2, ...
    continuations: int
    word_levels: tuple[int, int, int]  #: words with 1, 2, 3+ continuations
    files: dict = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"files": {}}

    def find(self, kind: str, keys: np.ndarray, buckets: np.ndarray, values: int) -> list[np.ndarray]:
        """Values of keys (zeros where absent). Different keys are looked up in order, each bucket once."""
        unique, inverse = np.unique(keys, return_inverse=True)
        bucket = np.empty(len(unique), np.int64)
        bucket[inverse] = buckets
        order = np.argsort(bucket, kind="stable")
        unique, bucket = unique[order], bucket[order]
        found = np.zeros((len(unique), values), np.int64)
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
        for low, stop in zip(edge[:-1], edge[1:], strict=True):
            name = f"{kind}-{bucket[low]:05d}"
            if name not in self.files:
                self.files[name] = tuple(mapped(f"{self.folder}/{name}.{part}.npy") for part in ("key", "code", "table"))
            known, code, table = self.files[name]
            if len(known):
                place = np.minimum(np.searchsorted(known, unique[low:stop]), len(known) - 1)
                found[low:stop] = table[code[place]] * (known[place] == unique[low:stop])[:, None]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return list(found[back[inverse]].T)

    def score(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: its count, the base's and the model's log10 probability."""
        count, cont = self.find("word", tokens, high(tokens, self.word_bits), 2)
        base = np.log10((count + 1) / (self.train_tokens + self.vocabulary + 1))
        d = np.array([0.0, *self.discounts[0]])
        rest = sum(d * n for d, n in zip(self.discounts[0], self.word_levels, strict=True))
        total = max(self.continuations, 1)
        p = np.maximum(cont - d[np.minimum(cont, 3)], 0) / total + (rest / total if self.continuations else 1.0) / (self.vocabulary + 1)
        words = history(tokens, sizes, self.order)
        if self.order > 1:
            before = words[-2]
            hot = np.concatenate([[True], count[:-1] >= self.hot_from]) | (before == START)
            bucket = bucket_of(before, tokens, hot, self.gram_bits)
        for k in range(2, self.order + 1):
            (c,) = self.find(f"gram{k}", gram_hash(words[-k:]), bucket, 1)
            context = gram_hash(words[-k:-1])
            # a hot word's contexts are in files of their own; a key is looked up where it can be
            sums = self.find(f"context{k}", context, np.where(hot, high(context, self.gram_bits) + (1 << self.gram_bits), high(before, self.gram_bits)), 4)
            total, n1, n2, n3 = sums
            d = np.array([0.0, *self.discounts[k - 1]])
            safe = np.maximum(total, 1)
            mixed = np.maximum(c - d[np.minimum(c, 3)], 0) / safe + (d[1] * n1 + d[2] * n2 + d[3] * n3) / safe * p
            p = np.where(total > 0, mixed, p)
        return count, base, np.log10(p)


FETCHED_BYTES = 8 << 30
_local: str | None = None
_fetched: dict[str, int] = {}


def mapped(uri: str) -> np.ndarray:
    """A .npy file as a memory map; empty where there is none. A file in a store that isn't mounted is
    fetched first; of such files a worker keeps at most FETCHED_BYTES, the newest."""
    global _local
    path = local_path(uri)
    if path is None:
        from pyarrow import fs

        if _local is None:
            _local = tempfile.mkdtemp(prefix="eqspark-model-")
            atexit.register(shutil.rmtree, _local, ignore_errors=True)
        path = f"{_local}/{xxhash.xxh3_64_hexdigest(uri.encode())}.npy"
        system, inner = fs.FileSystem.from_uri(uri)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            return np.zeros(0, np.uint64)
        if path not in _fetched:
            while _fetched and sum(_fetched.values()) + info.size > FETCHED_BYTES:
                oldest = next(iter(_fetched))
                del _fetched[oldest]
                os.remove(oldest)  # maps of it stay valid while they are in use
            with system.open_input_stream(inner) as src, open(f"{path}.part", "wb") as out:
                shutil.copyfileobj(src, out)
            os.replace(f"{path}.part", path)
            _fetched[path] = info.size
    elif not os.path.exists(path):
        return np.zeros(0, np.uint64)
    return np.load(path, mmap_mode="r")


def power_of_two(n: float) -> int:
    """Bits of the least power of two that is not below n."""
    return max(0, int(np.ceil(np.log2(max(n, 1)))))


def sums_of(context: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each context: the sum of its counts, and how many are 1, 2, and 3 or more."""
    return summed(context, count, count == 1, count == 2, count >= 3)


def train(texts: DataFrame, order: int = 3) -> Model:
    """Count a model over the one column ``text`` of ``texts`` (null is the empty text: one end).

    Every row counts, repeated ones each time. Without rows the model gives each token 1 / (V + 1).
    """
    if order < 1:
        raise ValueError("the order is at least 1")
    spark = texts.sparkSession
    texts = texts.select("text")
    folder = fresh_dir(spark, "kneser-ney")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    word_bits = power_of_two(parts)

    # 1: words
    def words(batches):
        for tokens, _ in flushes(batches):
            key, count = summed(tokens, np.ones(len(tokens), np.int8))
            for b, s in cut(high(key, word_bits)):
                yield b, packed(key[s], count[s].astype(np.uint32))

    def add_words(bucket, held):
        key, count = summed(*map(np.concatenate, zip(*held, strict=True)))
        return {"bucket": bucket, "data": packed(key, count), "n": int(count.sum()), "v": len(key)}

    counted = count_shuffle(texts, words, add_words, "bucket int, data binary, n long, v long", parts)
    sums = counted.agg(F.sum("n"), F.sum("v")).first()
    n, v = sums[0] or 0, sums[1] or 0
    bits = power_of_two(n / TOKENS_A_BUCKET)
    hot_from = max(n >> bits >> 3, 1)
    levels = {k: [0] * 4 for k in range(1, order + 1)}
    after = counted.select(F.lit(0).alias("kind"), "data").limit(0)

    if order > 1:
        # the hot words: a sorted array a word bucket, at most eight words a bucket of n-grams in all
        def hot_words(batches):
            for batch in batches:
                for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    key, count = unpacked(data.as_py())
                    often = key[count >= hot_from]
                    if len(often):
                        save(f"{folder}/hot-{bucket:05d}", often, np.ones(len(often), np.int8))
                yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

        counted.select("bucket", "data").mapInArrow(hot_words, "n long").agg(F.sum("n")).collect()
        hot = Model(folder, order, word_bits, bits, hot_from, n, v, [], 0, (0, 0, 0))

        # 2: n-grams of the highest order, by the word before the last
        def grams(batches):
            for tokens, sizes in flushes(batches):
                columns = history(tokens, sizes, order)
                key = gram_hash(columns)
                by = np.argsort(key)
                first = np.flatnonzero(np.concatenate([[True], key[by[1:]] != key[by[:-1]]]))
                count, at = np.diff(np.append(first, len(by))), by[first]
                columns = [c[at] for c in columns]
                (is_hot,) = hot.find("hot", columns[-2], high(columns[-2], word_bits), 1)
                bucket = bucket_of(columns[-2], columns[-1], (is_hot > 0) | (columns[-2] == START), bits)
                by = np.lexsort((*columns[:-2], columns[-2], bucket))  # equal words in runs, which compress
                bucket, count = bucket[by], count[by]
                columns = [c[by] for c in columns]
                for b, s in cut(bucket):
                    yield b, packed(*[c[s] for c in columns], count[s].astype(np.uint32))

        def add_grams(bucket, held):
            *columns, count = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            count, found, partial = count.astype(np.int64), [], []
            for k in range(order, 0, -1):
                key = gram_hash(columns)
                if k < order:  # words before, or the count itself where START is the only one
                    count = np.where(columns[0] == START, count, 1)
                by = np.argsort(key)
                first = np.flatnonzero(np.concatenate([[True], key[by[1:]] != key[by[:-1]]]))
                count, key, columns = np.add.reduceat(count[by], first), key[by[first]], [c[by[first]] for c in columns]
                if k == 1:
                    return {"bucket": bucket, "levels": found, "data": packed(key, count.astype(np.uint32)), "hot": partial}
                found.insert(0, [int((count == m).sum()) for m in (1, 2, 3, 4)])
                save(f"{folder}/gram{k}-{bucket:05d}", key, count)
                before = columns[-2]
                (is_hot,) = hot.find("hot", before, high(before, word_bits), 1)
                is_hot = (is_hot > 0) | (before == START)
                context = gram_hash(columns[:-1])
                save(f"{folder}/context{k}-{bucket:05d}", *sums_of(context[~is_hot], count[~is_hot]))
                key, *rest = sums_of(context[is_hot], count[is_hot])
                partial += [{"kind": k, "bucket": b, "data": packed(key[s], *[r[s] for r in rest])} for b, s in cut(high(key, bits))]
                columns = columns[1:]

        paired = count_shuffle(texts, grams, add_grams, "bucket int, levels array<array<long>>, data binary, hot array<struct<kind:int,bucket:int,data:binary>>", min(parts, 1 << bits))
        for k in range(2, order + 1):
            levels[k] = [int(x or 0) for x in paired.agg(*[F.sum(F.col("levels")[k - 2][m]) for m in range(4)]).first()]

        # 3: sums of the hot words' contexts
        def contexts(batches):
            for batch in batches:
                for kind, bucket, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield bucket + (kind << 32), data

        def add_contexts(both, held):
            bucket, kind = both & 0xFFFFFFFF, both >> 32
            save(f"{folder}/context{kind}-{bucket + (1 << bits):05d}", *summed(*map(np.concatenate, zip(*held, strict=True))))
            return {"bucket": both}

        partial = paired.select(F.explode("hot").alias("h")).select("h.kind", "h.bucket", "h.data")
        count_shuffle(partial, contexts, add_contexts, "bucket long", min(parts, 1 << bits))
        after = paired.select(F.lit(0).alias("kind"), "data")

    # 4: continuations, beside the words' own counts
    def continuations(batches):
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                key, value = unpacked(data.as_py())
                value, none = value.astype(np.int64), np.zeros(len(key), np.int64)
                for b, s in cut(high(key, word_bits)):
                    yield b, packed(key[s], *((value[s], value[s] if order == 1 else none[s]) if kind else (none[s], value[s])))

    def add_continuations(bucket, held):
        key, count, cont = summed(*map(np.concatenate, zip(*held, strict=True)))
        save(f"{folder}/word-{bucket:05d}", key, count, cont)
        return {"bucket": bucket, "levels": [int((cont == k).sum()) for k in (1, 2, 3, 4)], "more": int((cont >= 3).sum()), "total": int(cont.sum())}

    done = count_shuffle(after.union(counted.select(F.lit(1), "data")), continuations, add_continuations, "bucket int, levels array<long>, more long, total long", parts)
    last = [int(x or 0) for x in done.agg(*[F.sum(F.col("levels")[k]) for k in range(4)], F.sum("more"), F.sum("total")).first()]
    levels[1] = last[:4]
    return Model(folder, order, word_bits, bits, hot_from, n, v, [discounts(levels[k]) for k in range(1, order + 1)], last[5], (last[0], last[1], last[4]))


def score_texts(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``n_tokens, n_known, train_tokens, base_score, score, perplexity``
    of the column ``text``; null is the empty text, which is its end alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    extra = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def make():
        model = shared.value

        def work(columns_in):
            tokens, sizes = hashed(columns_in[-1])
            count, base, own = model.score(tokens, sizes)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            score = np.add.reduceat(own, starts)
            out = dict(zip(columns, columns_in, strict=False))
            return out | {"n_tokens": sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), starts), "train_tokens": [model.train_tokens] * len(sizes), "base_score": np.add.reduceat(base, starts), "score": score, "perplexity": 10.0 ** (-score / sizes)}

        return work

    return map_rows(docs.select(*columns, "text"), make, ", ".join(f"{c} {fields[c]}" for c in columns) + f", {extra}")


def is_held_out(identifier: Column, folds: int = 7, fold: int = 2) -> Column:
    """crc32 of the identifier as text, modulo ``folds``; a null identifier counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(identifier.cast("string"), F.lit("")), "UTF-8")) % folds == fold


def score_documents(docs: DataFrame, order: int = 3) -> DataFrame:
    """Every document's score by the model of those that aren't held out.

    Null and empty texts have one token, their end; repeated rows and ties count and are scored each; a null
    identifier counts as the empty text in choosing the fold; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_texts(rows, train(rows.where(~F.col("held_out")), order), ["doc_id", "held_out"])
