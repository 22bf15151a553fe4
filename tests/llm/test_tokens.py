"""Token counts, token tables, automaton encoding and packing against the libraries."""

import bisect
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from eqspark.llm import bpe_automaton, packing, sstable, token_cache
from eqspark.llm.common import fresh_dir, stored
from eqspark.llm.word_bpe import WordEncoder
from pyspark.sql import functions as F
from tokenizers import Tokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def le(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def word():
    library = Tokenizer.from_file(WORD)
    return lambda t: library.encode(t or "", add_special_tokens=False).ids + [1]


def test_counts(odd, docs, spark):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for table in (odd, docs):
        got = Counter(map(tuple, token_cache.count_documents(table, fresh_dir(spark, "t")).collect()))
        want = Counter()
        for i, t in table.select("doc_id", "text").collect():
            n = len(model.encode(t or ""))
            want[i, len((t or "").encode()), n, n > 4096] += 1
        assert got == want


def test_cache_encodes_only_misses(spark, odd, monkeypatch):
    cache = fresh_dir(spark, "t")
    first = odd.where("doc_id < 8")
    token_cache.count_documents(first, cache)
    before = spark.read.parquet(cache).count()
    assert before == first.selectExpr("coalesce(text, '')").distinct().count()
    a = sorted(map(tuple, token_cache.count_documents(odd.where("doc_id is not null"), cache).collect()))
    assert spark.read.parquet(cache).count() == odd.selectExpr("coalesce(text, '')").where("doc_id is not null").distinct().count()
    assert a == sorted(map(tuple, token_cache.count_documents(odd.where("doc_id is not null"), cache).collect()))


def test_cache_by_version_and_normal_form(spark, monkeypatch):
    cache = fresh_dir(spark, "t")
    library = Tokenizer.from_file(WORD)
    rows = [(i, t) for i, t in enumerate(["A b", "a  b", "a\tB", "ﬁ x", None, "", "a b c"] + ["hot text"] * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_cache.count_tokens(table, cache, WORD).collect()}
    assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}
    forms = {library.normalizer.normalize_str(t or "") for _, t in rows}
    assert spark.read.parquet(cache).count() == len(forms) < len({t for _, t in rows})
    assert {r.doc_id: r.n_tokens for r in token_cache.count_documents(table, cache).collect()}.keys() == got.keys()
    assert spark.read.parquet(cache).select("tokenizer_digest").distinct().count() == 2
    assert token_cache.normaliser(public_tokenizers.path("piece_bpe_32k.model")) is None

    def no_encoding(text):
        raise AssertionError("a text was encoded again")

    monkeypatch.setattr(token_cache, "counter", lambda path: no_encoding)
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_cache.count_tokens(table, cache, WORD).collect()} == got


def test_word_encoder_equals_library(word):
    own, r = WordEncoder(WORD), random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice("abAB'sdtl012 \t\n.,<>|éÉßİΣσςǅ́\x1c日ñ÷×\xa0¡") for _ in range(r.randint(0, 20)))
        assert own.encode(t) + le([1]) == le(word(t)), t


def test_token_tables(spark, odd, docs, word):
    for table in (odd, docs):
        folder = fresh_dir(spark, "t")
        manifest = sstable.write_tables(table, folder, WORD)
        rows = sstable.scan_tables(manifest).collect()
        want = Counter((i, len(word(t)), zlib.crc32(le(word(t)))) for i, t in table.select("doc_id", "text").collect())
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
        ordered = sorted(rows, key=lambda r: r.start)
        assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
        keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
        assert keys == sorted(keys)
    for i, t in docs.limit(20).select("doc_id", "text").collect():
        assert sstable.lookup(spark, manifest, i) == [le(word(t))]
    assert sstable.lookup(spark, manifest, 10**12) == []


def test_lookup_of_null_repeated_and_negative_identifiers(spark, word):
    rows = [(None, "none"), (None, "other"), (1, "a"), (-5, "b c"), (1, None), (2**62, "d"), (1, "a")]
    for table in (rows, [(None, "none")], rows[2:3]):
        made = spark.createDataFrame(table, "doc_id long, text string").repartition(2)
        manifest = sstable.write_tables(made, fresh_dir(spark, "t"), WORD)
        for i in (None, 1, -5, 2**62, 7, 0):
            assert sorted(sstable.lookup(spark, manifest, i)) == sorted(le(word(t)) for k, t in table if k == i)


def test_table_file_layout():
    import io

    out = io.BytesIO()
    writer = sstable.Writer(out, block_bytes=64)
    items = [(i, le(range(i % 7))) for i in sorted([*range(-300, 300, 3), 6, 6, 6])]
    for k, v in items:
        writer.add(sstable.encode_key(k), v)
    writer.close()
    reader = sstable.Reader(out)
    assert [(sstable.decode_key(k), v) for k, v in reader] == items and len(reader.blocks) > 20
    for i in range(-310, 310):
        assert reader.get(i) == [v for k, v in items if k == i]
    assert sum(reader.may_hold(sstable.encode_key(i)) for i in range(10_000, 12_000)) < 100


def test_automaton_equals_library(odd, docs):
    library = Tokenizer.from_file(BYTE)
    for table in (odd, docs):
        got = Counter(map(tuple, bpe_automaton.round_trip(table, BYTE).collect()))
        want = Counter()
        for i, t in table.select("doc_id", "text").collect():
            ids = library.encode(t or "", add_special_tokens=False).ids
            want[i, len(ids), hashlib.sha256(le(ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
        assert got == want


def test_automaton_on_random_words():
    own, library, r = bpe_automaton.AutomatonTokenizer(BYTE), Tokenizer.from_file(BYTE), random.Random(2)
    for _ in range(3000):
        t = "".join(r.choice(["a", "b", " ", "the", "in", "ing", "er", "ss", "-", "==", "\n", "\r", "\t", "'s", "'ll", "'", "É", "7", "¿", "é", "日"][: r.choice([20, 21])]) for _ in range(r.randint(0, 24)))
        assert own.encode(t) == le(library.encode(t, add_special_tokens=False).ids), t


def merged(word, merges):
    """Plain byte-pair encoding: the earliest merge everywhere, from the left, again and again."""
    parts = [bytes([b]) for b in word]
    while True:
        found = [merges.index(p) for p in zip(parts, parts[1:]) if p in merges]
        if not found:
            return parts
        (a, b), out, i = merges[min(found)], [], 0
        while i < len(parts):
            two = parts[i : i + 2] == [a, b]
            out.append(a + b if two else parts[i])
            i += 1 + two
        parts = out


@pytest.mark.parametrize("seed", range(60))
def test_automaton_equals_plain_merging(seed):
    r, letters = random.Random(seed), [bytes([c]) for c in b"abcd"[: 1 + seed % 4]]
    parts, merges = list(letters), []
    for _ in range(r.randint(0, 40)):
        a, b = r.choice(parts), r.choice(parts)
        if a + b not in parts and len(a + b) < 12:
            merges.append((a, b))
            parts.append(a + b)
    numbers = list(range(3 * len(parts)))
    r.shuffle(numbers)
    labels = dict(zip(parts, numbers))
    own = bpe_automaton.MergeAutomaton(labels, bpe_automaton.compile_automaton(labels, merges))
    for _ in range(300):
        word = b"".join(r.choices(letters, k=r.randint(0, 25)))
        assert own.encode(word) == [labels[p] for p in merged(word, merges)]
        assert own.decode(own.encode(word)) == word


def test_automaton_needs_one_merge_a_token():
    labels = {b"a": 0, b"b": 1, b"ab": 2, b"ba": 3, b"aba": 4}
    with pytest.raises(ValueError):
        bpe_automaton.compile_automaton(labels, [(b"a", b"b"), (b"b", b"a"), (b"ab", b"a"), (b"a", b"ba")])


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_whole(seed):
    r = random.Random(seed)
    capacity, lengths = r.choice([10, 100, 4096]), Counter()
    for _ in range(r.randint(0, 300)):
        lengths[r.randint(1, capacity if r.random() < 0.5 else max(1, capacity // 6))] += 1
    runs, bins = packing.plan(dict(lengths), capacity)
    used, seen = defaultdict(list), Counter()
    for length, first, count, at, per_bin, offset in runs:
        assert first == seen[length]
        seen[length] += count
        for i in range(count):
            used[at + i // per_bin].append((offset + i % per_bin * length, length))
    assert seen == lengths and sorted(used) == list(range(bins))
    for pieces in used.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist() and sum(pieces[-1]) <= capacity
    large = [n for n, c in lengths.items() for _ in range(c) if 3 * n > capacity]
    assert bins <= max(len(large), 1.25 * sum(n * c for n, c in lengths.items()) / capacity + 1)


def best_fit(lengths, capacity):
    """Plain best-fit decreasing, a piece at a time."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, n)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        bisect.insort(gaps, gap - n)
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_few_sequences(seed):
    r, capacity = random.Random(seed), 4096
    shape = r.choice([lambda: r.randint(1, capacity), lambda: min(capacity, int(r.lognormvariate(6, 1.2)) + 1), lambda: r.choice([1366, 1365, 2048, 2049, 700, 4096])])
    lengths = [shape() for _ in range(r.randint(1, 1500))]
    _, bins = packing.plan(Counter(lengths), capacity)
    least = max(-(-sum(lengths) // capacity), sum(2 * n > capacity for n in lengths))
    assert least <= bins <= best_fit(lengths, capacity) * 1.02 + 1


def test_very_long_texts(spark, word):
    r = random.Random(7)
    long = " ".join(f"{r.choice('abcdefgh')}{r.randrange(400)}{r.choice(['', ',', ' #', chr(10), ' é'])}" for _ in range(400_000))
    texts = {1: long, 2: long.upper(), 3: "short"}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    rows = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in sstable.tables_of(table, WORD).collect()}
    assert rows == {i: (len(word(t)), zlib.crc32(le(word(t)))) for i, t in texts.items()}
    library = Tokenizer.from_file(BYTE)
    coded = {r.doc_id: r.ids_sha256 for r in bpe_automaton.round_trip(table, BYTE).collect()}
    assert coded == {i: hashlib.sha256(le(library.encode(t, add_special_tokens=False).ids)).hexdigest() for i, t in texts.items()}
    pieces = packing.pack_documents(table, WORD).collect()
    assert {i: sum(p.length for p in pieces if p.doc_id == i) for i in texts} == {i: len(word(t)) for i, t in texts.items()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = {r.doc_id: r.n_tokens for r in token_cache.count_documents(table, fresh_dir(spark, "t")).collect()}
    assert counts == {i: len(model.encode(t)) for i, t in texts.items()}


def test_packing(spark, odd, docs, word):
    for table in (odd, docs):
        placed = stored(packing.pack_documents(table, WORD), "t")
        want = Counter()
        for i, t in table.select("doc_id", "text").collect():
            ids = word(t)
            for k, at in enumerate(range(0, len(ids), 4096)):
                want[i, k, at, len(ids[at : at + 4096]), zlib.crc32(le(ids[at : at + 4096]))] += 1
        rows = placed.collect()
        assert Counter(tuple(r)[:5] for r in rows) == want
        by = defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
        for pieces in by.values():
            pieces.sort()
            assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist() and sum(pieces[-1]) <= 4096
    whole = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, WORD).collect()}
    ids = {i: word(t) for i, t in docs.select("doc_id", "text").collect()}
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == ids[r.doc_id][r.start : r.start + r.length] for r in rows)


def test_sequences_are_whole_with_null_and_repeated_ids(odd, word):
    more = stored(odd.withColumn("doc_id", F.expr("case when doc_id % 3 > 0 then 5 else doc_id end")), "t")
    placed = stored(packing.pack_documents(more, WORD), "t")
    whole = {r.sequence_id: r.ids for r in packing.sequences(more, placed, WORD).collect()}
    rows = placed.collect()
    assert all(zlib.crc32(le(whole[r.sequence_id][r.offset : r.offset + r.length])) == r.ids_crc32 for r in rows)
    assert sum(map(len, whole.values())) == sum(r.length for r in rows) == sum(len(word(t)) for (t,) in more.select("text").collect())


def test_empty(spark, empty):
    assert token_cache.count_documents(empty, fresh_dir(spark, "t")).collect() == []
    assert sstable.tables_of(empty, WORD).collect() == []
    assert bpe_automaton.round_trip(empty, BYTE).collect() == []
    assert packing.pack_documents(empty, WORD).collect() == []
