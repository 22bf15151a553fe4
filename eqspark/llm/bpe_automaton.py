"""Byte-pair encoding by a deterministic tokenization automaton.

The automaton starts with one state and an arc per byte. The merges are applied to it one after the
other, each by a gadget: merge ``a b -> c`` makes the state behind ``c`` as that behind ``b`` is now, takes
the arc ``b`` away from the state behind ``a``, and puts an arc ``c`` beside every arc ``a``. The result
accepts, over token labels, exactly the sequences that byte-pair encoding produces, and the state behind
an arc depends on its label only. Encoding a word is the one path of the automaton that spells it;
decoding emits the arcs' labels.

A table of all state-label pairs would have a few thousand million entries, so a state is kept as the
state that it was made from, how many of that one's cuts it has, and its own cuts. With the labels
in an order in which each one is followed by those that were made from it, newest first, a cut takes
away one interval of labels. The finished table has each state's cut intervals in order: 0.8 million
for 50,000 merges. It is compiled once, on the driver, into one read-only file, which the workers map
into memory; a transition is a binary search in a state's row.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import struct
from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Bounded, fresh_dir, local_path, map_rows, shared_reader, shared_writer
from .word_bpe import byte_alphabet

#: Characters whose class is the same in every Unicode version and regular-expression library.
ODD = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ¡¿«»]")
#: The tokenizer's split over texts without others.
SPLIT = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
MAGIC, HEADER = b"EQAUTOM1", struct.Struct("<8sQQ")  # numbers of labels and of intervals
NOWHERE = 0xFFFFFFFF


def compile_automaton(labels: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> bytes:
    """The automaton's table, by one gadget a merge, in order. ``labels`` gives each label's number.

    A merge whose pair earlier gadgets have cut everywhere can't happen; its label gets no arcs. Layout:
    header; begin of each label's row, and the last one's end; each label's place in the order of labels
    (NOWHERE for one without arcs); begins and ends of all intervals. The numbers have 32 bits.
    """
    n = max(labels.values(), default=-1) + 1
    made = [-1] * n  #: the time of its merge
    bytes_, parts = {x for text, x in labels.items() if len(text) == 1}, {}
    cut_at: dict[tuple[int, int], int] = {}
    origin, known = [-1] * n, [0] * n  #: the state that it was made from, and how many of its cuts it has
    cuts: list[list[tuple[int, int]]] = [[] for _ in range(n)]  #: its own: label and time
    longer: list[list[int]] = [[] for _ in range(n)]  #: labels made from it by adding one behind, by time

    def follows(x: int, y: int) -> bool:
        """Whether the state behind ``x`` has an arc ``y`` by now: no gadget cut the pair, nor any of the
        pairs of which newer gadgets made it."""
        before = len(merges)
        if not all(z in bytes_ or z in parts for z in (x, y)):
            return False
        while cut_at.get((x, y), before) >= before:
            if made[x] < 0 and made[y] < 0:
                return True
            if made[x] >= made[y]:  # made from the state behind its right part, before the gadget's own cut
                before, x, y = made[x], parts[x][1], parts[y][0] if made[x] == made[y] else y
            else:  # put beside the arcs of its left part, after the cut
                before, y = made[y] + 1, parts[y][0]
        return False

    seen = set()
    for time, (a, b) in enumerate(merges):
        left, right, label = labels[a], labels[b], labels[a + b]
        if label in seen or label in bytes_:
            raise ValueError("two merges make the same token")
        seen.add(label)
        if not follows(left, right):
            continue
        cut_at[left, right], parts[label] = time, (left, right)
        made[label], origin[label], known[label] = time, right, len(cuts[right])
        cuts[left].append((right, time))
        longer[left].append(label)

    place, end, at = [NOWHERE] * n, [0] * n, 0
    ahead = [(label, False) for label in bytes_]
    while ahead:
        label, done = ahead.pop()
        if done:
            end[label] = at
        else:
            place[label], at = at, at + 1
            ahead.append((label, True))
            ahead += [(x, False) for x in longer[label]]  # the newest is taken first

    def interval(label: int, time: int) -> tuple[int, int]:
        """A cut takes away the arc and those that gadgets put beside it from then on."""
        first = bisect_left(longer[label], time, key=made.__getitem__)
        return place[label], end[longer[label][first]] if first < len(longer[label]) else place[label] + 1

    own = [[interval(*c) for c in row] for row in cuts]
    inherited: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for label in parts:  # in order of time
        inherited[label] = inherited[origin[label]] + own[origin[label]][: known[label]]
    rows, begins, ends = [0], [], []
    for x in range(n):
        for begin, stop in sorted(inherited[x] + own[x]):
            if len(begins) > rows[-1] and begin <= ends[-1]:
                ends[-1] = max(ends[-1], stop)
            else:
                begins.append(begin)
                ends.append(stop)
        rows.append(len(begins))
    return HEADER.pack(MAGIC, n, len(begins)) + np.array([*rows, *place, *begins, *ends], "<u4").tobytes()


class MergeAutomaton:
    """A compiled table with the labels' spelling."""

    def __init__(self, labels: dict[bytes, int], table):
        magic, n, intervals = HEADER.unpack_from(table)
        if magic != MAGIC:
            raise ValueError("not an automaton's table")
        numbers = memoryview(table)[HEADER.size :].cast("I")
        self.rows, self.place = numbers[: n + 1].tolist(), numbers[n + 1 : 2 * n + 1].tolist()
        self.begins, self.ends = numbers[2 * n + 1 : 2 * n + 1 + intervals], numbers[2 * n + 1 + intervals :]
        self.labels = {number: label for label, number in labels.items()}
        self.spell: dict = {}  # byte trie of the labels: byte -> node, -1 -> label
        for label, number in labels.items():
            if self.place[number] != NOWHERE:
                node = self.spell
                for byte in label:
                    node = node.setdefault(byte, {})
                node[-1] = number

    def encode(self, word: bytes) -> list[int]:
        """The labels on the path that spells ``word``: by prefixes, each of which has one path."""
        n = len(word)
        last, back = [-1] * (n + 1), [0] * (n + 1)
        begins, ends, place, spell = self.begins, self.ends, self.place, self.spell
        low = high = 0  # the row of the state where the path of the prefix ends; the first has no cuts
        for i in range(n):
            if i:
                low, high = self.rows[last[i]], self.rows[last[i] + 1]
            node = spell
            for j in range(i, n):
                node = node.get(word[j])
                if node is None:
                    break
                label = node.get(-1)
                if label is not None and last[j + 1] < 0:
                    to = place[label]
                    k = bisect_right(begins, to, low, high)
                    if k == low or ends[k - 1] <= to:
                        last[j + 1], back[j + 1] = label, i
        out = []
        while n:
            out.append(last[n])
            n = back[n]
        return out[::-1]

    def decode(self, numbers) -> bytes:
        return b"".join(map(self.labels.__getitem__, numbers))


def describe(path: str) -> tuple[dict[str, int], dict[bytes, int], list[tuple[bytes, bytes]]]:
    """Special strings, labels and merges of a byte-level tokenizer file. Tokens that are neither a byte
    nor made by a merge can't come out of an encoding, and are no labels."""
    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    byte_of = {c: b for b, c in byte_alphabet().items()}
    raw = lambda s: bytes(map(byte_of.__getitem__, s))
    merges = [tuple(map(raw, m if isinstance(m, list) else m.split(" "))) for m in described["model"]["merges"]]
    special = {t["content"]: t["id"] for t in described["added_tokens"]}
    merged = {a + b for a, b in merges}
    vocab = {raw(k): v for k, v in described["model"]["vocab"].items() if k not in special}
    return special, {k: v for k, v in vocab.items() if len(k) == 1 or k in merged}, merges


class AutomatonTokenizer:
    """A byte-level tokenizer file, with the automaton in place of the library's merging.

    Texts are cut at special strings, which are tokens of their own, and split into words by the
    tokenizer's pattern; texts with characters outside the plain Latin ones are split by the library.
    """

    def __init__(self, path: str, table=None):
        from tokenizers import Tokenizer

        self.special, labels, merges = describe(path)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.byte_of = {c: b for b, c in byte_alphabet().items()}
        self.automaton = MergeAutomaton(labels, compile_automaton(labels, merges) if table is None else table)
        self.automaton.labels |= {v: k.encode() for k, v in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = Bounded(self._word, 350_000)

    def _word(self, word: str) -> bytes:
        labels = self.automaton.encode(word.encode())
        return struct.pack(f"<{len(labels)}I", *labels)

    def _plain(self, text: str) -> bytes:
        if ODD.search(text):
            words = [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8", "surrogateescape") for w, _ in self.splitter.pre_tokenize_str(text)]
        else:
            words = SPLIT.findall(text)
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        text = text or ""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        return b"".join(struct.pack("<I", self.special[s]) if s in self.special else self._plain(s) for s in self.cut.split(text))

    def decode(self, ids: bytes) -> str:
        return self.automaton.decode(memoryview(ids).cast("I")).decode("utf-8", "replace")


def stored_automaton(spark: SparkSession, path: str) -> str:
    """Compile the automaton of a tokenizer file into a file of the shared folder; return its place."""
    _, labels, merges = describe(path)
    place = f"{fresh_dir(spark, 'automaton')}/table"
    with shared_writer(place) as out:
        out.write(compile_automaton(labels, merges))
    return place


_tokenizers: dict[str, AutomatonTokenizer] = {}


def automaton_tokenizer(path: str, table: str) -> AutomatonTokenizer:
    """This Python worker's tokenizer, kept from task to task. The table is mapped into memory; where the
    shared folder isn't mounted, it is read (some megabytes)."""
    if table not in _tokenizers:
        with shared_reader(table) as f:
            data = f.read() if local_path(table) is None else mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        _tokenizers.clear()  # of another query
        _tokenizers[table] = AutomatonTokenizer(path, data)
    return _tokenizers[table]


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids, as packed integers. A null text is the empty text, without ids."""

    table = stored_automaton(docs.sparkSession, path)

    def make():
        encode = automaton_tokenizer(path, table).encode
        return lambda c: {"doc_id": c[0], "ids": [encode(t) for t in c[1]]}

    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), make, "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Digests of every document's ids and of the text decoded from them.

    A null text is the empty text. Repeated rows and ties are encoded each; null ids stay; an empty
    table gives no rows; other columns are not read.
    """

    table = stored_automaton(docs.sparkSession, path)

    def make():
        tokenizer = automaton_tokenizer(path, table)

        def work(columns):
            ids = [tokenizer.encode(t) for t in columns[1]]
            digest = lambda b: hashlib.sha256(b).hexdigest()
            return {"doc_id": columns[0], "n_tokens": [len(b) // 4 for b in ids], "ids_sha256": list(map(digest, ids)), "decoded_sha256": [digest(tokenizer.decode(b).encode()) for b in ids]}

        return work

    return map_rows(docs.select(F.col(id_column).cast("long"), F.col(text_column)), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
