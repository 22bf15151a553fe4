"""Exact word-level encoding for a BPE whose pre-tokenizer drops white space.

With such a tokenizer (``word_bpe_49k.json``: NFC, white space to a blank, lower case, split into
words, digits and marks) no token, and no special string, crosses ASCII white space. Texts of plain
Latin letters, digits and ASCII marks are cut into words here, by the tokenizer's own split, and only
the library's merging runs on a new word: a memo over words replaces most of the work. Any other text
is taken by its white-space-delimited chunks, of which those with other characters go through the
whole library, so that the result equals the library's for all texts.
"""

from __future__ import annotations

import re
import struct

import numpy as np

from .common import Bounded

SPACES = "\t\n\r\x0b\x0c "
#: Texts of these characters only are cut here, unless ``<|`` (special strings) is in them: ASCII and
#: letters whose case mapping, class and NFC form are the same in every Unicode version.
PLAIN = re.compile(rf"[{SPACES}!-~À-ÖØ-öø-ÿ¡¿]*")
#: The tokenizer's own split over such texts, after lower-casing.
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ{SPACES}]+")


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """``encode(text)`` gives the ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, memo: int = 600_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merge = self.library.model.tokenize  # the merges alone, of one word of byte stand-ins
        self.alphabet = byte_alphabet()
        self.words = Bounded(self._word, memo)
        self.chunks = Bounded(self._chunk, memo // 6)

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self._plain(text):
            return self._cut(text)
        return b"".join(map(self.chunks.__getitem__, text.encode().split()))

    @staticmethod
    def _plain(text: str) -> bool:
        return "<|" not in text and PLAIN.fullmatch(text) is not None

    def _cut(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, WORDS.findall(text.lower())))

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if self._plain(text):
            return self._cut(text)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join(map(self.alphabet.__getitem__, word.encode()))
        ids = [t.id for t in self.merge(word)]
        return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept with its memo from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
