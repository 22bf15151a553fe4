"""Columns for text as the rules see it.

A rule's input is often an expression of its own. ``let`` and ``chain`` bind it once, so that a rule
can name its input several times (a cheap test first, the pattern only where it can match) without
computing it several times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import S, SPACES

LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
Step = Callable[[Column], Column]


def let(value: Column, body: Step) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def chain(value: Column, *steps: Step) -> Column:
    """One step after the other, each over the whole result of the one before."""
    for step in steps:
        value = let(value, step)
    return value


def has(text: Column, *parts: str) -> Column:
    """Whether all of these plain strings are in the text."""
    found = F.contains(text, F.lit(parts[0]))
    for part in parts[1:]:
        found = found & F.contains(text, F.lit(part))
    return found


def ends_in(text: Column, characters: str) -> Column:
    """Whether the last character is one of these; true for the empty text."""
    return F.contains(F.lit(characters), F.substring(text, -1, 1))


def replaced(pattern: str, put: str, possible: Step) -> Step:
    """A step that replaces all matches, in texts where one is ``possible``."""
    return lambda t: F.when(possible(t), F.regexp_replace(t, pattern, put)).otherwise(t)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def stripping(step: Step) -> Step:
    return lambda t: strip(step(t))


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, rf" {S}+|[{SPACES[1:]}]{S}*", " ")


def without_space(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def lines(text: Column) -> Column:
    """The lines of a text; no empty line after a last line end."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_END, -1)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def drop_suffix(suffix: str) -> Step:
    return lambda t: F.when(t.endswith(suffix), F.substring(t, F.lit(1), F.length(t) - len(suffix))).otherwise(t)


def drop_prefix(prefix: str) -> Step:
    return lambda t: F.when(t.startswith(prefix), F.substring(t, F.lit(len(prefix) + 1), F.length(t))).otherwise(t)


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def nfkc(text: Column) -> Column:
    """Compatibility composition, by the library that Spark's collations use; ASCII texts are left alone."""

    def compose(t: Column) -> Column:
        composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), t, F.lit(True))
        return F.when(t.rlike(r"[^\x00-\x7f]"), composed).otherwise(t)

    return let(text, compose)
