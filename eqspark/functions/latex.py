"""Labels and normal forms of equations, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .patterns import S, SPACES
from .text import chain, drop_prefix, drop_suffix, ends_in, has, let, matched, nfkc, replaced, squeeze, strip, stripping, without_space

FENCE = "```"


def normalize_latex(text: Column) -> Column:
    """Without a fence, one pair of delimiters and tags; white space to single blanks."""
    opening = replaced(r"(?i)\A```(?:math|latex)?", "", lambda t: t.startswith(FENCE))
    pair = [drop_prefix("$$"), drop_suffix("$$"), strip, drop_prefix("\\["), drop_suffix("\\]"), strip]
    return chain(text, strip, opening, strip, drop_suffix(FENCE), strip, *pair, replaced(P.TAG, "", lambda t: has(t, "\\tag{")), strip, squeeze)


def _last_label(text: Column, pattern: str, late: bool) -> Column:
    """The last match that no ``^`` stands shortly before (and, if ``late``, that begins past 65 % of the text)."""
    whole, inner, parts = F.regexp_extract_all(text, F.lit(pattern), 0), F.regexp_extract_all(text, F.lit(pattern), 1), F.split(text, pattern, -1)
    seen = F.transform(F.arrays_zip(whole.alias("whole"), inner.alias("label"), parts.alias("part")), lambda m: F.struct(F.length(m["part"]).alias("gap"), F.length(m["whole"]).alias("size"), m["label"].alias("label")))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + m["gap"]
        before = F.substring(text, F.greatest(start - 8, F.lit(0)) + 1, F.least(start, F.lit(8)))
        good = m["size"].isNotNull() & ~has(before, "^")
        if late:
            good = good & (start > F.floor(F.length(text) * F.lit(0.65)))
        return F.struct((start + m["size"]).alias("at"), F.when(good, m["label"]).otherwise(acc["label"]).alias("label"))

    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("label"))
    return F.when(has(text, "(", ")") & text.rlike(pattern), F.aggregate(seen, zero, step)["label"])


def number_of(text: Column, embedded: bool = False) -> Column:
    """An equation's label: a tag, else a trailing one, else (``embedded``) one inside; null if none."""

    def found(t: Column) -> Column:
        ways = [F.when(has(t, "\\tag{"), matched(t, P.TAG)), F.when(t.endswith(")"), matched(t, P.TRAILING_LABEL))]
        if embedded:
            ways += [_last_label(t, P.EMBEDDED_LABEL, False), _last_label(t, P.SPACED_LABEL, True)]
        return without_space(F.coalesce(*ways))

    return chain(text, strip, drop_suffix("$$"), drop_suffix("\\]"), drop_suffix(FENCE), strip, found)


def _without_label(number: Column):
    """Steps that drop a label inside a text and what follows it. Their patterns are made for the label,
    so they are tried only where the text has it."""
    label = rf"(?:\\left{S}*)?\({S}*", F.array_join(F.transform(F.filter(F.split(number, ""), lambda c: c != ""), lambda c: F.concat(F.lit("\\Q"), c, F.lit("\\E"))), f"{S}*"), rf"{S}*(?:\\right{S}*)?\)"
    label = F.concat(F.lit(label[0]), label[1], F.lit(label[2]))
    tail = F.concat(F.lit(rf"(?Ud)(?:\\qquad|\\quad|,{S}*|{S}{{2,}}){S}*"), label, F.lit(".*$"))
    inside = F.concat(F.lit(rf"(?Ud)(?:\\quad|,|\\{S}+)?{S}*"), label, F.lit(rf"{S}*(?:\\quad)?{S}*(?=(?:{S}*\}})?{S}*\\end\{{array\}}|(?:{S}*\\{S}*){{4,}}|{S}*$)"))
    held = lambda t: F.coalesce(F.contains(without_space(t), F.concat(F.lit("("), number)), F.lit(False))
    drop = lambda pattern: lambda t: F.when(held(t), strip(F.regexp_replace(t, pattern, F.lit("")))).otherwise(t)
    slashes = replaced(rf"(?Ud)(?:\\{S}*){{4,}}$", "", lambda t: number.isNotNull() & t.endswith("\\"))
    return drop(tail), drop(inside), slashes, strip


def strip_number(text: Column, number: Column | None = None) -> Column:
    """The text without its label; with ``number``, also without what follows that label."""

    def inner(t: Column) -> Column:
        trailing = replaced(P.TRAILING_LABEL, "", lambda t: t.endswith(")"))
        return chain(t, drop_closing, strip, trailing, strip, *([] if number is None else _without_label(number)))

    def drop_closing(t: Column) -> Column:
        return F.when(t.endswith("$$") | t.endswith("\\]"), F.substring(t, F.lit(1), F.length(t) - 2)).when(t.endswith(FENCE), F.substring(t, F.lit(1), F.length(t) - 3)).otherwise(t)

    closing = lambda t: F.when(t.endswith("$$"), "$$").when(t.endswith("\\]"), "\\]").when(t.endswith(FENCE), FENCE).otherwise("")
    return let(strip(text), lambda t: strip(F.concat(inner(t), closing(t))))


#: What a text must have for each of the rules to match.
_POSSIBLE = (
    lambda t: t.startswith("\\begin{array}"), lambda t: t.startswith("{") & has(t, "&"), lambda t: has(t, "\\mathbf"), lambda t: has(t, "\\mathbf"),
    lambda t: ends_in(t, "d,;:" + SPACES), lambda t: has(t, "\\") & ends_in(t, "\\" + SPACES), lambda t: ends_in(t, ",." + SPACES), lambda t: has(t, "\\frac"),
    lambda t: has(t, "{"), lambda t: has(t, "{"), lambda t: has(t, "_", "{"), lambda t: has(t, "^", "{"), lambda t: has(t, "_") | has(t, "^"), lambda t: has(t, "_") | has(t, "^"),
    lambda t: has(t, "\\", "{"), lambda t: t != "", lambda t: has(t, "\\") | ends_in(t, ";"),
)


def output_form(text: Column) -> Column:
    """The form that is reported."""
    steps = [strip, nfkc, strip_number]
    for (pattern, put, trimmed), possible in zip(P.OUTPUT_RULES, _POSSIBLE, strict=True):
        rule = squeeze if pattern == f"{S}+" else replaced(f"(?Ud){pattern}", put, possible)
        steps.append(stripping(rule) if trimmed else rule)
    return chain(text, *steps)


def glyphs_to_latex(text: Column) -> Column:
    """Common glyphs of a page's text layer as commands."""

    def commands(t: Column) -> Column:
        out = t
        for glyph, command in P.GLYPHS:
            out = F.replace(out, F.lit(glyph), F.lit(command))
        return F.when(t.rlike(r"[^\x00-\x7f]"), out).otherwise(t)

    return chain(text, nfkc, commands, squeeze, strip)
