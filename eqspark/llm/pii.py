"""Personal data by pattern, checksum and context, in DataFrame functions only.

Each kind has a pattern that proposes spans, a check of the matched text (Luhn, mod-97, ranges,
digit counts) and context words that raise its score when they stand near, or lower it. Kinds of the
base set count as soon as their check holds; the further kinds also need a score.

Offsets come from the pieces between the matches: a match starts after all pieces and matches
before it, so one linear pass gives every span in code points. The patterns are possessive, and
may only begin where a run of their characters begins (or where the match before it ended), so
that long runs of such characters neither take quadratic time nor fill the stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SPAN = "array<struct<start:int,end:int,value:string,score:double>>"
BLOCK = 512


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a short string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, leave 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _counted(value: Column, low: int, high: int, check=None) -> Column:
    digits = only_digits(value)
    inside = F.length(digits).between(low, high)
    return inside if check is None else F.when(inside, check(digits)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  #: without this plain string there is no match ("" for any text)
    check: object
    base: float
    context: str  #: words that add BONUS when near
    needed: float = 0.0  #: least score
    against: str = "serial|order|part no|model|isbn|sku|invoice|version"  #: words that take BONUS away


BONUS, CONTEXT_CHARS = 30, 40  #: hundredths; code points to either side
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_WORD})){_WORD}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda v: F.lit(True), 0.7, "mail|contact|write|address"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", lambda v: v.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"), 0.5, "ip|host|server|addr"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", lambda v: _counted(v, 16, 19, luhn), 0.7, "card|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda v: _counted(v, 8, 15), 0.5, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", mod97, 0.7, "iban|bank|account|konto|cuenta|compte", 0.6),
    Kind("short_card", r"(?<![0-9])[0-9]{13,15}(?![0-9])", "", lambda v: _counted(v, 13, 15, luhn), 0.4, "card|visa|amex|credit", 0.6),
)
BASE = ("email", "ip", "card", "phone")


def matches(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    return F.when(F.contains(text, F.lit(kind.hint)), found).otherwise(F.array().cast("array<string>")) if kind.hint else found


def pieces(text: Column, found: Column, kind: Kind) -> Column:
    return F.when(F.size(found) > 0, F.split(text, kind.pattern, -1)).otherwise(F.array().cast("array<string>"))


def accepted(kind: Kind, value: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Whether a match counts, and its score."""
    near = F.lower(F.concat(F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS), F.lit(" "), F.substring(after, 1, CONTEXT_CHARS)))
    hundredths = F.lit(round(kind.base * 100)) + F.when(near.rlike(kind.context), BONUS).otherwise(0) - F.when(near.rlike(kind.against), BONUS).otherwise(0)
    return F.when(kind.check(value), hundredths >= round(kind.needed * 100)).otherwise(False), hundredths / 100


def located(found: Column, parts: Column, kind: Kind) -> Column:
    """The accepted spans of a kind. A block of matches at a time, as arrays are copied as they grow."""
    span = F.transform(found, lambda m, i: F.struct(m.alias("value"), F.get(parts, i).alias("before"), F.get(parts, i + 1).alias("after")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["value"])
        good, score = accepted(kind, x["value"], x["before"], x["after"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), score.alias("score"))).cast(SPAN)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    def block(span: Column, acc: Column, b: Column) -> Column:
        inner = F.aggregate(F.slice(span, b * BLOCK + 1, F.lit(BLOCK)), F.struct(acc["at"].alias("at"), F.array().cast(SPAN).alias("spans")), step)
        return F.struct(inner["at"].alias("at"), F.concat(acc["lists"], F.array(inner["spans"])).alias("lists"))

    lists = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("lists"))

    def all_blocks(span: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(span) - 1) / BLOCK).cast("int")), lists, lambda acc, b: block(span, acc, b))["lists"]

    small = F.aggregate(span, zero, step)["spans"]
    large = F.flatten(F.transform(F.array(span), all_blocks)[0])  # bound, as each block takes a slice of it
    return F.when(F.size(found) == 0, F.array().cast(SPAN)).when(F.size(found) <= BLOCK, small).otherwise(large)


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and, for each kind, an array of its accepted spans.

    Spans of a kind never overlap; those of different kinds may. A null text is the empty text, which
    has none. Rows stay as they are: repeated ones, ties and null ids too; an empty table gives no rows.
    """
    out = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    out = out.select("doc_id", "text", *[matches(F.col("text"), k).alias(f"m_{k.name}") for k in KINDS])
    out = out.select("doc_id", *[f"m_{k.name}" for k in KINDS], *[pieces(F.col("text"), F.col(f"m_{k.name}"), k).alias(f"p_{k.name}") for k in KINDS])
    return out.select("doc_id", *[located(F.col(f"m_{k.name}"), F.col(f"p_{k.name}"), k).alias(k.name) for k in KINDS])


def listed(kinds: tuple[str, ...]) -> Column:
    """All spans as ``kind:start:end``, by kind and then by start, joined by commas."""

    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(named, kinds)), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, all spans and, in their order, their scores; and the
    highest score (0 without spans). A row a row, as in ``find_spans``."""
    spans = find_spans(docs)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in (*BASE, "iban", "short_card")]
    names = tuple(k.name for k in KINDS)
    scores = F.flatten(F.array(*[F.transform(k, lambda s: s["score"]) for k in names]))
    return spans.select(
        "doc_id", *counts, F.sha2(listed(BASE), 256).alias("base_sha256"), listed(names).alias("spans"), F.size(scores).cast("long").alias("n_spans"),
        F.array_join(F.transform(scores, lambda x: F.format_string("%.2f", x)), ",").alias("scores"), F.coalesce(F.array_max(scores), F.lit(0.0)).alias("top_score"),
    )


def _replacer(kind: Kind, parts: Column):
    """From a match and its number to the piece before it and what stands for the match."""

    def one(m: Column, i: Column) -> Column:
        good, _ = accepted(kind, m, F.get(parts, i), F.get(parts, i + 1))
        return F.concat(F.get(parts, i), F.when(good, F.lit(f"[{kind.name.upper()}]")).otherwise(m))

    return one


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with each accepted span replaced by its kind in brackets, one kind after the other,
    each over the text that the kinds before it left.

    Null texts stay null and empty ones empty; repeated rows and ties change alike; other columns, whatever
    their names, pass through; an empty table stays empty.
    """
    names = docs.columns
    hidden = {n: f"pii_{n}_" for n in ("text", "found", "parts")}
    while set(hidden.values()) & {c.lower() for c in names}:
        hidden = {k: f"{v}_" for k, v in hidden.items()}
    text, found, parts = hidden.values()
    out = docs.withColumn(text, F.col(f"`{text_column}`"))
    keep = [F.col(f"`{c}`") for c in names]
    for kind in KINDS:
        out = out.select(*keep, F.col(text), matches(F.col(text), kind).alias(found))
        out = out.select(*keep, F.col(text), F.col(found), pieces(F.col(text), F.col(found), kind).alias(parts))
        joined = F.concat(F.array_join(F.transform(F.col(found), _replacer(kind, F.col(parts))), ""), F.element_at(F.col(parts), -1))
        out = out.select(*keep, F.when(F.size(found) > 0, joined).otherwise(F.col(text)).alias(text))
    return out.select(*[F.col(text).alias(c) if c == text_column else F.col(f"`{c}`") for c in names])
