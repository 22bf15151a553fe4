"""Lines and display-math blocks of documents, each document in one row: no shuffle is needed.

Arrays become rows by the outer forms of explode, with a filter behind: the inner ones would have the optimizer
put a filter on the array's size below, which computes the array once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import has, let, lines, strip, without_space


def with_lines(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the lines of ``markdown``, as they are and stripped."""
    out = docs.select("doc_id", lines(F.col("markdown")).alias("lines"))
    return out.withColumn("stripped", F.transform("lines", strip))


def line_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode_outer(lines(F.col("markdown"))).alias("line_no", "text")).where("text is not null")


def opens(t: Column) -> Column:
    return t.startswith("$$") | t.startswith("\\[") | t.startswith("```math")


def ends(t: Column) -> Column:
    return t.endswith("$$") | t.endswith("\\]")


def block_bounds(stripped: Column) -> Column:
    """First and last line of each block, by one pass over the lines. A block that no line closes
    ends behind the last line."""
    spans = "array<struct<start:int,end:int>>"
    zero = F.struct(F.lit(-1).alias("open"), F.lit(0).alias("at"), F.array().cast(spans).alias("found"))

    def step(acc: Column, t: Column) -> Column:
        inside = acc["open"] >= 0
        one = (~inside) & opens(t) & ends(t)
        closes = inside & (ends(t) | (t == "```"))
        start = F.when(inside, acc["open"]).otherwise(acc["at"])
        span = F.array(F.struct(start.alias("start"), acc["at"].alias("end"))).cast(spans)
        state = F.when(one | closes, -1).when(inside | opens(t), start).otherwise(-1)
        return F.struct(state.alias("open"), (acc["at"] + 1).alias("at"), F.when(one | closes, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def finish(acc: Column) -> Column:
        last = F.array(F.struct(acc["open"].alias("start"), acc["at"].alias("end"))).cast(spans)
        return F.when(acc["open"] >= 0, F.concat(acc["found"], last)).otherwise(acc["found"])

    return F.aggregate(stripped, zero, step, finish)


def context(stripped: Column, start: Column, end: Column, radius: int = P.CONTEXT_RADIUS) -> Column:
    left = F.greatest(start - radius, F.lit(0))
    near = F.filter(F.slice(stripped, left + 1, end + radius + 1 - left), lambda t: t != "")
    return F.substring(F.array_join(near, " "), 1, P.CONTEXT_LIMIT)


def line_reference(t: Column) -> Column:
    """The label that a line of prose refers to, if it refers to exactly one."""
    only = lambda pattern, other: let(F.regexp_extract_all(t, F.lit(pattern), 1), lambda f: F.when(F.size(f) == 1, f[0]).otherwise(other))
    decimal = F.when(has(t, "(", "."), only(P.DECIMAL_REFERENCE, F.lit(None).cast("string")))
    return F.when((t != "") & ~t.startswith("$$"), without_space(F.when(t.rlike("[Ee]q"), only(P.PROSE_REFERENCE, decimal)).otherwise(decimal)))


def nearest_reference(stripped: Column, start: Column, end: Column, radius: int = P.REFERENCE_RADIUS) -> Column:
    """The nearest such label: lines behind the block first, then those before it."""
    behind = F.slice(stripped, F.least(end + 2, F.size(stripped) + 1), F.lit(radius))
    first = F.greatest(start - radius, F.lit(0))
    before = F.reverse(F.slice(stripped, first + 1, start - first))
    return F.get(F.filter(F.transform(F.concat(behind, before), line_reference), lambda r: r.isNotNull()), F.lit(0))


def with_bounds(docs: DataFrame) -> DataFrame:
    return with_lines(docs).withColumn("bounds", block_bounds(F.col("stripped")))


def block_raw(lines_: Column, b: Column) -> Column:
    return F.array_join(F.slice(lines_, b["start"] + 1, b["end"] - b["start"] + 1), "\n")


def blocks(docs: DataFrame) -> DataFrame:
    """A row per block: its bounds, text, context and nearest reference."""

    def described(b: Column) -> Column:
        stripped = F.col("stripped")
        return F.struct(
            b["start"].alias("start"), b["end"].alias("end"), block_raw(F.col("lines"), b).alias("raw"),
            context(stripped, b["start"], b["end"]).alias("context"), nearest_reference(stripped, b["start"], b["end"]).alias("reference"),
        )

    return with_bounds(docs).select("doc_id", F.transform("bounds", described).alias("b")).select("doc_id", F.posexplode_outer("b").alias("emit_ord", "b")).where("b is not null").select("doc_id", "emit_ord", "b.*")
