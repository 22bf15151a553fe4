"""Extractors: from documents, or page lines, to candidate equations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import patterns as P
from ..functions.latex import glyphs_to_latex, normalize_latex, number_of, output_form, strip_number
from ..functions.text import has, strip
from .blocks import block_raw, context, ends, nearest_reference, with_bounds

COLUMNS = ("doc_id", "number", "latex", "raw_latex", "source", "confidence", "warnings", "line_start", "line_end", "context", "source_location", "src_rank", "emit_ord")


def _described(source: str, rank: int, location: Column, c) -> dict[str, Column]:
    """What follows from a candidate's own columns, ``c`` by name."""
    name = F.lit(source)
    return {"source": name, "confidence": L.confidence(name), "warnings": L.quality_warnings(name, c("latex"), c("raw_latex")), "source_location": location, "src_rank": F.lit(rank)}


def _structs(found: Column, source: str, rank: int, location) -> Column:
    """An array of candidates in the common shape."""

    def one(x: Column) -> Column:
        own = _described(source, rank, location(x), lambda n: x[n])
        return F.struct(*[(own[c] if c in own else x[c]).alias(c) for c in COLUMNS[1:]])

    return F.transform(found, one)


def _fields(x: Column, *kept: str, **new: Column) -> Column:
    return F.struct(*[x[c].alias(c) for c in kept], *[v.alias(k) for k, v in new.items()])


def _lines(x: Column) -> Column:
    return F.concat(F.lit("Docling Markdown lines "), x["line_start"].cast("string"), F.lit("-"), x["line_end"].cast("string"))


# Arrays of structs grow by steps, each in a projection of its own: every field is computed once, and
# what is dropped between steps is not computed further.
_PLACE = ("line_start", "line_end", "context", "emit_ord")


def _with_blocks(docs: DataFrame) -> DataFrame:
    """``blocks``: each one's text and own label; for those without one, the label of a neighbouring line
    (where the block has several lines) and the nearest reference."""
    lines_, stripped = F.col("lines"), F.col("stripped")

    def near(b: Column) -> Column:
        s, e = b["line_start"] - 1, b["line_end"] - 1
        multi = (e > s) | ~ends(F.get(stripped, s))
        label = F.coalesce(number_of(F.get(lines_, e + 1)), F.when(s > 0, number_of(F.get(lines_, s - 1))))
        reference = F.when(b["own"].isNull(), nearest_reference(stripped, s, e))
        return _fields(b, "raw", "own", "line_start", "line_end", "emit_ord", context=context(stripped, s, e), number=F.coalesce(b["own"], F.when(multi, label)), reference=reference)

    rows = with_bounds(docs)
    rows = rows.withColumn("blocks", F.transform("bounds", lambda b, i: F.struct((b["start"] + 1).alias("line_start"), (b["end"] + 1).alias("line_end"), i.alias("emit_ord"), block_raw(lines_, b).alias("raw"))))
    rows = rows.withColumn("blocks", F.transform("blocks", lambda b: _fields(b, "raw", "line_start", "line_end", "emit_ord", own=number_of(b["raw"], embedded=True))))
    return rows.withColumn("blocks", F.transform("blocks", near)).select("doc_id", "stripped", "blocks")


def _formed(rows: DataFrame, name: str, raw_latex) -> DataFrame:
    """The array ``name`` with ``raw_latex`` and ``latex``."""
    rows = rows.withColumn(name, F.transform(name, lambda x: _fields(x, "number", *_PLACE, raw_latex=raw_latex(x))))
    return rows.withColumn(name, F.transform(name, lambda x: _fields(x, "number", "raw_latex", *_PLACE, latex=output_form(x["raw_latex"]))))


def _math_blocks(rows: DataFrame) -> DataFrame:
    """Blocks with a label of their own or, over several lines, on the line behind or before."""
    rows = rows.withColumn("math", F.filter("blocks", lambda b: b["number"].isNotNull()))
    rows = _formed(rows, "math", lambda b: strip_number(normalize_latex(b["raw"]), b["number"]))
    return rows.withColumn("math", _structs(F.filter("math", lambda x: x["latex"] != ""), P.MATH_BLOCK, 0, _lines))


def _numbered_lines(rows: DataFrame) -> DataFrame:
    """Lines with a trailing label or a tag; a line without signs of mathematics takes the line before it."""
    stripped = F.col("stripped")
    able = lambda t: (F.length(t) <= P.LINE_LIMIT) & (has(t, ")") | has(t, "\\tag{"))

    def own(x: Column) -> Column:
        return _fields(x, "index", "number", own=strip_number(x["text"], x["number"]), previous=F.when(x["index"] > 0, F.get(stripped, x["index"] - 1)))

    def paired(x: Column) -> Column:
        back = ~x["own"].rlike(P.MATH_SIGNAL) & F.coalesce(x["previous"].rlike(P.MATH_SIGNAL), F.lit(False))
        return _fields(x, "index", "number", "own", "previous", back=back)

    def placed(x: Column) -> Column:
        first = x["index"] - x["back"].cast("int")
        equation = F.when(x["back"], x["previous"]).otherwise(x["own"])
        return _fields(x, "number", equation=equation, line_start=first + 1, line_end=x["index"] + 1, context=context(stripped, first, x["index"]), emit_ord=x["index"])

    rows = rows.withColumn("numbered", F.transform("stripped", lambda t, i: F.struct(i.alias("index"), t.alias("text"), F.when(able(t), number_of(t)).alias("number"))))
    rows = rows.withColumn("numbered", F.transform(F.filter("numbered", lambda x: x["number"].isNotNull()), own))
    rows = rows.withColumn("numbered", F.transform(F.transform("numbered", paired), placed))
    rows = rows.withColumn("numbered", F.filter("numbered", lambda x: x["equation"].rlike(P.MATH_SIGNAL)))
    return _formed(rows, "numbered", lambda x: normalize_latex(x["equation"])).withColumn("numbered", _structs(F.col("numbered"), P.NUMBERED_LINE, 1, _lines))


def _neighbor_references(rows: DataFrame) -> DataFrame:
    """Blocks without a label that a nearby line of prose refers to."""
    found = F.filter("blocks", lambda b: b["own"].isNull() & b["reference"].isNotNull())
    rows = rows.withColumn("near", F.transform(found, lambda b: _fields(b, *_PLACE, number=b["reference"], raw=normalize_latex(b["raw"]))))
    rows = _formed(rows.withColumn("near", F.filter("near", lambda b: b["raw"].rlike(P.MATH_SIGNAL))), "near", lambda b: b["raw"])
    location = lambda x: F.concat(_lines(x), F.lit("; label inferred from nearby Eq. "), x["number"], F.lit(" reference"))
    return rows.withColumn("near", _structs(F.col("near"), P.NEIGHBOR, 2, location))


def _exploded(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("doc_id", F.explode_outer(name).alias("c")).where("c is not null").select("doc_id", "c.*")


def math_blocks(docs: DataFrame) -> DataFrame:
    return _exploded(_math_blocks(_with_blocks(docs)), "math")


def numbered_lines(docs: DataFrame) -> DataFrame:
    return _exploded(_numbered_lines(with_bounds(docs).select("doc_id", "stripped")), "numbered")


def neighbor_references(docs: DataFrame) -> DataFrame:
    return _exploded(_neighbor_references(_with_blocks(docs)), "near")


def markdown_candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, candidates``: a row per document with what the three Markdown extractors find, in their order.
    Lines and blocks are made once; no shuffle is needed."""
    return _neighbor_references(_numbered_lines(_math_blocks(_with_blocks(docs)))).select("doc_id", F.concat("math", "numbered", "near").alias("candidates"))


def page_rows(page_lines: DataFrame) -> DataFrame:
    """A row per document with its page lines in order, each with what the window walk asks of it."""
    t = strip(F.col("text"))
    label = L.page_label(t)
    one = F.struct(
        "global_line", t.alias("text"), "page", "page_line", L.is_page_fragment(t).alias("fragment"), L.is_page_continuation(t).alias("goes_on"),
        t.rlike(P.PAGE_TRAILING_LABEL).alias("labelled"), label["number"].alias("number"), label["alone"].alias("alone"),
    )
    return page_lines.where(F.col("text").isNotNull()).select("doc_id", one.alias("l")).groupBy("doc_id").agg(F.array_sort(F.collect_list("l")).alias("l"))


def _window(all_lines: Column, i: Column) -> Column:
    """The text of the equation that line ``i`` labels, and its first line: walking back over fragments."""
    me = F.get(all_lines, i)
    own = strip(F.regexp_replace(me["text"], P.PAGE_TRAILING_LABEL, ""))
    first = F.greatest(i - P.PAGE_WINDOW, F.lit(0))
    before = F.reverse(F.slice(all_lines, first + 1, i - first))
    texts = F.when(me["alone"], F.array().cast("array<string>")).otherwise(F.array(own))
    zero = F.struct(F.lit(False).alias("done"), i.alias("at"), i.alias("start"), texts.alias("texts"))

    def step(acc: Column, x: Column) -> Column:
        begun = F.size(acc["texts"]) > 0
        take = (~acc["done"]) & ~(begun & x["labelled"]) & (x["fragment"] | (begun & x["goes_on"]))
        at = acc["at"] - 1
        return F.struct(
            (acc["done"] | (begun & ~take)).alias("done"), at.alias("at"), F.when(take, at).otherwise(acc["start"]).alias("start"),
            F.when(take, F.concat(F.array(x["text"]), acc["texts"])).otherwise(acc["texts"]).alias("texts"),
        )

    def finish(acc: Column) -> Column:
        none = (F.size(acc["texts"]) == 0) & (i > 0)
        texts = F.when(none, F.array(F.get(all_lines, i - 1)["text"])).otherwise(acc["texts"])
        return F.struct(F.array_join(F.filter(texts, lambda t: t != ""), " ").alias("text"), F.when(none, i - 1).otherwise(acc["start"]).alias("start"))

    return F.aggregate(before, zero, step, finish)


def page_text(page_lines: DataFrame, limit: int = P.EQUATIONS_A_DOCUMENT, strict: bool = False) -> DataFrame:
    """Candidates from page lines, at most ``limit`` (at least one) a document, before any are dropped as repeated."""
    rows = page_rows(page_lines)
    at = F.filter(F.transform("l", lambda x, i: F.when(x["number"].isNotNull(), i)), lambda i: i.isNotNull())

    def described(i: Column) -> Column:
        w = _window(F.col("l"), i)
        return F.struct(i.alias("index"), w["text"].alias("text"), w["start"].alias("start"), F.get(F.col("l"), i).alias("me"))

    rows = rows.withColumn("found", F.transform(at, described)).select("doc_id", "l", F.explode_outer("found").alias("x")).where("x is not null")
    left = F.greatest(F.col("x.start") - 2, F.lit(0))
    near = F.transform(F.slice("l", left + 1, F.col("x.index") + 3 - left), lambda x: x["text"])
    first = F.get("l", F.col("x.start"))
    rows = rows.select(
        "doc_id", F.col("x.index").alias("emit_ord"), F.col("x.text").alias("collected"), F.col("x.me.number").alias("number"), F.col("x.me.page").alias("page"),
        first["global_line"].alias("line_start"), F.col("x.me.global_line").alias("line_end"), first["page_line"].alias("first_line"), F.col("x.me.page_line").alias("last_line"),
        F.substring(F.array_join(near, " "), 1, P.CONTEXT_LIMIT).alias("context"),
    ).where(L.is_usable_page_text(F.col("collected"), strict))
    label = F.concat(F.lit(rf"(?Ud)\({P.S}*\Q"), F.col("number"), F.lit(rf"\E{P.S}*\){P.S}*$"))
    rows = rows.withColumn("text", strip(F.regexp_replace(F.col("collected"), label, F.lit(""))))
    rows = rows.withColumn("raw_latex", glyphs_to_latex(F.col("text"))).withColumn("latex", output_form(F.col("raw_latex"))).where("latex <> ''")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("emit_ord"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= max(limit, 1))
    location = F.format_string("PDF page %d, text lines %d-%d", F.col("page"), F.col("first_line"), F.col("last_line"))
    own = _described(P.PAGE_TEXT, 3, location, F.col)
    own["warnings"] = F.concat(own["warnings"], L.page_text_warnings(F.col("text")))
    return rows.select(*[(own[c] if c in own else F.col(c)).alias(c) for c in COLUMNS])


def with_source(candidates: DataFrame, source: Column, prefix: str) -> DataFrame:
    """Candidates under another source: confidence, warnings and location follow."""
    out = candidates.withColumn("source", source)
    return out.withColumns({"confidence": L.confidence(F.col("source")), "warnings": L.quality_warnings(F.col("source"), F.col("latex"), F.col("raw_latex")), "source_location": F.concat(F.lit(prefix), F.col("source_location"))})


def as_page_retry(candidates: DataFrame) -> DataFrame:
    return with_source(candidates, F.lit(P.PAGE_RETRY), "Page retry from ")


def as_alternative(candidates: DataFrame) -> DataFrame:
    source = F.lit(P.ALTERNATIVE[P.MATH_BLOCK])
    for k, v in P.ALTERNATIVE.items():
        source = F.when(F.col("source") == k, v).otherwise(source)
    return with_source(candidates, source, "Pix2Text fallback from ")
