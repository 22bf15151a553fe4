"""Scans: paper lists, Markdown folders, PDF bytes, page lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lines, strip

#: Page lines as the engine takes them; ``page_lines`` adds ``error``.
PAGE_LINES = "doc_id string, text string, page int, page_line int, global_line int"


def papers_of(text: Column) -> Column:
    """Identifiers in a paper list's text, in order; blank lines and the prefix ``arXiv:`` are dropped."""
    kept = F.filter(F.transform(lines(text), strip), lambda t: t != "")
    return F.transform(kept, lambda t: strip(F.regexp_replace(t, r"\AarXiv:", "")))


def paper_list(spark: SparkSession, path: str) -> DataFrame:
    """``paper_number`` (from 1) and ``arxiv_id``."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(papers_of(F.col("value"))).alias("n", "arxiv_id"))
    return rows.select((F.col("n") + 1).alias("paper_number"), "arxiv_id")


def select_paper(papers: DataFrame, number: int) -> str:
    rows = papers.where(F.col("paper_number") == number).select("arxiv_id").take(1)
    if not rows:
        raise ValueError(f"paper number must be between 1 and {papers.count()}")
    return rows[0][0]


def markdown(spark: SparkSession, path: str, glob: str = "*.md", recursive: bool = False) -> DataFrame:
    """``doc_id`` (the file's name without ending), ``markdown``, ``markdown_chars``, ``status``."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select(name.alias("doc_id"), F.col("value").alias("markdown"), F.length("value").alias("markdown_chars"), F.lit("cached_docling_markdown").alias("status"))


def joined_markdown(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, markdown``: of each folder in ``path`` (a conversion that is several files) all Markdown
    files at any depth, in order of their paths, joined by an empty line. Files in ``path`` itself have the
    empty identifier."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    root = F.lit(path.rstrip("/").split(":", 1)[-1].lstrip("/") + "/")
    inside = F.element_at(F.split(F.col("_metadata.file_path"), F.concat(F.lit(r"\Q"), root, F.lit(r"\E")), 2), -1)
    files = files.select(F.when(F.contains(inside, F.lit("/")), F.substring_index(inside, "/", 1)).otherwise("").alias("doc_id"), F.struct(F.col("_metadata.file_path").alias("path"), "value").alias("f"))
    return files.groupBy("doc_id").agg(F.array_sort(F.collect_list("f")).alias("f")).select("doc_id", F.array_join(F.transform("f", lambda x: x["value"]), "\n\n").alias("markdown"))


def alternatives(spark: SparkSession, path: str) -> DataFrame:
    """Kept alternative conversions: ``doc_id, pages, markdown``; ``pages`` in the order of the name, empty
    where it names all. Files with other names are left out."""
    named = r"([^/]+)_pages_(all|[0-9]+(?:_[0-9]+)*)\.md$"
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.md")
    name, listed = F.col("_metadata.file_path"), F.regexp_extract(F.col("_metadata.file_path"), named, 2)
    pages = F.when(listed == "all", F.array().cast("array<int>")).otherwise(F.split(listed, "_").cast("array<int>"))
    return files.where(name.rlike(named)).select(F.regexp_extract(name, named, 1).alias("doc_id"), pages.alias("pages"), F.col("value").alias("markdown"))


def pdfs(spark: SparkSession, path: str) -> DataFrame:
    """PDF files of a folder: ``doc_id, content, size_bytes, is_pdf`` (its mark in the first 1024 bytes)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path)
    name = F.regexp_extract("path", r"([^/]+)\.pdf$", 1)
    mark = F.contains(F.substring("content", 1, 1024), F.lit(b"%PDF"))
    return files.select(name.alias("doc_id"), "content", F.col("length").alias("size_bytes"), mark.alias("is_pdf"))


def per_file(pdf_files: DataFrame, make: Callable[[], Callable[[bytes, dict], list[tuple]]], schema: str, *more: str) -> DataFrame:
    """An adapter for a library that reads one PDF at a time.

    ``make`` runs in the worker (and may import the library there); the function that it returns takes a
    file's bytes and its columns ``more`` and returns rows of ``schema``. The result has ``doc_id``, the columns of
    ``schema`` and ``error``: a document on which the function raises is one row of nulls with the name and text of the
    error, and so is each document where the library is missing; the others are not touched by it.
    """
    import pandas as pd

    names = [part.split()[0] for part in schema.split(", ")]

    def run(frames):
        try:
            work, missing = make(), None
        except ImportError as e:
            work, missing = None, e
        for frame in frames:
            rows = []
            for doc_id, content, *rest in zip(frame["doc_id"], frame["content"], *(frame[c] for c in more), strict=True):
                try:
                    if work is None:
                        raise missing
                    rows += [(doc_id, *r, None) for r in work(bytes(content), dict(zip(more, rest, strict=True)))]
                except Exception as e:  # noqa: BLE001 - whatever a library raises stays with its document
                    rows.append((doc_id, *[None] * len(names), f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", *names, "error"], dtype=object)

    return pdf_files.select("doc_id", "content", *more).mapInPandas(run, f"doc_id string, {schema}, error string")


def page_counts(pdf_files: DataFrame) -> DataFrame:
    """``doc_id, pages, error``; ``pages`` is null where the file or the library (PyMuPDF) fails."""

    def make():
        import fitz

        def count(content, _):
            with fitz.open(stream=content, filetype="pdf") as pages:
                return [(pages.page_count,)]

        return count

    return per_file(pdf_files, make, "pages int")


def page_lines(pdf_files: DataFrame) -> DataFrame:
    """Text lines of PDF pages, by PyMuPDF. A document that fails is a row without a text, with its error."""

    def make():
        import fitz

        def extract(content, _):
            rows = []
            with fitz.open(stream=content, filetype="pdf") as pages:
                for page, p in enumerate(pages, 1):
                    for at, text in enumerate(p.get_text("text").splitlines(), 1):
                        rows.append((text.strip(), page, at, len(rows) + 1))
            return rows

        return extract

    return per_file(pdf_files, make, "text string, page int, page_line int, global_line int")


def single_pages(pdf_files: DataFrame, pages: DataFrame) -> DataFrame:
    """``doc_id, page, page_content, error``: one PDF for each row of ``pages`` (``doc_id, page``), cut out
    by PyMuPDF; a page outside its document is an error."""

    def make():
        import fitz

        def cut(content, row):
            page = int(row["page"])
            with fitz.open(stream=content, filetype="pdf") as source:
                if not 1 <= page <= source.page_count:
                    raise ValueError(f"page {page} is outside the document")
                with fitz.open() as one:
                    one.insert_pdf(source, from_page=page - 1, to_page=page - 1)
                    return [(page, one.tobytes())]

        return cut

    asked = pdf_files.select("doc_id", "content").join(pages.select("doc_id", "page"), "doc_id")
    return per_file(asked, make, "out_page int, page_content binary", "page").withColumnRenamed("out_page", "page")


def converted(pdf_files: DataFrame, make: Callable[[], Callable[[bytes], str]], ocr: bool = False) -> DataFrame:
    """Markdown of PDFs by any converter: ``doc_id, markdown, markdown_chars, status, error, ocr_enabled``.

    ``make`` runs in the worker and returns a function from a file's bytes to Markdown. A failure gives the
    empty text and the status ``docling_failed:`` with the error's name, so that page text can still speak.
    """

    def adapted():
        convert = make()
        return lambda content, _: [(convert(content),)]

    rows, failed = per_file(pdf_files, adapted, "markdown string"), F.col("error").isNotNull()
    text = F.coalesce("markdown", F.lit(""))
    status = F.when(failed, F.concat(F.lit("docling_failed:"), F.substring_index("error", ":", 1))).otherwise("success")
    return rows.select("doc_id", text.alias("markdown"), F.length(text).alias("markdown_chars"), status.alias("status"), "error", F.lit(ocr).alias("ocr_enabled"))


def alternative_name(stem: Column, pages: Column) -> Column:
    """The cache name of an alternative conversion; the order of pages stays."""
    listed = F.when(F.size(pages) == 0, "all").otherwise(F.array_join(F.transform(pages, lambda p: p.cast("string")), "_"))
    return F.concat(stem, F.lit("_pages_"), listed, F.lit(".md"))
