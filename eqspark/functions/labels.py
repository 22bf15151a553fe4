"""Order, scope, confidence and warnings of labelled equations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import has, let


def sort_key(number: Column) -> Column:
    """Order of labels: ``major.minor`` and plain numbers, then those with a letter in front, then the rest.

    Numbers of any length are ordered by their digits without leading zeros: first by how many there are.
    """
    decimal, general = r"(?U)\A(\d+)\.(\d+)\z", r"(?Ud)\A([A-Za-z]?)(\d+)(.*)"
    plain = lambda digits: F.regexp_replace(digits, r"\A0+", "")

    def key(rank, digits: Column, rest: Column) -> Column:
        return let(plain(digits), lambda d: F.struct(F.lit(rank).cast("int").alias("rank"), F.length(d).alias("size"), d.alias("digits"), rest.alias("rest")))

    def keyed(n: Column) -> Column:
        minor = let(plain(F.regexp_extract(n, decimal, 2)), lambda m: F.when(F.length(m) < 6, F.lpad(m, 6, "0")).otherwise(m))
        with_minor = key(0, F.regexp_extract(n, decimal, 1), minor)
        letter = F.when(F.regexp_extract(n, general, 1) == "", 0).otherwise(1)
        return F.when(n.rlike(decimal), with_minor).when(n.rlike(general), key(letter, F.regexp_extract(n, general, 2), F.regexp_extract(n, general, 3))).otherwise(key(2, F.lit(""), n))

    return let(number, keyed)


def is_main(number: Column) -> Column:
    return number.rlike(P.MAIN_LABEL)


def in_scope(number: Column, scope: str) -> Column:
    if scope not in ("all", "main"):
        raise ValueError(f"unsupported label scope: {scope}")
    return F.lit(True) if scope == "all" else is_main(number)


def confidence(source: Column) -> Column:
    return F.when(source.isin(P.MATH_BLOCK, P.PAGE_RETRY), "high").when(source.startswith("pix2text_markdown_") | source.isin(P.NUMBERED_LINE, P.NEIGHBOR), "medium").otherwise("low")


def _listed(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for condition, name in rules])).cast("array<string>")


def quality_warnings(source: Column, latex: Column, raw: Column) -> Column:
    page_text = source == P.PAGE_TEXT
    return _listed(
        (source == P.PAGE_RETRY, "page_retry_replaced_fallback"),
        (source.startswith("pix2text_markdown_"), "pix2text_fallback_replaced_pymupdf"),
        (source.isin(P.NEIGHBOR, P.ALTERNATIVE[P.NEIGHBOR]), "label_inferred_from_nearby_prose"),
        (page_text, "fallback_only_needs_review"),
        (page_text, "pymupdf_text_is_recall_signal_not_trusted_latex"),
        (latex.rlike(P.CONTAMINATION), "possible_prose_contamination"),
        (latex.rlike(P.DEGRADATION), "possible_pdf_text_degradation"),
        (has(raw, "\\begin{array}") | raw.rlike(P.ARRAY_HEAD), "needs_artifact_cleanup"),
        (raw != latex, "normalized_from_raw"),
    )


def label_warnings(number: Column) -> Column:
    return _listed(
        (number == "0", "suspicious_zero_equation_label"),
        (number.rlike(P.LABEL_WITH_LETTER), "appendix_or_supplement_label"),
        (number.rlike(P.LABEL_WITH_LETTERS_BEHIND), "suspicious_alphanumeric_equation_label"),
    )


def page_text_warnings(text: Column) -> Column:
    words, strong = F.regexp_count(text, F.lit(P.LONG_WORD)), text.rlike(P.STRONG_SIGNAL)
    return _listed(
        (words > 8, "fallback_candidate_has_many_prose_words"),
        (~strong, "fallback_candidate_has_weak_equation_structure"),
        (text.rlike(P.PROSE_STOP) & (words > 4), "fallback_candidate_contains_prose_cue"),
    )


def is_page_fragment(text: Column) -> Column:
    """Whether a page line may be part of an equation."""
    signal = text.rlike(P.MATH_SIGNAL)
    words, marks, strong = (F.regexp_count(text, F.lit(p)) for p in (P.LONG_WORD, P.MATH_MARK, P.STRONG_MARK))
    rejected = (text == "") | text.rlike(P.FRAGMENT_STOP) | text.rlike(P.CITATION) | ((F.length(text) > 160) & ~signal) | ((words > 3) & (strong == 0))
    return F.when(rejected, False).when(signal & ((marks >= 2) | (words <= 6)), True).otherwise(text.rlike(P.ONLY_MATH) & (marks >= 3))


def is_page_continuation(text: Column) -> Column:
    """Whether a short page line may go on an equation that was begun."""
    rejected = (text == "") | (F.length(text) > 35) | text.rlike(P.FRAGMENT_STOP)
    return F.when(rejected, False).otherwise((F.regexp_count(text, F.lit(P.LONG_WORD)) <= 1) & text.rlike(P.SHORT_CONTENT))


def is_usable_page_text(text: Column, strict: bool) -> Column:
    words, marks = F.regexp_count(text, F.lit(P.LONG_WORD)), F.regexp_count(text, F.lit(P.USABLE_MARK))
    rejected = (text == "") | ~text.rlike(P.MATH_SIGNAL) | ((words > 12) & ~text.rlike(P.STRONG_SIGNAL)) | (text.rlike(P.PROSE_STOP) & (words > 8) & (marks < 4))
    if strict:
        rejected = rejected | (F.size(page_text_warnings(text)) > 0)
    return ~rejected


def page_label(text: Column) -> Column:
    """A page line's label and whether it stands alone; nulls without one."""
    alone, trailing = text.rlike(P.PAGE_LABEL_LINE), text.rlike(P.PAGE_TRAILING_LABEL) & text.rlike(P.MATH_SIGNAL)
    number = F.when(alone, F.regexp_extract(text, P.PAGE_LABEL_LINE, 1)).when(trailing, F.regexp_extract(text, P.PAGE_TRAILING_LABEL, 1))
    return F.struct(number.alias("number"), alone.alias("alone"))


def device(pages: Column, size_bytes: Column, policy: str = "auto", max_pages: int = P.DEVICE_PAGES, max_mb: float = P.DEVICE_MB, hidden: bool = False) -> Column:
    """Which device a conversion takes and why. ``hidden``: the environment hides the accelerator."""
    mb = size_bytes / 1048576
    if policy == "cpu":
        use_cpu, reason = F.lit(True), F.lit("requested_cpu")
    elif policy == "gpu":
        use_cpu, reason = F.lit(False), F.lit("requested_gpu")
    elif policy == "auto":
        many, large = F.coalesce(pages > max_pages, F.lit(False)), mb > max_mb
        parts = F.concat_ws("_", F.when(many, f"pages>{max_pages}"), F.when(large, f"size_mb>{max_mb:g}"))
        use_cpu, reason = many | large, F.when(many | large, F.concat(F.lit("auto_cpu_"), parts)).otherwise("auto_gpu_small_pdf")
    else:
        raise ValueError(f"unsupported device policy: {policy}")
    if hidden:
        reason = F.when(use_cpu, reason).otherwise(F.concat(reason, F.lit("_but_cuda_hidden_by_environment")))
    return F.struct(F.when(use_cpu, "cpu").otherwise("gpu").alias("selected_device"), reason.alias("device_reason"), F.round(mb, 2).alias("pdf_size_mb"))
