"""Registered queries of the extraction engine and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import latex as X
from ..functions import patterns as P
from ..functions.text import strip
from ..operators import blocks as B
from ..operators import extract as E
from ..operators import report as R
from ..operators import resolve as V
from ..operators import whole as W
from ..sources import readers, sinks
from ..sources.stored import stored
from . import duck as D
from .synthetic import LINE, LINES_DUCK, REAL_TEXT

QUERIES, ORACLES = {}, {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the synthetic documents. They are a narrow column of few files, but stand for whole
    documents, so they are dealt over all tasks first."""
    return table(spark, sf_dir, "orders").select("o_orderkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def synthetic_lines(spark: SparkSession, sf_dir: str, kept: str = "true") -> DataFrame:
    """The lines of the synthetic documents; those that ``kept`` doesn't hold for were lost in conversion: they are empty."""
    orders = keys(spark, sf_dir).select("o_orderkey", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    return orders.select(F.col("o_orderkey").alias("doc_id"), F.col("i").alias("line_no"), F.expr(f"CASE WHEN {kept} THEN {LINE} ELSE '' END").alias("text"))


def joined(rows: DataFrame, *key: str, order: str = "line_no") -> DataFrame:
    """Documents of lines."""
    rows = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("l"))
    return rows.select(*key, F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("markdown"))


def synthetic_docs(spark: SparkSession, sf_dir: str, kept: str = "true") -> DataFrame:
    orders = keys(spark, sf_dir).select("o_orderkey", F.sequence(F.lit(0), F.lit(11)).alias("lines"))
    text = F.expr(f"array_join(transform(lines, i -> CASE WHEN {kept} THEN {LINE} ELSE '' END), chr(10))")
    return orders.select(F.col("o_orderkey").alias("doc_id"), text.alias("markdown"))


def real_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("markdown"))


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic lines as page lines, four to a page."""
    n = F.col("line_no")
    return synthetic_lines(spark, sf_dir).select("doc_id", strip("text").alias("text"), (F.floor(n / 4) + 1).cast("int").alias("page"), (n % 4 + 1).cast("int").alias("page_line"), (n + 1).cast("int").alias("global_line"))


def page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(page_lines(spark, sf_dir), "doc_id", "page", order="page_line")


def equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.extract_equations(synthetic_docs(spark, sf_dir))


#: A conversion that broke off after a third, so that page text fills in, and one that has only the middle.
BROKEN, MIDDLE = "i < 4", "i BETWEEN 4 AND 7"


def page_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.extract_equations(synthetic_docs(spark, sf_dir, BROKEN), page_lines=page_lines(spark, sf_dir))


def flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("warnings", F.concat_ws(",", "warnings"))


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


#: The line splitter and the strip of the rules, in DuckDB.
SPLIT = r"string_split_regex(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]')"
DOC_LINES = f"(SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS text FROM (SELECT doc_id, CASE WHEN l[len(l)] = '' THEN l[:len(l) - 1] ELSE l END AS l FROM (SELECT doc_id, {SPLIT} AS l FROM documents)))"
STRIPPED = f"(SELECT doc_id, line_no, text AS whole, trim(text) AS text FROM {LINES_DUCK})"
LABEL_DUCK = r"[A-Za-z]?\s*[0-9]+(?:\.[0-9]+)?\s*[a-z]?"
CANDIDATE_DUCK = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '\$\$$', ''), '\\\]$', ''), '```$', ''))"
TRAIL_DUCK = rf"nullif(regexp_replace(regexp_extract(t, '(?:^|[^\w.])\(\s*({LABEL_DUCK})\s*\)\s*$', 1), '\s+', '', 'g'), '')"
TAG_DUCK = r"nullif(regexp_replace(regexp_extract(t, '\\tag\{([^{}]+)\}', 1), '\s+', '', 'g'), '')"
SIGNAL_DUCK = r"regexp_matches(text, '\\[A-Za-z]+|[=+\-*/^_<>]|\b(?:psi|phi|rho|sigma|lambda|omega|theta|hat|ket|bra)\b')"
SEGMENTS = f"""(SELECT doc_id, line_no AS block_start, CASE WHEN fin THEN line_no ELSE coalesce(nxt, 12) END AS block_end FROM (
 SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS state,
  first_value(CASE WHEN shut THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
 FROM (SELECT *, CASE WHEN beg AND NOT fin THEN 1 WHEN shut THEN 0 END AS mark FROM (
  SELECT doc_id, line_no, starts_with(text, '$$') OR starts_with(text, '\\[') OR starts_with(text, '```math') AS beg, ends_with(text, '$$') OR ends_with(text, '\\]') AS fin,
   ends_with(text, '$$') OR ends_with(text, '\\]') OR text = '```' AS shut FROM {STRIPPED}))) WHERE state = 0 AND beg)"""


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, text FROM {DOC_LINES}")
def line_split(spark, sf_dir):
    return B.line_rows(real_docs(spark, sf_dir))


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INT) AS paper_number, concat('0', n_nationkey, '.', n_regionkey) AS arxiv_id FROM nation")
def paper_list_scan(spark, sf_dir):
    name = F.concat(F.lit(" arXiv:0"), F.col("n_nationkey").cast("string"), F.lit("."), F.col("n_regionkey").cast("string"), F.lit(" \n\n"))
    text = table(spark, sf_dir, "nation").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", name.alias("t")))).alias("l"))
    listed = text.select(readers.papers_of(F.array_join(F.transform("l", lambda x: x["t"]), "")).alias("p"))
    return listed.select(F.posexplode("p").alias("n", "arxiv_id")).select((F.col("n") + 1).alias("paper_number"), "arxiv_id")


@query(
    f"""SELECT doc_id, line_no, {SIGNAL_DUCK} AS math_signal,
 regexp_matches(text, '=|\\\\(?:frac|sum|int|prod|lim|begin\\{{(?:array|matrix|pmatrix|bmatrix)|le|ge|neq|approx|in|to|rightarrow|leftarrow)\\b|\\b(?:lim|arg\\s*min|arg\\s*max)\\b') AS strong_signal,
 regexp_matches(text, '(?i)\\b(?:according|ancilla|figure|implementation|resulting|controlled|respectively|where|describes|represents|shown|given|using|between|register)\\b') AS prose_stop
 FROM {STRIPPED}"""
)
def line_signals(spark, sf_dir):
    t = strip(F.col("text"))
    return synthetic_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), t.rlike(P.MATH_SIGNAL).alias("math_signal"), t.rlike(P.STRONG_SIGNAL).alias("strong_signal"), t.rlike(P.PROSE_STOP).alias("prose_stop"))


@query(f"SELECT doc_id, CAST(block_start AS INT) AS block_start, CAST(block_end AS INT) AS block_end FROM {SEGMENTS}")
def block_segments(spark, sf_dir):
    return B.blocks(synthetic_docs(spark, sf_dir)).select("doc_id", F.col("start").alias("block_start"), F.col("end").alias("block_end"))


@query(f"SELECT s.doc_id, CAST(block_start AS INT) AS block_start, string_agg(l.text, chr(10) ORDER BY line_no) AS raw FROM {SEGMENTS} s JOIN {LINES_DUCK} l ON l.doc_id = s.doc_id AND line_no BETWEEN block_start AND block_end GROUP BY ALL")
def block_text(spark, sf_dir):
    return B.blocks(synthetic_docs(spark, sf_dir)).select("doc_id", F.col("start").alias("block_start"), "raw")


@query(
    f"SELECT s.doc_id, CAST(block_start AS INT) AS block_start, coalesce(left(string_agg(l.text, ' ' ORDER BY line_no) FILTER (l.text <> ''), 500), '') AS context FROM {SEGMENTS} s "
    f"JOIN {STRIPPED} l ON l.doc_id = s.doc_id AND line_no BETWEEN block_start - 2 AND block_end + 2 GROUP BY s.doc_id, block_start"
)
def context_window(spark, sf_dir):
    return B.blocks(synthetic_docs(spark, sf_dir)).select("doc_id", F.col("start").alias("block_start"), "context")


@query(f"SELECT doc_id, line_no, coalesce({TAG_DUCK}, {TRAIL_DUCK}) AS number FROM (SELECT *, {CANDIDATE_DUCK} AS t FROM {STRIPPED})")
def line_label(spark, sf_dir):
    return synthetic_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), X.number_of(F.col("text")).alias("number"))


_SYNTHETIC = f"({D.lines_of()})"


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, number FROM {D.with_number(_SYNTHETIC, 'whole', 'number', True)}")
def line_label_embedded(spark, sf_dir):
    return synthetic_lines(spark, sf_dir).select("doc_id", "line_no", X.number_of(F.col("text"), embedded=True).alias("number"))


@query(
    rf"""SELECT doc_id, line_no, regexp_replace(trim(regexp_replace(trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(
 trim(regexp_replace(trim(regexp_replace(text, '^```(?:math|latex)?', '')), '```$', '')), '^\$\$', ''), '\$\$$', '')), '^\\\[', ''), '\\\]$', '')), '\\tag\{{[^{{}}]+\}}', '', 'g')), '\s+', ' ', 'g') AS latex FROM {STRIPPED}"""
)
def latex_normalize(spark, sf_dir):
    return synthetic_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), X.normalize_latex(F.col("text")).alias("latex"))


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, {D.stripped_number('whole', 'number')} AS text FROM {D.with_number(_SYNTHETIC, 'whole', 'number', True)}")
def strip_number(spark, sf_dir):
    rows = synthetic_lines(spark, sf_dir).withColumn("number", X.number_of(F.col("text"), embedded=True))
    return rows.select("doc_id", "line_no", X.strip_number(F.col("text"), F.col("number")).alias("text"))


@query(f"SELECT doc_id, CAST(line_no AS INT) AS line_no, {D.output_form('whole')} AS latex FROM {_SYNTHETIC}")
def output_normalize(spark, sf_dir):
    return synthetic_lines(spark, sf_dir).select("doc_id", "line_no", X.output_form(F.col("text")).alias("latex"))


@query(f"WITH {D.markdown_cte('r_', D.text_lines(REAL_TEXT))} SELECT * FROM {D.chosen('r_found')}")
def real_text_extraction(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(REAL_TEXT).alias("markdown"))
    return flat(V.extract_equations(docs))


@query(f"SELECT DISTINCT number, regexp_full_match(number, '[1-9][0-9]*(?:\\.[0-9]+)?') AS main FROM (SELECT coalesce({TAG_DUCK}, {TRAIL_DUCK}) AS number FROM (SELECT *, {CANDIDATE_DUCK} AS t FROM {STRIPPED})) WHERE number IS NOT NULL")
def label_scope_main(spark, sf_dir):
    return line_label(spark, sf_dir).where("number is not null").select("number").distinct().withColumn("main", L.is_main(F.col("number")))


@query(f"SELECT doc_id, number, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY {D.SORT_KEY}, number) AS INT) AS place FROM (SELECT DISTINCT doc_id, label AS number FROM {D.with_number(_SYNTHETIC, 'whole', 'label')} WHERE label IS NOT NULL)")
def label_sort(spark, sf_dir):
    rows = line_label(spark, sf_dir).where("number is not null").select("doc_id", "number").distinct()
    return rows.select("doc_id", "number", F.row_number().over(Window.partitionBy("doc_id").orderBy(L.sort_key(F.col("number")), "number")).alias("place"))


@query(f"SELECT DISTINCT number, concat_ws(',', CASE WHEN number = '0' THEN 'suspicious_zero_equation_label' END, CASE WHEN regexp_matches(number, '^[A-Za-z][0-9]') THEN 'appendix_or_supplement_label' END, CASE WHEN regexp_matches(number, '^[0-9]+[A-Za-z]') THEN 'suspicious_alphanumeric_equation_label' END) AS warnings FROM (SELECT coalesce({TAG_DUCK}, {TRAIL_DUCK}) AS number FROM (SELECT *, {CANDIDATE_DUCK} AS t FROM {STRIPPED})) WHERE number IS NOT NULL")
def label_warnings(spark, sf_dir):
    return label_scope_main(spark, sf_dir).select("number", F.concat_ws(",", L.label_warnings(F.col("number"))).alias("warnings"))


_MARKDOWN = D.markdown_cte("d_", D.lines_of())


@query(f"WITH {_MARKDOWN} SELECT * FROM d_math")
def math_block_candidates(spark, sf_dir):
    return flat(E.math_blocks(synthetic_docs(spark, sf_dir)))


@query(f"WITH {_MARKDOWN} SELECT * FROM d_numbered")
def numbered_line_candidates(spark, sf_dir):
    return flat(E.numbered_lines(synthetic_docs(spark, sf_dir)))


@query(f"WITH {_MARKDOWN} SELECT * FROM d_near")
def neighbor_reference_candidates(spark, sf_dir):
    return flat(E.neighbor_references(synthetic_docs(spark, sf_dir)))


_REFERENCE = r"CASE WHEN text <> '' AND NOT starts_with(text, '$$') THEN CASE WHEN len(regexp_extract_all(text, '\b[Ee]q\.?\s*\(?\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)?', 1)) = 1 THEN regexp_extract_all(text, '\b[Ee]q\.?\s*\(?\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)?', 1)[1] WHEN len(regexp_extract_all(text, '\(\s*([1-9][0-9]?\.[0-9]{1,3})\s*\)', 1)) = 1 THEN regexp_extract_all(text, '\(\s*([1-9][0-9]?\.[0-9]{1,3})\s*\)', 1)[1] END END"


@query(f"SELECT s.doc_id, CAST(block_start AS INT) AS block_start, arg_min(ref, CASE WHEN line_no > block_end THEN line_no - block_end ELSE 100 + block_start - line_no END) AS reference FROM {SEGMENTS} s JOIN (SELECT doc_id, line_no, {_REFERENCE} AS ref FROM {STRIPPED}) l ON l.doc_id = s.doc_id AND ref IS NOT NULL AND (line_no BETWEEN block_end + 1 AND block_end + 4 OR line_no BETWEEN block_start - 4 AND block_start - 1) GROUP BY s.doc_id, block_start")
def nearest_reference(spark, sf_dir):
    return B.blocks(synthetic_docs(spark, sf_dir)).where("reference is not null").select("doc_id", F.col("start").alias("block_start"), "reference")


@query(f"WITH RECURSIVE {D.page_cte('p_')} SELECT * FROM p_page")
def page_text_candidates(spark, sf_dir):
    return flat(E.page_text(page_lines(spark, sf_dir)))


@query(f"WITH RECURSIVE {D.page_cte('p_', True)} SELECT * FROM p_page")
def page_text_candidates_strict(spark, sf_dir):
    return flat(E.page_text(page_lines(spark, sf_dir), strict=True))


@query(
    rf"SELECT doc_id, line_no, CASE WHEN alone <> '' THEN alone WHEN tail_ <> '' AND sig THEN tail_ END AS number, alone <> '' AS alone FROM (SELECT doc_id, line_no, regexp_extract(text, '^\s*\(\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)\s*$', 1) AS alone, regexp_extract(text, '\(\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)\s*$', 1) AS tail_, {SIGNAL_DUCK} AS sig FROM {STRIPPED})"
)
def page_label(spark, sf_dir):
    return synthetic_lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), L.page_label(strip(F.col("text"))).alias("l")).select("doc_id", "line_no", "l.*")


#: Facts of the synthetic lines (all ASCII) that the page-line rules weigh, in DuckDB.
_PAGE_FACTS = (
    f"(SELECT *, {SIGNAL_DUCK} AS sig, "
    + r"""regexp_matches(text, '=|\\(?:frac|sum|int|prod|lim|begin\{(?:array|matrix|pmatrix|bmatrix)|le|ge|neq|approx|in|to|rightarrow|leftarrow)\b|\b(?:lim|arg\s*min|arg\s*max)\b') AS strong,
 regexp_matches(text, '(?i)\b(?:according|ancilla|figure|implementation|resulting|controlled|respectively|where|describes|represents|shown|given|using|between|register)\b') AS cue,
 regexp_matches(text, '(?i)\b(?:Eq|Fig|where|giving|respectively|represents|describes)\b') OR text = '' AS stop, regexp_matches(text, '\[[0-9]+(?:,\s*[0-9]+)*\]') AS cites,
 len(regexp_extract_all(text, '\b[a-zA-Z]{4,}\b')) AS words, len(regexp_extract_all(text, '[=+\-*/^_()|]')) AS marks, len(regexp_extract_all(text, '[=+*/^_|]')) AS strong_marks, len(regexp_extract_all(text, '[=+\-*/^_<>|]')) AS usable_marks,
 regexp_full_match(text, '[\w\s\\{}()\[\].,|+\-*/^_=<>]+') AS only_math, regexp_matches(text, '[\w|()\[\]{}+\-*/^_=<>]') AS content FROM """
    + f"{STRIPPED})"
)


@query(
    f"""SELECT doc_id, CAST(line_no AS INT) AS line_no,
 CASE WHEN stop OR cites OR (length(text) > 160 AND NOT sig) OR (words > 3 AND strong_marks = 0) THEN false WHEN sig AND (marks >= 2 OR words <= 6) THEN true ELSE only_math AND marks >= 3 END AS fragment,
 NOT stop AND length(text) <= 35 AND words <= 1 AND content AS goes_on,
 concat_ws(',', CASE WHEN words > 8 THEN 'fallback_candidate_has_many_prose_words' END, CASE WHEN NOT strong THEN 'fallback_candidate_has_weak_equation_structure' END, CASE WHEN cue AND words > 4 THEN 'fallback_candidate_contains_prose_cue' END) AS warnings,
 NOT (text = '' OR NOT sig OR (words > 12 AND NOT strong) OR (cue AND words > 8 AND usable_marks < 4)) AS usable FROM {_PAGE_FACTS}"""
)
def page_fragments(spark, sf_dir):
    t = strip(F.col("text"))
    return synthetic_lines(spark, sf_dir).select("doc_id", "line_no", L.is_page_fragment(t).alias("fragment"), L.is_page_continuation(t).alias("goes_on"), F.concat_ws(",", L.page_text_warnings(t)).alias("warnings"), L.is_usable_page_text(t, False).alias("usable"))


@query(f"WITH {_MARKDOWN} SELECT * FROM {D.chosen('d_found')}")
def extracted_equations(spark, sf_dir):
    return flat(equations(spark, sf_dir))


@query(f"WITH {_MARKDOWN} SELECT * FROM {D.chosen('d_found', 2)}")
def limit_per_document(spark, sf_dir):
    return flat(V.extract_equations(synthetic_docs(spark, sf_dir), limit=2))


@query(f"WITH {_MARKDOWN} SELECT * FROM {D.chosen('d_found', 2)} WHERE regexp_full_match(number, '[1-9][0-9]*(?:\\.[0-9]+)?')")
def scope_after_limit(spark, sf_dir):
    return flat(V.in_scope(V.extract_equations(synthetic_docs(spark, sf_dir), limit=2), "main"))


#: Equations of broken conversions with page text, and what replaces those that page text alone speaks for.
_PAGED = f"{D.markdown_cte('d_', D.lines_of(BROKEN))}, {D.page_cte('p_')}, eq AS MATERIALIZED (SELECT * FROM {D.chosen('(SELECT * FROM d_found UNION ALL SELECT * FROM p_page)')})"
_COLUMNS = "doc_id, number, latex, raw_latex, source, confidence, warnings, line_start, line_end, context, source_location, src_rank, emit_ord"
_NEW = "latex, raw_latex, source, confidence, warnings, line_start, line_end, context, source_location".split(", ")


def _replaced(new: str, last: str) -> str:
    own = ", ".join(f"CASE WHEN e.source = 'pymupdf_text_fallback' AND n.number IS NOT NULL THEN n.{c} ELSE e.{c} END AS {c}" for c in _NEW)
    return f"SELECT e.doc_id, e.number, {own}, e.src_rank, e.emit_ord{last} FROM eq e LEFT JOIN {new} n ON n.doc_id = e.doc_id AND n.number = e.number"


_ALT, _ONE = D.chosen("a_found"), D.chosen("s_found", 20)


def _alternative(lines: str) -> str:
    """CTEs up to ``both_``, the equations and the candidates of an alternative conversion."""
    return (
        f"{D.markdown_cte('a_', lines)}, new AS MATERIALIZED {D.described(f'(SELECT * REPLACE (replace(source, {chr(39)}docling_markdown_{chr(39)}, {chr(39)}pix2text_markdown_{chr(39)}) AS source, concat({chr(39)}Pix2Text fallback from {chr(39)}, source_location) AS source_location) FROM {_ALT})')}, "
        f"both_ AS ({_replaced('new', '')} UNION ALL SELECT {_COLUMNS.replace('src_rank', 'src_rank + 10')} FROM new n WHERE NOT EXISTS (SELECT 1 FROM eq e WHERE e.doc_id = n.doc_id AND e.number = n.number))"
    )


@query(f"WITH RECURSIVE {_PAGED} SELECT doc_id, page, CAST(nth AS INT) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY first) AS nth FROM (SELECT doc_id, CAST(regexp_extract(source_location, 'PDF page\\s+([0-9]+)', 1) AS INT) AS page, min(rank) AS first FROM eq WHERE source = 'pymupdf_text_fallback' GROUP BY ALL)) WHERE nth <= 2")
def fallback_pages(spark, sf_dir):
    return V.fallback_pages(page_equations(spark, sf_dir), 2)


@query(f"WITH RECURSIVE {_PAGED}, {_alternative(D.lines_of(MIDDLE))} SELECT * FROM {D.chosen('both_')}")
def alternative_replacement(spark, sf_dir):
    return flat(V.extract_with_alternative(synthetic_docs(spark, sf_dir, BROKEN), page_lines(spark, sf_dir), synthetic_docs(spark, sf_dir, MIDDLE)))


#: Single pages as documents of their own; only those that page text alone speaks for are converted again.
_RETRY = (
    f"asked AS (SELECT DISTINCT doc_id * 3 + CAST(regexp_extract(source_location, 'PDF page\\s+([0-9]+)', 1) AS INT) - 1 AS doc_id FROM eq WHERE source = 'pymupdf_text_fallback'), "
    f"{D.markdown_cte('s_', f'SELECT o.doc_id * 3 + o.line_no // 4 AS doc_id, o.line_no % 4 AS line_no, trim(o.whole) AS whole FROM ({D.lines_of()}) o WHERE o.doc_id * 3 + o.line_no // 4 IN (SELECT doc_id FROM asked)')}, "
    f"paged AS MATERIALIZED {D.described(f'(SELECT * REPLACE ({chr(39)}docling_page_retry_math_block{chr(39)} AS source, concat({chr(39)}Page retry from {chr(39)}, source_location) AS source_location) FROM {_ONE})')}, "
    f"latest AS (SELECT doc_id // 3 AS doc_id, * EXCLUDE (doc_id) FROM paged QUALIFY row_number() OVER (PARTITION BY doc_id // 3, number ORDER BY doc_id DESC) = 1)"
)


@query(f"WITH RECURSIVE {_PAGED}, {_RETRY} {_replaced('latest', ', e.rank')}")
def page_retry_replacement(spark, sf_dir):
    found = stored(page_equations(spark, sf_dir), "equations")
    return flat(V.replace_from_pages(found, V.page_candidates(page_docs(spark, sf_dir).join(V.retry_pages(found), ["doc_id", "page"], "left_semi"))))


_ASKED = f"SELECT * FROM ({D.lines_of(MIDDLE)}) WHERE doc_id IN (SELECT doc_id FROM eq0 WHERE source = 'pymupdf_text_fallback')"


@query(f"WITH RECURSIVE {_PAGED.replace('eq AS', 'eq0 AS')}, {_alternative(_ASKED).replace('eq e', 'eq0 e')}, eq AS MATERIALIZED (SELECT * FROM {D.chosen('both_')}), {_RETRY} SELECT * FROM ({_replaced('latest', ', e.rank')}) WHERE regexp_full_match(number, '[1-9][0-9]*(?:\\.[0-9]+)?')")
def whole_run(spark, sf_dir):
    """All stages with the alternative conversion of whichever pages are asked for."""
    options = W.Options(scope="main", alternative=True, alternative_pages=3)
    pages = [F.array(*[F.lit(n) for n in p]).cast("array<int>") for p in ([1], [2], [3], [1, 2], [2, 1], [1, 3], [3, 1], [2, 3], [3, 2], [1, 2, 3], [1, 3, 2], [2, 1, 3], [2, 3, 1], [3, 1, 2], [3, 2, 1])]
    other = synthetic_docs(spark, sf_dir, MIDDLE).select("doc_id", F.explode(F.array(*pages)).alias("pages"), "markdown")
    return flat(W.run(synthetic_docs(spark, sf_dir, BROKEN), options, page_lines(spark, sf_dir), other, page_docs(spark, sf_dir)))


_LABELLED = f"(SELECT DISTINCT doc_id, number FROM (SELECT doc_id, coalesce({TAG_DUCK}, {TRAIL_DUCK}) AS number FROM (SELECT *, {CANDIDATE_DUCK} AS t FROM {STRIPPED})) WHERE number IS NOT NULL)"


@query(f"SELECT a.doc_id, a.number AS src_label, b.number AS dst_label, 'none' AS grade, '' AS description FROM {_LABELLED} a JOIN {_LABELLED} b ON a.doc_id = b.doc_id AND a.number <> b.number")
def relation_edges(spark, sf_dir):
    return V.relations(line_label(spark, sf_dir).where("number is not null").select("doc_id", "number").distinct())


@query(f"SELECT doc_id, number, CAST(min(line_no) AS BIGINT) AS first_line FROM (SELECT doc_id, line_no, coalesce({TAG_DUCK}, {TRAIL_DUCK}) AS number FROM (SELECT *, {CANDIDATE_DUCK} AS t FROM {STRIPPED})) WHERE number IS NOT NULL GROUP BY ALL")
def first_per_label(spark, sf_dir):
    rows = line_label(spark, sf_dir).where("number is not null")
    whole = rows.select("doc_id", "number", *[F.lit(None).cast("string").alias(c) for c in E.COLUMNS if c not in ("doc_id", "number", "src_rank", "emit_ord")], F.lit(0).alias("src_rank"), F.col("line_no").alias("emit_ord"))
    return V.first_per_label(whole).select("doc_id", "number", F.col("emit_ord").alias("first_line"))


_TOTAL = f"{_MARKDOWN}, eq AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, list(number) OVER (PARTITION BY doc_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS labels FROM {D.chosen('d_found')})"
_TRAIL = ("download_pdf", "convert_with_docling", "extract_enumerated_equations", "extraction_confidence", "quality_warnings", "equation_location", "equation_raw", "normalize_equation", "context_window")


@query(
    f"""WITH {_TOTAL} SELECT o_orderkey AS doc_id, e.number, latex AS equation, '' AS meaning, '0' AS symbols, array_to_string(list_filter(labels, lambda x: x <> e.number), ',') AS relations,
 concat('Used arXiv PDF for arXiv:', o_orderkey) AS download_pdf, 'Converted PDF locally with Docling; status=unknown' AS convert_with_docling, concat('Selected equation ', rank, '/', n, ' from ', source) AS extract_enumerated_equations, confidence AS extraction_confidence,
 concat_ws(',', nullif(warnings, ''), nullif({D._listed(*D.LABEL_RULES)}, '')) AS quality_warnings, source_location AS equation_location, raw_latex AS equation_raw,
 'Applied conservative cleanup for LaTeX spacing, trailing layout markers, and visible equation labels.' AS normalize_equation, context AS context_window FROM orders JOIN eq e ON e.doc_id = o_orderkey
 UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, {', '.join(['NULL'] * 9)} FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM eq)"""
)
def dataset_entry(spark, sf_dir):
    """The records, a row each; a document without equations is one row of nulls."""
    entries = R.dataset(equations(spark, sf_dir), papers(spark, sf_dir)).select("doc_id", F.explode_outer("equations").alias("number", "r"))
    trail = [(F.concat_ws(",", F.col(f"r.audit-trail.{c}")) if c == "quality_warnings" else F.col(f"r.audit-trail.{c}")).alias(c) for c in _TRAIL]
    some = lambda c: F.when(F.col("number").isNotNull(), c)
    trail[4] = some(F.concat_ws(",", F.col("r.audit-trail.quality_warnings"))).alias("quality_warnings")
    relations = some(F.array_join(F.map_keys("r.relations"), ",")).alias("relations")
    return entries.select("doc_id", "number", F.col("r.equation").alias("equation"), F.col("r.meaning").alias("meaning"), some(F.size("r.symbols").cast("string")).alias("symbols"), relations, *trail)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))


_MAIN = "regexp_full_match(number, '[1-9][0-9]*(?:\\.[0-9]+)?')"
_ACTIONABLE = "nullif(array_to_string(list_filter(string_split(warned, ','), lambda w: w <> 'normalized_from_raw'), ','), '')"


def _labels(condition: str, value: str = "number") -> str:
    return f"coalesce(string_agg({value}, ',' ORDER BY rank) FILTER ({condition}), '')"


def _counted(column: str) -> str:
    return f"coalesce((SELECT string_agg(concat({column}, '=', n), ',' ORDER BY {column}) FROM (SELECT {column}, count(*) AS n FROM warned w WHERE w.doc_id = o_orderkey GROUP BY {column})), '')"


@query(
    f"""WITH {_TOTAL}, warned AS MATERIALIZED (SELECT *, {_ACTIONABLE} AS act FROM (SELECT *, concat_ws(',', nullif(warnings, ''), nullif({D._listed(*D.LABEL_RULES)}, '')) AS warned, {D._listed(*D.LABEL_RULES)} <> '' AS odd FROM eq))
 SELECT o_orderkey AS doc_id, CAST(count(number) AS INT) AS equation_count, {_labels('number IS NOT NULL')} AS equation_labels, CAST(count(number) FILTER ({_MAIN}) AS INT) AS main_equation_count, {_labels(_MAIN)} AS main_equation_labels,
 {_labels("confidence IN ('high', 'medium') AND act IS NULL")} AS clean_labels, 'unknown' AS docling_status, {_counted('confidence')} AS confidence_counts, {_counted('source')} AS source_counts,
 {_labels('number IS NOT NULL', "concat(number, '=', source)")} AS sources, {_labels('number IS NOT NULL', "concat(number, '=', confidence)")} AS confidence, {_labels("warned <> ''", "concat(number, '=', warned)")} AS quality_warnings,
 {_labels('odd')} AS suspicious_labels, {_labels("source = 'pymupdf_text_fallback'")} AS fallback_only_labels, {_labels("confidence = 'low' OR act IS NOT NULL")} AS needs_review,
 CAST(count(number) FILTER (source = 'pymupdf_text_fallback') AS INT) AS fallback_only_count, CAST(count(number) FILTER (odd) AS INT) AS suspicious_label_count, CAST(count(number) FILTER (contains(warned, 'needs_artifact_cleanup')) AS INT) AS artifact_cleanup_count
 FROM orders LEFT JOIN warned ON doc_id = o_orderkey GROUP BY o_orderkey"""
)
def validation_report(spark, sf_dir):
    """The reports; lists and maps in their order as text."""
    rows = R.validation(equations(spark, sf_dir), papers(spark, sf_dir))
    pairs = lambda c, value: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), value(e["value"]))), ",").alias(c)
    as_text = lambda v: v.cast("string")
    shown = {"confidence_counts": as_text, "source_counts": as_text, "sources": as_text, "confidence": as_text, "quality_warnings": lambda v: F.array_join(v, ",")}
    lists = ("equation_labels", "main_equation_labels", "clean_labels", "suspicious_labels", "fallback_only_labels", "needs_review")
    return rows.select("doc_id", "equation_count", "main_equation_count", "docling_status", *[F.array_join(c, ",").alias(c) for c in lists], *[pairs(c, f) for c, f in shown.items()], "review_summary.*")


@query(f"WITH {_MARKDOWN} SELECT doc_id, confidence, count(*) AS n FROM {D.chosen('d_found')} GROUP BY ALL")
def confidence_counts(spark, sf_dir):
    return R.counts(equations(spark, sf_dir), "confidence")


@query(f"WITH {_MARKDOWN} SELECT doc_id, source, count(*) AS n FROM {D.chosen('d_found')} GROUP BY ALL")
def source_counts(spark, sf_dir):
    return R.counts(equations(spark, sf_dir), "source")


@query("SELECT o_orderkey AS doc_id, o_totalprice AS value FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT c_custkey, c_acctbal FROM customer")
def upsert_merge(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_totalprice").alias("value"))
    return sinks.upsert(old, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.col("c_acctbal").alias("value")))


@query(
    "SELECT p_partkey, CASE WHEN p_size > 10 OR mb > 20 THEN 'cpu' ELSE 'gpu' END AS selected_device, CASE WHEN p_size > 10 OR mb > 20 THEN concat('auto_cpu_', concat_ws('_', CASE WHEN p_size > 10 THEN 'pages>10' END, CASE WHEN mb > 20 THEN 'size_mb>20' END)) ELSE 'auto_gpu_small_pdf' END AS device_reason "
    "FROM (SELECT p_partkey, p_size, p_retailprice * 16384 / 1048576 AS mb FROM part)"
)
def device_policy(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", L.device(F.col("p_size"), F.col("p_retailprice") * 16384).alias("d")).select("p_partkey", "d.selected_device", "d.device_reason")


@query("SELECT DISTINCT concat(p_brand, '_pages_', CASE WHEN p_size % 3 = 0 THEN 'all' ELSE concat(p_size, '_', p_size % 3) END, '.md') AS name FROM part")
def alternative_cache_name(spark, sf_dir):
    pages = F.when(F.col("p_size") % 3 == 0, F.array().cast("array<int>")).otherwise(F.array("p_size", F.col("p_size") % 3))
    return table(spark, sf_dir, "part").select(readers.alternative_name(F.col("p_brand"), pages).alias("name")).distinct()


@query("SELECT s AS source, CASE WHEN s IN ('docling_markdown_math_block', 'docling_page_retry_math_block') THEN 'high' WHEN starts_with(s, 'pix2text_markdown_') OR s IN ('docling_markdown_numbered_line', 'docling_markdown_neighbor_reference') THEN 'medium' ELSE 'low' END AS confidence FROM (SELECT unnest(['docling_markdown_math_block', 'docling_page_retry_math_block', 'pix2text_markdown_math_block', 'docling_markdown_numbered_line', 'docling_markdown_neighbor_reference', 'pymupdf_text_fallback', 'other']) AS s)")
def source_confidence(spark, sf_dir):
    names = [P.MATH_BLOCK, P.PAGE_RETRY, P.ALTERNATIVE[P.MATH_BLOCK], P.NUMBERED_LINE, P.NEIGHBOR, P.PAGE_TEXT, "other"]
    return spark.createDataFrame([(n,) for n in names], "source string").withColumn("confidence", L.confidence(F.col("source")))
