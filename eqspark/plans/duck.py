"""The extraction in DuckDB's SQL, for the registered queries' oracles.

Fragments are text: a function takes the name of an expression and returns one, or takes a relation and
returns a relation with further columns. The dialect has no look-around, so what stands before or behind
a match is matched and put back; white space and word characters are the ASCII ones, as in the data.
"""

from __future__ import annotations

from .synthetic import LINE

BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
LABEL = r"[A-Za-z]?\s*[0-9]+(?:\.[0-9]+)?\s*[a-z]?"
SIGNAL = r"\\[A-Za-z]+|[=+\-*/^_<>]|\b(?:psi|phi|rho|sigma|lambda|omega|theta|hat|ket|bra)\b"
STRONG = r"=|\\(?:frac|sum|int|prod|lim|begin\{(?:array|matrix|pmatrix|bmatrix)|le|ge|neq|approx|in|to|rightarrow|leftarrow)\b|\b(?:lim|arg\s*min|arg\s*max)\b"
CUE = r"(?i)\b(?:according|ancilla|figure|implementation|resulting|controlled|respectively|where|describes|represents|shown|given|using|between|register)\b"
TRAILING = rf"(^|[^\w.])\(\s*(?:{LABEL})\s*\)\s*$"
EMBEDDED = rf"(?:\\quad|,|\\\s+)\s*(?:\\left\s*)?\(\s*({LABEL})\s*(?:\\right\s*)?\)"
SPACED = rf"\(\s*({LABEL})\s*\)"
PAGE_LABEL = r"[1-9][0-9]*(?:\.[0-9]+)?[a-z]?"
SPLIT = r"'\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]'"


def replace(t: str, pattern: str, put: str = "", everywhere: bool = True) -> str:
    return f"regexp_replace({t}, '{pattern}', '{put}'{', ' + chr(39) + 'g' + chr(39) if everywhere else ''})"


def trim(t: str) -> str:
    return f"trim({t}, {BLANK})"


def normalized(t: str) -> str:
    out = trim(replace(trim(t), "^```(?i:math|latex)?", everywhere=False))
    for front, back in ((None, "```$"), (r"^\$\$", r"\$\$$"), (r"^\\\[", r"\\\]$")):
        out = trim(replace(replace(out, front, everywhere=False) if front else out, back, everywhere=False))
    return replace(trim(replace(out, r"\\tag\{[^{}]+\}")), r"\s+", " ")


def _last(pattern: str, late: bool) -> str:
    whole, inner, parts = f"regexp_extract_all(t_, '{pattern}', 0)", f"regexp_extract_all(t_, '{pattern}', 1)", f"string_split_regex(t_, '{pattern}')"
    size = lambda items: f"coalesce(list_sum(list_transform({items}, lambda q: length(q))), 0)"
    begin = f"CAST({size(f'({parts})[1:k]')} + {size(f'({whole})[1:k - 1]')} AS BIGINT)"
    found = f"list_transform(range(1, len({whole}) + 1), lambda k: {{'at': {begin}, 'label': ({inner})[k]}})"
    good = "NOT contains(substring(t_, greatest(x.at - 8, 0) + 1, least(x.at, 8)), '^')" + (" AND x.at > floor(length(t_) * 0.65)" if late else "")
    return f"list_filter({found}, lambda x: {good})[-1].label"


def with_number(relation: str, text: str, name: str, embedded: bool = False) -> str:
    t = trim(replace(replace(replace(trim(text), r"\$\$$", everywhere=False), r"\\\]$", everywhere=False), "```$", everywhere=False))
    ways = [r"nullif(regexp_extract(t_, '\\tag\{([^{}]+)\}', 1), '')", rf"nullif(regexp_extract(t_, '(?:^|[^\w.])\(\s*({LABEL})\s*\)\s*$', 1), '')"]
    ways += [_last(EMBEDDED, False), _last(SPACED, True)] if embedded else []
    found = replace(f"coalesce({', '.join(ways)})", r"\s+")
    return f"(SELECT * EXCLUDE (t_), {found} AS {name} FROM (SELECT *, {t} AS t_ FROM {relation}))"


def stripped_number(t: str, number: str | None = None) -> str:
    """``t`` and ``number`` must be names of columns."""
    closing = r"(\$\$|\\\]|```)$"
    out = trim(replace(trim(replace(trim(t), closing, everywhere=False)), TRAILING, r"\1", everywhere=False))
    if number is not None:
        spaced = rf"array_to_string(list_transform(string_split({number}, ''), lambda c: regexp_escape(c)), '\s*')"
        label = rf"'(?:\\left\s*)?\(\s*' || {spaced} || '\s*(?:\\right\s*)?\)"
        plain = out
        out = trim(rf"regexp_replace({out}, '(?:\\qquad|\\quad|,\s*|\s{{2,}})\s*' || {label}.*$', '')")
        out = trim(rf"regexp_replace({out}, '(?:\\quad|,|\\\s+)?\s*' || {label}\s*(?:\\quad)?\s*((?:\s*\}})?\s*\\end\{{array\}}|(?:\s*\\\s*){{4,}}|\s*$)', '\1', 'g')")
        out = f"CASE WHEN {number} IS NULL THEN {plain} ELSE {trim(replace(out, r'(?:\\\s*){4,}$', everywhere=False))} END"
    return trim(f"concat({out}, regexp_extract({trim(t)}, '{closing}', 1))")


#: The cleaning rules of the reported form: pattern, replacement, whether to trim.
RULES = (
    (r"^\\begin\{array\}\s*\{[^{}]*\}\s*(.*?)\s*\\end\{array\}$", r"\1", True), (r"^\{\s*(?:[A-Za-z]\s+)+[A-Za-z]\s*\}\s*&\s*", "", True),
    (r"\\mathbf\s*\{\s*i\s*\}", r"\\mathrm{i}", False), (r"\\mathbf\s+i\b", r"\\mathrm{i}", False), (r"(?:\\quad|\\qquad|\\,|;|\\:|\s)+$", "", True),
    (r"(?:\\\s*){2,}$", "", True), (r"(^|[^\\])[,.]\s*$", r"\1", True), (r"\\frac\s*\{\s*([^{}]+?)\s*\}\s*\{\s*([^{}]+?)\s*\}", r"\\frac{\1}{\2}", False),
    (r"\{\s+\}", "{}", False), (r"\{\s*([^{}]+?)\s*\}", r"{\1}", False), (r"_\s*\{\s*([^{}]+?)\s*\}", r"_{\1}", False), (r"\^\s*\{\s*([^{}]+?)\s*\}", r"^{\1}", False),
    (r"\s+([_^])", r"\1", False), (r"([_^])\s+", r"\1", False), (r"\\([A-Za-z]+)\s+(\{)", r"\\\1\2", False), (r"\s+", " ", True), (r"(?:\\quad|\\qquad|\\,|;|\\:|\\\s*)+$", "", True),
)


def output_form(t: str) -> str:
    """``t`` must be the name of a column."""
    out = stripped_number(t)
    for pattern, put, trimmed in RULES:
        out = replace(out, pattern, put)
        out = trim(out) if trimmed else out
    return out


def matches(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, '{pattern}')"


def _listed(*rules: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{name}' END" for c, name in rules) + ")"


QUALITY = (
    ("source = 'docling_page_retry_math_block'", "page_retry_replaced_fallback"), ("starts_with(source, 'pix2text_markdown_')", "pix2text_fallback_replaced_pymupdf"),
    ("source IN ('docling_markdown_neighbor_reference', 'pix2text_markdown_neighbor_reference')", "label_inferred_from_nearby_prose"),
    ("source = 'pymupdf_text_fallback'", "fallback_only_needs_review"), ("source = 'pymupdf_text_fallback'", "pymupdf_text_is_recall_signal_not_trusted_latex"),
    (matches("latex", r"(?i)\b(?:where|Megahertz|cients|coeffi|respectively|Fig)\b"), "possible_prose_contamination"),
    (matches("latex", r"\b(?:X\s+[a-z]|ħ\(|[0-9]+i\\beta|\\kappaT LS|\\sqrt\\[A-Za-z])"), "possible_pdf_text_degradation"),
    (r"contains(raw_latex, '\begin{array}') OR " + matches("raw_latex", r"^\s*\{\s*(?:[A-Za-z]\s+)+[A-Za-z]\s*\}\s*&"), "needs_artifact_cleanup"), ("raw_latex <> latex", "normalized_from_raw"),
)
LABEL_RULES = (("number = '0'", "suspicious_zero_equation_label"), (matches("number", "^[A-Za-z][0-9]"), "appendix_or_supplement_label"), (matches("number", "^[0-9]+[A-Za-z]"), "suspicious_alphanumeric_equation_label"))
CONFIDENCE = "CASE WHEN source IN ('docling_markdown_math_block', 'docling_page_retry_math_block') THEN 'high' WHEN starts_with(source, 'pix2text_markdown_') OR source IN ('docling_markdown_numbered_line', 'docling_markdown_neighbor_reference') THEN 'medium' ELSE 'low' END"


def described(relation: str, more: str = "''") -> str:
    """Candidates with what follows from source, latex and raw_latex."""
    return f"(SELECT doc_id, number, latex, raw_latex, source, {CONFIDENCE} AS confidence, concat_ws(',', nullif({_listed(*QUALITY)}, ''), nullif({more}, '')) AS warnings, line_start, line_end, context, source_location, src_rank, emit_ord FROM {relation})"


def lines_of(kept: str = "true") -> str:
    """Lines of the synthetic documents; those that ``kept`` doesn't hold for were lost: they are empty."""
    return f"SELECT o_orderkey AS doc_id, i AS line_no, CASE WHEN {kept} THEN {LINE} ELSE '' END AS whole FROM (SELECT o_orderkey, unnest(range(0, 12)) AS i FROM orders)"


def text_lines(text: str, table: str = "documents") -> str:
    return f"SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS whole FROM (SELECT doc_id, string_split_regex({text}, {SPLIT}) AS l FROM {table})"


def lines_cte(p: str, source: str) -> str:
    """``{p}lines``: without an empty last line; with the trimmed text."""
    return (
        f"{p}all AS ({source}), {p}lines AS (SELECT doc_id, line_no, whole, {trim('whole')} AS text FROM (SELECT *, max(line_no) OVER (PARTITION BY doc_id) AS last_ FROM {p}all) WHERE NOT (line_no = last_ AND whole = ''))"
    )


REFERENCE = (
    r"CASE WHEN text <> '' AND NOT starts_with(text, '$$') THEN CASE WHEN len(regexp_extract_all(text, '\b[Ee]q\.?\s*\(?\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)?', 1)) = 1 "
    r"THEN regexp_extract_all(text, '\b[Ee]q\.?\s*\(?\s*([1-9][0-9]*(?:\.[0-9]+)?[a-z]?)\s*\)?', 1)[1] WHEN len(regexp_extract_all(text, '\(\s*([1-9][0-9]?\.[0-9]{1,3})\s*\)', 1)) = 1 THEN regexp_extract_all(text, '\(\s*([1-9][0-9]?\.[0-9]{1,3})\s*\)', 1)[1] END END"
)


def markdown_cte(p: str, source: str) -> str:
    """CTEs ``{p}math``, ``{p}numbered``, ``{p}near`` and ``{p}found`` (their union) over lines from ``source``."""
    beg = r"(starts_with(text, '$$') OR starts_with(text, '\[') OR starts_with(text, '```math'))"
    fin, shut = r"(ends_with(text, '$$') OR ends_with(text, '\]'))", r"(ends_with(text, '$$') OR ends_with(text, '\]') OR text = '```')"
    before = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    near = f"(line_no BETWEEN e + 1 AND e + 4 OR line_no BETWEEN s - 4 AND s - 1)"
    place = "CAST(s + 1 AS INT) AS line_start, CAST(e + 1 AS INT) AS line_end"
    at = "concat('Docling Markdown lines ', line_start, '-', line_end)"
    context = lambda low, high: f"coalesce(left(string_agg(l.text, ' ' ORDER BY l.line_no) FILTER (l.text <> '' AND l.line_no BETWEEN {low} AND {high}), 500), '')"
    return f"""{lines_cte(p, source)},
{p}seg AS (SELECT doc_id, line_no AS s, CASE WHEN fin THEN line_no ELSE coalesce(nxt, n) END AS e, fin FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n,
  coalesce(last_value(mark IGNORE NULLS) {before}, 0) AS state, first_value(CASE WHEN shut THEN line_no END IGNORE NULLS) {after} AS nxt
  FROM (SELECT *, CASE WHEN beg AND NOT fin THEN 1 WHEN shut THEN 0 END AS mark FROM (SELECT *, {beg} AS beg, {fin} AS fin, {shut} AS shut FROM {p}lines))) WHERE state = 0 AND beg),
{p}simple AS MATERIALIZED (SELECT * FROM {with_number(f"(SELECT *, {REFERENCE} AS ref FROM {p}lines)", "whole", "label")}),
{p}blk AS (SELECT b.doc_id, s, e, any_value(fin) AS fin, CAST(row_number() OVER (PARTITION BY b.doc_id ORDER BY s) - 1 AS INT) AS emit_ord, string_agg(l.whole, chr(10) ORDER BY l.line_no) FILTER (l.line_no BETWEEN s AND e) AS raw,
  {context('s - 2', 'e + 2')} AS context, max(l.label) FILTER (l.line_no = e + 1) AS behind, max(l.label) FILTER (l.line_no = s - 1) AS ahead,
  arg_min(l.ref, CASE WHEN l.line_no > e THEN l.line_no - e ELSE 100 + s - l.line_no END) FILTER (l.ref IS NOT NULL AND {near}) AS ref
  FROM {p}seg b JOIN {p}simple l ON l.doc_id = b.doc_id AND l.line_no BETWEEN s - 4 AND e + 4 GROUP BY b.doc_id, s, e),
{p}own AS MATERIALIZED (SELECT * FROM {with_number(f"{p}blk", "raw", "own", True)}),
{p}math AS {described(f"(SELECT *, {at} AS source_location FROM (SELECT *, {output_form('raw_latex')} AS latex, 'docling_markdown_math_block' AS source, 0 AS src_rank, {place} FROM (SELECT *, {stripped_number('norm', 'number')} AS raw_latex FROM (SELECT *, {normalized('raw')} AS norm, coalesce(own, CASE WHEN e > s OR NOT fin THEN coalesce(behind, ahead) END) AS number FROM {p}own) WHERE number IS NOT NULL)) WHERE latex <> '')")},
{p}near AS {described(f"(SELECT *, concat({at}, '; label inferred from nearby Eq. ', number, ' reference') AS source_location FROM (SELECT *, {output_form('raw_latex')} AS latex, ref AS number, 'docling_markdown_neighbor_reference' AS source, 2 AS src_rank, {place} FROM (SELECT *, {normalized('raw')} AS raw_latex FROM {p}own WHERE own IS NULL AND ref IS NOT NULL) WHERE {matches('raw_latex', SIGNAL)}))")},
{p}pair AS MATERIALIZED (SELECT *, CASE WHEN back THEN prev ELSE own END AS equation, line_no - CAST(back AS INT) AS s FROM (SELECT *, NOT {matches('own', SIGNAL)} AND coalesce({matches('prev', SIGNAL)}, false) AS back FROM (SELECT doc_id, line_no, prev, label AS number, {stripped_number('text', 'label')} AS own
  FROM (SELECT *, lag(text) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev FROM {p}simple) WHERE length(text) <= 500 AND label IS NOT NULL))),
{p}numbered AS {described(f"(SELECT *, {at} AS source_location FROM (SELECT *, {output_form('raw_latex')} AS latex FROM (SELECT q.doc_id, q.number, {normalized('q.equation')} AS raw_latex, 'docling_markdown_numbered_line' AS source, 1 AS src_rank, CAST(q.s + 1 AS INT) AS line_start, CAST(q.line_no + 1 AS INT) AS line_end, CAST(q.line_no AS INT) AS emit_ord, {context('q.s - 2', 'q.line_no + 2')} AS context FROM {p}pair q JOIN {p}lines l ON l.doc_id = q.doc_id AND l.line_no BETWEEN q.s - 2 AND q.line_no + 2 WHERE {matches('q.equation', SIGNAL)} GROUP BY q.doc_id, q.number, q.equation, q.s, q.line_no)))")},
{p}found AS (SELECT * FROM {p}math UNION ALL SELECT * FROM {p}numbered UNION ALL SELECT * FROM {p}near)"""


SORT_KEY = (
    "CASE WHEN regexp_matches(number, '^[A-Za-z][0-9]') THEN 1 WHEN regexp_matches(number, '^[0-9]') THEN 0 ELSE 2 END, CASE WHEN regexp_matches(number, '^[A-Za-z]?[0-9]') THEN CAST(regexp_extract(number, '^[A-Za-z]?([0-9]+)', 1) AS HUGEINT) ELSE 0 END, "
    r"CASE WHEN regexp_full_match(number, '[0-9]+\.[0-9]+') THEN lpad(regexp_replace(regexp_extract(number, '\.([0-9]+)', 1), '^0+', ''), 6, '0') WHEN regexp_matches(number, '^[A-Za-z]?[0-9]') THEN regexp_extract(number, '^[A-Za-z]?[0-9]+(.*)', 1) ELSE number END"
)


def chosen(relation: str, limit: int = 200) -> str:
    """The first candidate of each label, in the order of labels."""
    first = f"(SELECT * FROM {relation} QUALIFY row_number() OVER (PARTITION BY doc_id, number ORDER BY src_rank, emit_ord) = 1)"
    return f"(SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY {SORT_KEY}, src_rank, emit_ord) AS INT) AS rank FROM {first}) WHERE rank <= {limit})"


def page_cte(p: str, strict: bool = False) -> str:
    """CTE ``{p}page``: candidates from the synthetic lines as page lines, four to a page.
    The walk back goes from a label's line, or from the last fragment before it, to the last line that stops it."""
    words, marks = r"len(regexp_extract_all(text, '\b[a-zA-Z]{4,}\b'))", lambda c: f"len(regexp_extract_all(text, '[{c}]'))"
    warnings = (("words > 8", "fallback_candidate_has_many_prose_words"), (f"NOT {matches('text', STRONG)}", "fallback_candidate_has_weak_equation_structure"), (f"{matches('text', CUE)} AND words > 4", "fallback_candidate_contains_prose_cue"))
    usable = f"text <> '' AND {matches('text', SIGNAL)} AND NOT (words > 12 AND NOT {matches('text', STRONG)}) AND NOT ({matches('text', CUE)} AND words > 8 AND {marks('=+' + chr(92) + '-*/^_<>|')} < 4)"
    usable += f" AND {_listed(*warnings)} = ''" if strict else ""
    trailing = rf"\(\s*({PAGE_LABEL})\s*\)\s*$"
    facts = rf"""SELECT doc_id, line_no AS i, text, CASE WHEN stop OR regexp_matches(text, '\[[0-9]+(?:,\s*[0-9]+)*\]') OR (length(text) > 160 AND NOT sig) OR (words > 3 AND {marks('=+*/^_|')} = 0) THEN false
  WHEN sig AND (marks >= 2 OR words <= 6) THEN true ELSE regexp_full_match(text, '[\w\s\\{{}}()\[\].,|+\-*/^_=<>]+') AND marks >= 3 END AS fragment,
  NOT stop AND length(text) <= 35 AND words <= 1 AND regexp_matches(text, '[\w|()\[\]{{}}+\-*/^_=<>]') AS goes_on, regexp_matches(text, '{trailing}') AS labelled, regexp_matches(text, '^\s*\(\s*({PAGE_LABEL})\s*\)\s*$') AS alone,
  CASE WHEN regexp_matches(text, '^\s*\(\s*({PAGE_LABEL})\s*\)\s*$') OR sig THEN nullif(regexp_extract(text, '{trailing}', 1), '') END AS number
  FROM (SELECT *, {matches('text', SIGNAL)} AS sig, regexp_matches(text, '(?i)\b(?:Eq|Fig|where|giving|respectively|represents|describes)\b') OR text = '' AS stop, {words} AS words, {marks('=+' + chr(92) + '-*/^_()|')} AS marks FROM {p}plines)"""
    glyphed = trim(replace("text", r"\s+", " "))
    return f"""{p}plines AS MATERIALIZED (SELECT doc_id, line_no, {trim('whole')} AS text FROM ({lines_of()})),
{p}facts AS MATERIALIZED ({facts}),
{p}back AS MATERIALIZED (SELECT *, max(CASE WHEN fragment THEN i END) OVER before AS last_fragment, max(CASE WHEN labelled OR NOT (fragment OR goes_on) THEN i END) OVER before AS last_stop
  FROM {p}facts WINDOW before AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{p}base AS MATERIALIZED (SELECT *, CASE WHEN NOT alone THEN i WHEN last_fragment >= i - 15 THEN last_fragment END AS b FROM {p}back WHERE number IS NOT NULL),
{p}span AS MATERIALIZED (SELECT m.doc_id, m.i, m.alone, m.text AS own, CASE WHEN m.b IS NULL THEN greatest(m.i - 1, 0) ELSE greatest(coalesce(f.last_stop, -1) + 1, m.i - 15) END AS start, CASE WHEN m.b IS NULL THEN greatest(m.i - 1, 0) WHEN m.alone THEN m.b ELSE m.i - 1 END AS stop
  FROM {p}base m LEFT JOIN {p}back f ON f.doc_id = m.doc_id AND f.i = m.b),
{p}win AS MATERIALIZED (SELECT m.doc_id, m.i, m.start, concat_ws(' ', string_agg(l.text, ' ' ORDER BY l.line_no) FILTER (l.text <> '' AND l.line_no < m.i), CASE WHEN NOT m.alone THEN nullif({trim(f"regexp_replace(m.own, '{trailing}', '')")}, '') END) AS text
  FROM {p}span m LEFT JOIN {p}plines l ON l.doc_id = m.doc_id AND l.line_no BETWEEN m.start AND m.stop GROUP BY m.doc_id, m.i, m.start, m.alone, m.own),
{p}kept AS MATERIALIZED (SELECT w.doc_id, w.i, w.start, f.number, w.text AS collected FROM (SELECT *, {words} AS words FROM {p}win) w JOIN {p}facts f ON f.doc_id = w.doc_id AND f.i = w.i WHERE {usable.replace('text', 'w.text')}),
{p}bare AS MATERIALIZED (SELECT *, {trim(r"regexp_replace(collected, '\(\s*' || regexp_escape(number) || '\s*\)\s*$', '')")} AS text FROM {p}kept),
{p}near AS MATERIALIZED (SELECT b.doc_id, b.i, b.start, b.number, b.text, left(string_agg(l.text, ' ' ORDER BY l.line_no), 500) AS context FROM {p}bare b JOIN {p}plines l ON l.doc_id = b.doc_id AND l.line_no BETWEEN b.start - 2 AND b.i + 2 GROUP BY ALL),
{p}page AS {described(f'''(SELECT *, {words} AS words FROM (SELECT *, {output_form('raw_latex')} AS latex, 'pymupdf_text_fallback' AS source, 3 AS src_rank, CAST(start + 1 AS INT) AS line_start, CAST(i + 1 AS INT) AS line_end, CAST(i AS INT) AS emit_ord,
  concat('PDF page ', i // 4 + 1, ', text lines ', start % 4 + 1, '-', i % 4 + 1) AS source_location FROM (SELECT *, {glyphed} AS raw_latex FROM {p}near)) WHERE latex <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 200)''', _listed(*warnings))}"""
