"""Scalar rules, segmentation and extractors on small cases."""

import random

import pytest
from eqspark.functions import labels as L
from eqspark.functions import latex as X
from eqspark.functions import patterns as P
from eqspark.functions.text import lines, nfkc, strip
from eqspark.operators import blocks as B
from eqspark.operators import extract as E
from eqspark.operators import report as R
from eqspark.operators import resolve as V
from eqspark.operators import whole as W
from eqspark.sources import readers, sinks
from pyspark.sql import functions as F


def column(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.coalesce(1).orderBy("i").select(expression(F.col("t"))).collect()]


CASES = [
    (lambda t: X.number_of(t), ["x \\quad ( 1 a )", "x ( 1 2 )", "f(2)", "v.(3)", "a (A 2)", "a ( 2 . 3 )", "a (2.3)", "a (1).", "D 103(7):075002 (2021)", "x \\tag{ 3 b } y", "q ( 4 )$$", None],
     ["1a", None, None, None, "A2", None, "2.3", None, "2021", "3b", "4", None]),
    (lambda t: X.number_of(t, embedded=True), ["$$x = y \\quad ( 3 ) \\quad z + w$$", "$$P^{(1)} = q$$", "$$a = b , ( 2 ) c , ( 5 ) d$$", "$$aaaaaaaaaaaaaaaaaaaaaaaa ( 7 ) }$$"], ["3", None, "5", "7"]),
    (lambda t: F.array_join(F.regexp_extract_all(t, F.lit(P.PROSE_REFERENCE), 1), ","), ["Eq. 3 and Eq. (4)", "Eqs. (3)", "eq3", "see Eq. (12b).", "Equation 5", "Eq. (A1)"], ["3,4", "", "3", "12b", "", ""]),
    (lambda t: t.rlike(P.MATH_SIGNAL), ["state-of-the-art", "Phys. Rev. D 103(7):075002", "$$", "αβ", "the ket"], [True, False, False, True, True]),
    (lambda t: t.rlike(P.STRONG_SIGNAL), ["\\le x", "\\left", "\\in x", "\\infty", "arg  min"], [True, False, True, False, True]),
    (lambda t: F.array_join(lines(t), "|"), ["a\r\nb\x0bc d\n", "", "\n", "a\n\nb", "a b\x85c"], ["a|b|c d", "", "", "a||b", "a|b|c"]),
    (strip, ["\x1c  a b　\n", "x"], ["a b", "x"]),
    (nfkc, ["ﬁ ℏ ½", "plain", None], ["fi ħ 1⁄2", "plain", None]),
    (X.normalize_latex, ["```math x = 1 ```", "$$ a \\tag{3}  b $$", "\\[ c \\]", "$$"], ["x = 1", "a b", "c", ""]),
    (X.output_form, ["{   } { a b  }", "S _ { a } ^ 2 , ", "\\frac { a } { b }", "\\mathbf { i } x .", "\\hat { q } \\quad", "\\begin{array} { l } x = y \\end{array}", "x \\; \\,", "a \\\\ \\\\"],
     ["{} {a b}", "S_{a}^2", "\\frac{a}{b}", "\\mathrm{i} x", "\\hat{q}", "x = y", "x", "a"]),
    (lambda t: X.strip_number(t, F.lit("1")), ["a = b , \\quad ( 1 ) \\quad \\begin{matrix}", "$$x ( 1 )$$"], ["a = b ,", "$$x$$"]),
    (L.is_main, ["1", "10.2", "0", "A1", "1a", "1\n"], [True, True, False, False, False, False]),
    (lambda t: F.array_join(L.label_warnings(t), ","), ["0", "A1", "1a", "12"], ["suspicious_zero_equation_label", "appendix_or_supplement_label", "suspicious_alphanumeric_equation_label", ""]),
    (lambda t: L.page_label(t)["number"], ["( 3 )", "x = y (4b)", "words only (5)", "(A1)"], ["3", "4b", None, None]),
    (L.is_page_fragment, ["", "see Fig 2 = x", "a = b + c", "we cite [1, 2] = x", "these words have nothing here", "x|y|z(1)"], [False, False, True, False, False, True]),
    (L.is_page_continuation, ["", "x" * 36, "ab", "where", "!!"], [False, False, True, False, False]),
    (X.glyphs_to_latex, ["α ≤ β", "∑ x − 1"], ["\\alpha \\le \\beta", "\\sum x - 1"]),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_scalar_rules(spark, number):
    expression, values, want = CASES[number]
    assert column(spark, expression, values) == want


def test_label_order(spark):
    names = "2,10,1a,1,1.2,1.10,A1,S8,B1,A10,x,2.1".split(",")
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, t string").orderBy(L.sort_key(F.col("t")), "i")
    assert [r.t for r in rows.collect()] == "1,1.2,1.10,1a,2,2.1,10,A1,B1,S8,A10,x".split(",")


def test_segmentation_against_a_loop(spark):
    r, tokens = random.Random(4), ["$$", "$$a$$", "$$a", "b$$", "x", "", "```math", "```", "\\[", "\\]", "\\[q\\]", "  $$c  "]
    docs = [(i, "\n".join(r.choice(tokens) for _ in range(r.randint(0, 14)))) for i in range(400)]
    want = set()
    for i, text in docs:
        own = text.split("\n")
        own = own[:-1] if own[-1] == "" else own
        own, at = [t.strip() for t in own], 0
        while at < len(own):
            if own[at].startswith(("$$", "\\[", "```math")):
                end = at
                if not own[at].endswith(("$$", "\\]")):
                    end = next((k for k in range(at + 1, len(own)) if own[k].endswith(("$$", "\\]")) or own[k] == "```"), len(own))
                want.add((i, at, end))
                at = end
            at += 1
    got = B.blocks(spark.createDataFrame(docs, "doc_id int, markdown string"))
    assert {(b.doc_id, b.start, b.end) for b in got.collect()} == want


DOC = """Intro text
$$E = m c ^ { 2 } \\quad ( 1 )$$
Then Eq. (7) follows
$$a = b$$
more
$$
x = y \\tag{3}
$$
words ( 2 )
Smith - Jones (2019)
$$\\begin{array} { l } q = k , ( 2 . 1 ) \\end{array}$$
$$z = w
( A 4 )$$"""


def test_extraction_of_a_document(spark):
    docs = spark.createDataFrame([("d", DOC), ("none", "text"), ("null", None)], "doc_id string, markdown string")
    found = V.extract_equations(docs).orderBy("rank").collect()
    assert [(e.number, e.latex, e.source.rsplit("_", 2)[-2:], e.line_start, e.line_end) for e in found] == [
        ("1", "E = m c^{2}", ["math", "block"], 2, 2), ("3", "x = y", ["numbered", "line"], 7, 7), ("7", "a = b", ["neighbor", "reference"], 4, 4),
        ("2019", "Smith - Jones", ["numbered", "line"], 10, 10), ("A4", "z = w", ["math", "block"], 12, 13),
    ]
    report = {r.doc_id: r for r in R.validation(V.extract_equations(docs), docs).collect()}
    assert report["none"].equation_count == 0 and report["none"].confidence_counts == {} and report["null"].needs_review == []
    d = report["d"]
    assert d.equation_labels == ["1", "3", "7", "2019", "A4"] and d.confidence_counts == {"high": 2, "medium": 3} and sum(d.source_counts.values()) == 5
    assert not set(d.clean_labels) & set(d.needs_review) and d.suspicious_labels == ["A4"]
    entries = {r.doc_id: r.equations for r in R.dataset(V.extract_equations(docs), docs).collect()}
    assert set(entries) == {"d", "none", "null"} and entries["none"] == entries["null"] == {}
    entry = entries["d"]
    assert all(len(e["relations"]) == 4 for e in entry.values()) and entry["3"]["audit-trail"]["extract_enumerated_equations"].startswith("Selected equation 2/5")
    for column in ("confidence", "source"):
        counted = {(r.doc_id, r[column]): r.n for r in R.counts(V.extract_equations(docs), column).collect()}
        assert counted == {("d", k): sum(e[column] == k for e in found) for k in {e[column] for e in found}}
    assert V.extract_equations(docs, limit=2).count() == 2


PAGE = ["Title of the text", "x + y", "= z / w", "( 1 )", "as shown by others it is", "q = r + s (2)", "α ≤ 1", "(3)"]


def test_page_text_and_replacement(spark):
    rows = [("d", t, i // 4 + 1, i % 4 + 1, i + 1) for i, t in enumerate(PAGE)]
    pages = spark.createDataFrame(rows, readers.PAGE_LINES)
    found = E.page_text(pages).orderBy("emit_ord").collect()
    assert [(e.number, e.raw_latex, e.line_start, e.source_location) for e in found] == [
        ("1", "x + y = z / w", 2, "PDF page 1, text lines 2-4"), ("2", "q = r + s", 6, "PDF page 2, text lines 2-2"), ("3", "\\alpha \\le 1", 7, "PDF page 2, text lines 3-4"),
    ]
    assert E.page_text(pages, limit=1).count() == 1
    docs = spark.createDataFrame([("d", "$$u = v ( 9 )$$")], "doc_id string, markdown string")
    equations = V.extract_equations(docs, page_lines=pages)
    assert [(r.page, r.nth) for r in V.fallback_pages(equations).orderBy("nth").collect()] == [(1, 1), (2, 2)]
    other = V.extract_equations(spark.createDataFrame([("d", "$$n = e + w ( 2 )$$\n$$k = l ( 5 )$$\n$$no = t ( 9 )$$")], "doc_id string, markdown string"))
    after = {e.number: e for e in V.replace_from_alternative(equations, other).collect()}
    assert {n: e.latex for n, e in after.items()} == {"1": "x + y = z / w", "2": "n = e + w", "3": "\\alpha \\le 1", "5": "k = l", "9": "u = v"}
    assert after["2"].source == "pix2text_markdown_math_block" and after["2"].confidence == "medium"
    paged = spark.createDataFrame([("d", 1, "$$first = 1 ( 1 )$$"), ("d", 2, "$$last = 1 ( 1 )$$\n$$new = 6 ( 6 )$$")], "doc_id string, page int, markdown string")
    after = {e.number: e for e in V.replace_from_pages(equations, V.page_candidates(paged)).collect()}
    assert set(after) == {"1", "2", "3", "9"} and after["1"].latex == "last = 1" and after["1"].confidence == "high"


def test_device(spark):
    rows = spark.createDataFrame([(3, 1 << 20), (11, 1 << 20), (None, 30 << 20), (11, 30 << 20)], "p int, b long")
    got = [tuple(r[0]) for r in rows.coalesce(1).select(L.device(F.col("p"), F.col("b"))).collect()]
    assert got == [("gpu", "auto_gpu_small_pdf", 1.0), ("cpu", "auto_cpu_pages>10", 1.0), ("cpu", "auto_cpu_size_mb>20", 30.0), ("cpu", "auto_cpu_pages>10_size_mb>20", 30.0)]
    with pytest.raises(ValueError):
        L.device(F.col("p"), F.col("b"), policy="x")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "list.txt").write_text(" arXiv:2401.1 \n\n2402.2\n", encoding="utf-8")
    papers = readers.paper_list(spark, str(tmp_path / "list.txt"))
    assert [tuple(r) for r in papers.orderBy("paper_number").collect()] == [(1, "2401.1"), (2, "2402.2")] and readers.select_paper(papers, 2) == "2402.2"
    with pytest.raises(ValueError):
        readers.select_paper(papers, 3)
    (tmp_path / "md").mkdir()
    for name in ("b", "a"):
        (tmp_path / "md" / f"{name}.md").write_text(f"text {name}", encoding="utf-8")
    assert {(r.doc_id, r.markdown_chars) for r in readers.markdown(spark, str(tmp_path / "md")).collect()} == {("a", 6), ("b", 6)}
    (tmp_path / "md" / "one" / "deep").mkdir(parents=True)
    for name in ("one/2", "one/deep/1", "one/1"):
        (tmp_path / "md" / f"{name}.md").write_text(name, encoding="utf-8")
    assert dict(map(tuple, readers.joined_markdown(spark, str(tmp_path / "md")).collect())) == {"": "text a\n\ntext b", "one": "one/1\n\none/2\n\none/deep/1"}
    (tmp_path / "x.pdf").write_bytes(b"junk %PDF-1.4")
    assert [(r.doc_id, r.is_pdf) for r in readers.pdfs(spark, str(tmp_path)).select("doc_id", "is_pdf").collect()] == [("x", True)]
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "doc_id int, v string")
    again = spark.createDataFrame([(3, "x"), (2, "c"), (3, "d")], "doc_id int, v string").coalesce(1)
    assert sorted(map(tuple, sinks.upsert(old, again).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    path = str(tmp_path / "t")
    for number, rows in enumerate((old, again, new.where("doc_id = 3").selectExpr("doc_id", "'e' as v"))):
        sinks.append_version(rows, path, number)
        sinks.append_version(rows, path, number)  # a batch that is run again
    want = [(1, "a"), (2, "c"), (3, "e")]
    assert sorted(map(tuple, sinks.newest(spark, path).collect())) == want
    sinks.compact(spark, path)
    assert [p.name for p in (tmp_path / "t").iterdir() if p.is_dir()] == ["version=5"] and sorted(map(tuple, sinks.newest(spark, path).collect())) == want
    sinks.append_version(new.where("doc_id = 2").selectExpr("doc_id", "'f' as v"), path, 3)
    assert sorted(map(tuple, sinks.newest(spark, path).collect())) == [(1, "a"), (2, "f"), (3, "e")]
    sinks.export_lines(old, str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ['{"1":"a"}', '{"2":"b"}']
    sinks.export_json(old, str(tmp_path / "o.json"))
    sinks.export_json(new, str(tmp_path / "o.json"), merge=True)
    assert '"1"' in (tmp_path / "o.json").read_text() and (tmp_path / "o.json").read_text().endswith("}\n")


def test_kept_conversions(spark, tmp_path):
    docs = spark.createDataFrame([("a/1", "x\n"), ("b", ""), ("c", None), ("é", "ü")], "doc_id string, markdown string")
    assert sinks.write_markdown(docs, str(tmp_path / "md")) == 4
    assert {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "md").iterdir() if not p.name.startswith(".")} == {"a_1.md": "x\n", "b.md": "", "c.md": "", "_.md": "ü"}
    pages = spark.createDataFrame([("p", [3, 12, 4], "m1"), ("q_pages_2", [], "m2")], "doc_id string, pages array<int>, markdown string")
    sinks.write_markdown(pages, str(tmp_path / "alt"), readers.alternative_name(F.col("doc_id"), F.col("pages")))
    (tmp_path / "alt" / "other.md").write_text("no", encoding="utf-8")
    assert sorted(map(tuple, readers.alternatives(spark, str(tmp_path / "alt")).collect())) == [("p", [3, 12, 4], "m1"), ("q_pages_2", [], "m2")]


FITZ = """
class Page:
    def __init__(self, text): self.text = text
    def get_text(self, kind): return self.text

class Document(list):
    def __enter__(self): return self
    def __exit__(self, *_): pass
    page_count = property(len)
    def insert_pdf(self, other, from_page, to_page): self.extend(other[from_page : to_page + 1])
    def tobytes(self): return "|".join(p.text for p in self).encode()

def open(stream=None, filetype=None):
    if stream == b"broken": raise RuntimeError("damaged")
    return Document(Page(t) for t in stream.decode().split("|")) if stream is not None else Document()
"""


def test_adapters_keep_failures_to_their_document(spark, tmp_path):
    files = spark.createDataFrame([("d", b"x = 1 (1)\n second |last"), ("bad", b"broken")], "doc_id string, content binary").coalesce(1)
    without = readers.page_counts(files).collect()
    assert {(r.doc_id, r.pages, r.error.split(":")[0]) for r in without} == {("d", None, "ModuleNotFoundError"), ("bad", None, "ModuleNotFoundError")}
    (tmp_path / "fitz.py").write_text(FITZ, encoding="utf-8")
    spark.sparkContext.addPyFile(str(tmp_path / "fitz.py"))  # a stand-in for the library
    assert {tuple(r) for r in readers.page_counts(files).collect()} == {("d", 2, None), ("bad", None, "RuntimeError: damaged")}
    lines = readers.page_lines(files)
    assert sorted(tuple(r)[:5] for r in lines.where("error is null").collect()) == [("d", "last", 2, 1, 3), ("d", "second", 1, 2, 2), ("d", "x = 1 (1)", 1, 1, 1)]
    assert [(r.doc_id, r.text) for r in lines.where("error is not null").collect()] == [("bad", None)]
    assert [(e.doc_id, e.number, e.latex) for e in E.page_text(lines).collect()] == [("d", "1", "x = 1")]
    cut = readers.single_pages(files, spark.createDataFrame([("d", 2), ("d", 3), ("bad", 1)], "doc_id string, page int")).collect()
    assert {(r.doc_id, r.page, r.error) for r in cut} == {("d", 2, None), ("d", None, "ValueError: page 3 is outside the document"), ("bad", None, "RuntimeError: damaged")}
    assert bytes(next(r.page_content for r in cut if r.page == 2)) == b"last"

    def make():
        def convert(content):
            if content == b"broken":
                raise KeyError("k")
            return content.decode().upper()

        return convert

    docs = readers.converted(files, make)
    assert {tuple(r)[:4] for r in docs.collect()} == {("d", "X = 1 (1)\n SECOND |LAST", 23, "success"), ("bad", "", 0, "docling_failed:KeyError")}
    data, report = W.records(W.run(docs, page_lines=lines), docs)
    assert {r.doc_id: (r.docling_status, r.equation_labels) for r in report.collect()} == {"d": ("success", ["1"]), "bad": ("docling_failed:KeyError", [])}
    assert {r.doc_id: len(r.equations) for r in data.collect()} == {"d": 1, "bad": 0}


def test_labels_of_any_length(spark):
    names = ["9" * 400, "1" + "0" * 39, "2", "002", "1" + "0" * 37, "1.0000002", "1.3", "1" * 39 + "a", "A" + "9" * 50, "A3", "x"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, t string").orderBy(L.sort_key(F.col("t")), "i")
    assert [r.t for r in rows.collect()] == ["1.0000002", "1.3", "2", "002", "1" + "0" * 37, "1" * 39 + "a", "1" + "0" * 39, "9" * 400, "A3", "A" + "9" * 50, "x"]
    docs = spark.createDataFrame([("d", "\n".join(f"x = y ({n})" for n in ("1" * 400, "1" * 39, "1" * 38, "7")))], "doc_id string, markdown string")
    assert [len(e.number) for e in V.extract_equations(docs).orderBy("rank").collect()] == [1, 38, 39, 400]


def test_scope_comes_after_the_limit(spark):
    docs = spark.createDataFrame([("d", "x = y (A1)\nx = y (2)\nx = y (0)\nx = y (3)")], "doc_id string, markdown string")
    for limit, want in ((4, ["2", "3"]), (2, ["2"]), (1, []), (0, [])):
        assert [e.number for e in W.run(docs, W.Options(equations=limit, scope="main")).orderBy("rank").collect()] == want
    with pytest.raises(ValueError):
        W.run(docs, W.Options(scope="some"))
    assert W.Options.batch().strict_page_text and not W.Options.batch().page_retry and W.Options.batch(page_retry=True).page_retry


def test_stream(spark, tmp_path):
    from eqspark.streaming import incremental

    (tmp_path / "in").mkdir()
    for name, text in (("p1", DOC), ("p2", "$$u = v ( 9 )$$")):
        (tmp_path / "in" / f"{name}.md").write_text(text, encoding="utf-8")
        incremental.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    entries = lambda: {r.doc_id: len(r.equations) for r in sinks.newest(spark, str(tmp_path / "out")).collect()}
    assert entries() == {"p1": 5, "p2": 1}
    (tmp_path / "in2").mkdir()
    (tmp_path / "in2" / "p1.md").write_text("nothing is left", encoding="utf-8")
    later = spark.read.text(str(tmp_path / "in2"), wholetext=True).selectExpr("'p1' as doc_id", "value as markdown")
    sinks.append_version(R.dataset(V.extract_equations(later), later), str(tmp_path / "out"), 9)
    assert entries() == {"p1": 0, "p2": 1}
