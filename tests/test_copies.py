"""Documents of equal inputs are worked on once, and each gets its rows."""

from collections import Counter

from eqspark.operators import resolve as V
from eqspark.operators.copies import once
from pyspark.sql import functions as F

BROKEN, WHOLE = "$$a = b \\quad ( 1 )$$\n", "$$c = d + e \\quad ( 2 )$$\n$$f = g \\quad ( 4 )$$"
PAGE = [("a = b + c (1)", 1, 1, 1), ("c = d + e (2)", 1, 2, 2), ("h = i + j (3)", 2, 1, 3)]


def tables(spark):
    texts = [(i, BROKEN, WHOLE, PAGE) for i in range(40)] + [(None, BROKEN, WHOLE, PAGE), (50, BROKEN, None, PAGE), (51, None, WHOLE, PAGE[::-1]), (52, "", "", []), (53, "x", WHOLE, PAGE[:2])]
    texts += [(54, "x", WHOLE, [*PAGE[:2], PAGE[1]]), (55, None, None, [(None, 1, 1, 1)]), (56, WHOLE, BROKEN, PAGE[::-1]), (57, WHOLE, BROKEN, PAGE)]
    docs = spark.createDataFrame([(d, m) for d, m, _, _ in texts], "doc_id long, markdown string").repartition(3)
    other = spark.createDataFrame([(d, m) for d, _, m, _ in texts], "doc_id long, markdown string").repartition(2)
    lines = spark.createDataFrame([(d, *p) for d, _, _, page in texts for p in page], "doc_id long, text string, page int, page_line int, global_line int").repartition(5)
    return docs, lines, other


def test_equal_inputs_are_worked_on_once(spark):
    docs, lines, other = tables(spark)
    seen = []

    def listed(docs, lines, other):
        seen.append([r[0] for r in docs.select("doc_id").collect()])
        rows = docs.unionAll(other).unionAll(lines.select("doc_id", "text"))
        return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list("markdown")).alias("all"))

    got = once(listed, docs, lines, other).collect()
    assert Counter((r.doc_id, tuple(r.all)) for r in got) == Counter((r.doc_id, tuple(r.all)) for r in listed(docs, lines, other).collect())
    assert len(got) == 49 and len(seen[0]) == 9 and len(seen[1]) == 49  # 40 copies, one without identifier, and a pair that differs in the order of rows only


def test_alternative_of_copies_is_that_of_each_document(spark):
    docs, lines, other = tables(spark)
    want = V.replace_from_alternative(V.extract_equations(docs, page_lines=lines), V.extract_equations(other))
    got = V.extract_with_alternative(docs, lines, other)
    assert got.columns == want.columns and Counter(map(str, got.collect())) == Counter(map(str, want.collect()))
    assert V.extract_with_alternative(docs.limit(0), lines.limit(0), other.limit(0)).collect() == []
