"""op3's thresholds hold over all labelled rows, however many there are."""

from eqspark.llm import quality_forest
from pyspark.sql import functions as F


def test_thresholds_count_all_labelled_rows(spark):
    ids = [r.id for r in spark.range(4700).orderBy(F.xxhash64("id")).collect()]
    words = [f"{'abcdefgh'[i % 8] * (3 + i % 5)}{i}" for i in range(5000)]
    rows = []
    for at, i in enumerate(ids):  # good texts of another kind come late in the order of hashes
        bad, late = at % 20 == 0, at >= 4300
        end = " %%%" if bad else "! A, B; C." if late else "," if i % 3 else "."
        rows.append((i, " ".join(w + end for w in words[i % 4900 : i % 4900 + 12 + i % 7]), int(not bad)))
    made = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(8)
    model = quality_forest.fit(made, made)
    kept = {r.doc_id: r.kept for r in quality_forest.assess(made, model).where("not base_failed").collect()}
    good = [kept[i] for i, _, q in rows if q and i in kept]
    bad = [kept[i] for i, _, q in rows if not q and i in kept]
    assert len(good) > 4300 and good.count(False) <= 0.002 * len(good) and sum(bad) <= 0.05 * len(bad)
