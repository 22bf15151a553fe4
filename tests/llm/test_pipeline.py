"""The corpus pipeline, stage by stage, against plain Python."""

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from eqspark.llm import pii, quality_forest
from tokenizers import Tokenizer

from .conftest import SF, odd_texts
from .test_documents import base_spans, base_statistics, brute_near, further_spans


def redacted(text):
    """One kind after the other, each over what the kinds before left."""
    if text is None:
        return None
    for kind in pii.KINDS:
        spans = base_spans(text)[kind.name] if kind.name in pii.BASE else [tuple(map(int, s.split(":")[1:])) for s, _ in further_spans(text) if s.startswith(kind.name + ":")]
        for a, b in reversed(spans):
            text = f"{text[:a]}[{kind.name.upper()}]{text[b:]}"
    return text


def expected(rows, keeps):
    """What the first three stages leave: identifier and text."""
    good = [(i, t) for i, t in rows if keeps(t)]
    classes = defaultdict(list)
    for (i, class_id, _, _), n in brute_near(good).items():
        classes[class_id].append(i)
    one = {c if c is not None else None for c in classes}
    kept = []
    for c in one:
        texts = {t or "" for i, t in good if i == c}
        kept.append((c, texts))
    return [(c, {redacted(t) for t in texts}) for c, texts in kept]


def places(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist() and sum(pieces[-1]) <= 4096
    return by


def check(spark, docs, sf_dir, got):
    model = quality_forest.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keeps = lambda t: not base_statistics(t)[-1] and model.keeps([quality_forest.statistics(t)[1]])[0]
    left = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], keeps)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = defaultdict(int)
    for r in got:
        lengths[r.doc_id] += r.length
    assert set(lengths) == {i for i, _ in left}
    for i, texts in left:
        assert lengths[i] in {len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts}
    by = places(got)
    assert len(by) >= sum(r.length for r in got) / 4096
    return left


def test_run_against_plain_python(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    left = check(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, got)
    assert 50 < len(left) < spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, schema):
        (tmp_path / "t").mkdir(exist_ok=True)
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "t" / "documents.parquet"))
        spark.read.parquet(f"{SF}/labels.parquet").write.mode("overwrite").parquet(str(tmp_path / "t" / "labels.parquet"))
        return str(tmp_path / "t")

    return make


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_on_odd_tables(spark, folder):
    texts = odd_texts()
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], rows[6], (None, texts[14], None, None, None), (None, None, None, None, None), (99, texts[14] + " and some more words than the rules ask for", "en", "s", 1)]
    where = folder(rows, SCHEMA)
    got = corpus_pipeline.run(spark, where).collect()
    assert check(spark, spark.read.parquet(f"{where}/documents.parquet"), where, got)
    clash = folder([(*r, 1, "x", 2.0, 3, 4) for r in rows], SCHEMA + ", rank long, node string, sequence_id double, offset long, piece int")
    again = corpus_pipeline.run(spark, clash).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got)


def test_stages_keep_columns_and_empty_tables(spark, folder):
    where = folder([], SCHEMA)
    docs = spark.read.parquet(f"{where}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, where)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.run(spark, where).collect() == []
    wide = folder([(1, "one two three four five six seven eight nine ten eleven", "en", "s", 1, "k")], SCHEMA + ", node string")
    docs = spark.read.parquet(f"{wide}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert [tuple(r) for r in stage(spark, docs, wide).collect()] == [tuple(r) for r in docs.collect()]


def test_the_tables_of_finished_stages_go(spark):
    from pathlib import Path

    from eqspark.llm.common import shared_dir

    before = set(Path(shared_dir(spark), "eqspark").iterdir())
    corpus_pipeline.run(spark, SF).collect()
    left = set(Path(shared_dir(spark), "eqspark").iterdir()) - before
    assert not [p for p in left if p.name.startswith(("signatures", "links", "buckets", "stage-quality", "stage-near"))]
