from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from cases import WORD, messy_documents, no_documents
from conftest import SF_DIR
from test_duplicates import brute_near, brute_removal
from test_packing_sharding_mixing import check_packing

import corpus_pipeline
from coldtrace.llm import mixing, packing, quality_model


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage read and wrote, over the test table."""
    root = tmp_path_factory.mktemp("steps")
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{k}")
        made = spark.read.parquet(f"{root}/{k}")
        out.append((docs, made))
        docs = made
    return out


def test_rejected_documents_go(spark, steps):
    docs, kept = steps[0]
    model = quality_model.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = docs.collect()
    good = model.scores([r.text for r in rows]) >= quality_model.THRESHOLD
    assert Counter(r for r, g in zip(rows, good) if g) == Counter(kept.collect()) and 0 < kept.count() < docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([i in ids for i, q in labels.items() if q == 1]) > 0.97


def test_one_document_of_each_group_stays(steps):
    docs, kept = steps[1]
    first = {i for i, _, component in brute_near(docs.collect(), 5) if i == component}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first)
    assert kept.columns == docs.columns and kept.subtract(docs).count() == 0


def test_repeated_passages_are_cut(steps):
    docs, cut = steps[2]
    before = {r.doc_id: r for r in docs.collect()}
    rows = cut.collect()
    assert sorted(r.doc_id for r in rows) == sorted(before)
    removed = {i: n for i, _, n, _ in brute_removal(list(before.values()), corpus_pipeline.PASSAGE)}
    for r in rows:
        if removed[r.doc_id]:
            assert len(WORD.findall(r.text)) == len(WORD.findall(before[r.doc_id].text)) - removed[r.doc_id]
            assert r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]


def test_sources_are_mixed(steps):
    docs, mixed = steps[3]
    copies = {r.doc_id: r["__copies"] for r in mixing.with_copies(docs).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter(copies)


def test_everything_is_packed(steps):
    docs, packed = steps[4]
    assert check_packing(docs, packed.collect(), packing.LENGTH) < 0.05


def test_awkward_rows_pass_all_stages(spark):
    for docs in (messy_documents(spark), no_documents(spark)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
            made = stage(spark, docs, SF_DIR)
            assert made.columns == docs.columns and made.count() <= 3 * docs.count(), k


def test_ids_on_different_texts_are_judged_by_text(spark):
    a, b = ("one two three four five six seven eight", "other words that stand nowhere else in here")
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (5, None), (None, a)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert sorted(map(str, kept.collect())) == sorted(map(str, [docs.collect()[k] for k in (0, 2, 3, 4)]))
