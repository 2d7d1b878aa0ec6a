from __future__ import annotations

import zlib

import numpy as np
from cases import messy_documents, no_documents

from coldtrace.llm import language, quality_model
from coldtrace.llm.queries import op7_word_first_language, op8_subword_quality

DIR = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = op7_word_first_language(spark, DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_texts(spark):
    docs = messy_documents(spark)
    rows = language.identify(docs, language.train(docs)).collect()
    assert len(rows) == docs.count() and {r.lang_pred for r in rows} <= {"en", "de", "und"}
    model = language.fit([("the", "en", 9), ("der", "de", 9), ("schön", "de", 5)])
    names, scores = model.predict([None, "", "12 !", "the", "schönes", "x² ²", "the der der"])
    assert names[:5] == ["und", "und", "und", "en", "de"] and list(scores[:3]) == [0, 0, 0]
    assert names[6] == "de"


def test_language_without_training(spark):
    nothing = language.train(no_documents(spark))
    assert nothing.predict(["the"])[0] == ["und"]
    assert language.identify(no_documents(spark), nothing).count() == 0


def test_unseen_words_fall_back_to_shorter_grams():
    model = language.fit([("abcdef", "x", 5), ("uvwxyz", "y", 5)])
    longest = model.backed_off("abcdeq")
    assert np.argmax(longest) == 0 and np.argmax(model.backed_off("qqxyq")) == 1
    assert (model.backed_off("qqq") == model.unseen).all() or model.backed_off("qqq").shape == (2,)


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = op8_subword_quality(spark, DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in judged]) > 0.95
    assert np.mean([p for p, q in judged if q == 1]) > 0.98
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_of_awkward_texts(spark):
    docs = messy_documents(spark)
    labels = spark.createDataFrame(
        [(r.doc_id, k % 3, 0) for k, r in enumerate(docs.collect())] + [(None, 1, 0), (4, None, 1)],
        "doc_id long, quality int, toxic int",
    )
    scored = quality_model.score(docs, quality_model.train(docs, labels), "__quality")
    rows = scored.collect()
    assert len(rows) == docs.count() and scored.columns == [*docs.columns, "__quality"]
    assert all(0 < r["__quality"] < 1 for r in rows)


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_model.train(messy_documents(spark), none)
    assert model.scores([None, "", "a b"]).tolist() == [0.5] * 3
    assert quality_model.score(no_documents(spark), model).count() == 0


def test_scores_do_not_depend_on_neighbours():
    draw = np.random.default_rng(0)
    texts = ["".join(draw.choice(list("ab é\n")) for _ in range(n)) for n in (0, 1, 5, 40, 300)]
    model = quality_model.fit(texts * 4, np.array([0, 1, 0, 1, 1] * 4))
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts])


def test_unseen_words_are_scored_many_at_once(monkeypatch):
    """As if one by one, also when more words are unseen than are remembered."""
    model = language.fit([("the", "en", 9), ("abcde", "en", 9), ("der", "de", 9), ("xyxyx", "de", 9)])
    words = ["abcdeq", "qqxyq", "qqq", "the", "thexy", "derab", "abcdeq", "cdqq", "ZZ"]
    apart = np.array([model.backed_off(word) for word in words])
    assert (model.all_backed_off(words) == apart).all()
    texts = [" ".join(words[k:]) for k in range(len(words))] + ["", None]
    whole = model.predict(texts)
    monkeypatch.setattr(language, "REMEMBER", 3)
    few = language.fit([("the", "en", 9), ("abcde", "en", 9), ("der", "de", 9), ("xyxyx", "de", 9)])
    again = few.predict(texts)
    assert again[0] == whole[0] and np.allclose(again[1], whole[1], rtol=1e-12)
    assert len(few._later) <= 3
