from __future__ import annotations

import math
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import messy_documents, messy_texts, no_documents

from coldtrace.llm import toxicity
from coldtrace.llm.queries import op13_toxic_segments

DIR = "/root/testdata/sf0.01"


# -- plain versions ------------------------------------------------------------------------------


def plain_tokens(text):
    out, word = [], ""
    for c in (text or "").lower() + " ":
        code = ord(c)
        single = any(a <= code < b for a, b in ((0x3040, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x40000)))
        letter = unicodedata.category(c)[0] in "LM"
        if word and (single or not letter):
            out.append(word)
            word = ""
        if letter and single:
            out.append(c)
        elif letter:
            word += c
    return out


def chain(token):
    return [token[:n] for n in toxicity.BEGINNINGS if len(token) > n] + [token]


def plain_odds(toxic, clean, corpus, token):
    """Log-odds of a token and their error from lists of tokens, without buckets."""
    counts = [Counter(enumerate_units(t)) for t in (toxic, clean)]
    letters = token[: toxicity.BEGINNINGS[0]]
    frequency = max(sum(t[: toxicity.BEGINNINGS[0]] == letters for t in corpus), 1) / len(corpus)
    share = even = len(toxic) / (len(toxic) + len(clean))
    weight, found = toxicity.CORPUS_WEIGHT * frequency, None
    for unit in chain(token):
        a, b = (c[unit, unit == token] for c in counts)
        if found is None or a + b >= toxicity.LEAST_COUNT:
            a += weight * share + toxicity.EVEN_WEIGHT * even
            b += weight * (1 - share) + toxicity.EVEN_WEIGHT * (1 - even)
            found = math.log(a / b * len(clean) / len(toxic)), math.sqrt(1 / a + 1 / b)
            share = a / (a + b)
        weight = toxicity.PRIOR_WEIGHT
    return found


def enumerate_units(tokens):
    for t in tokens:
        for unit in chain(t):
            yield (unit, unit == t)


def plain_segments(scores):
    """By definition: the best segment, shortest of equals, then those left and right of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(
        ((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    )
    i, j = -best[2], -best[2] - best[1]
    left, right = plain_segments(scores[:i]), plain_segments(scores[j:])
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]


# -- tests ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(30))
def test_segments_by_definition(seed):
    draw = random.Random(seed)
    # Odd weights, so that no two segments have the same sum.
    scores = [draw.choice([-1, 1, 1]) * draw.randrange(1, 1 << 20) / 1024 for _ in range(draw.randrange(0, 24))]
    assert toxicity.segments(np.array(scores)) == plain_segments(scores)


def test_tokens_of_awkward_texts():
    texts = messy_texts() + ["été İstanbul", "漢字かな交じり文abc", "x" * 70000, "a1b_c-d"]
    for block in toxicity._blocks(texts):
        found = toxicity.tokens(block)
        spelled = "\n".join(block) + "\n"
        for k, text in enumerate(block):
            mine = [spelled[i:j] for i, j in zip(found.starts, found.ends)][found.edges[k] : found.edges[k + 1]]
            assert mine == plain_tokens(text)


def test_odds_by_definition():
    draw = random.Random(5)
    words = ["run", "running", "runner", "scum", "scumbag", "an", "of", "élan", "élanes", "x"]
    toxic = [draw.choice(words[:6]) for _ in range(300)]
    clean = [draw.choice(words) for _ in range(500)]
    corpus = toxic + clean + [draw.choice(words[5:]) for _ in range(2000)]

    def counts(tokens):
        out = np.zeros(toxicity.BUCKETS, np.float32)
        for bucket in toxicity.unit_buckets(toxicity.tokens([" ".join(tokens)])):
            np.add.at(out, bucket[bucket >= 0], 1)
        return out

    begun = np.bincount(
        toxicity.corpus_buckets(toxicity.tokens([" ".join(corpus)])), minlength=toxicity.CORPUS_BUCKETS
    )
    odds = toxicity.Odds(counts(toxic), counts(clean), len(toxic), len(clean), begun)
    asked = [*words, "scummy", "runs", "unseen", "scu"]
    made = odds.of(toxicity.tokens([" ".join(asked)]))
    assert np.allclose(np.array(made).T, [plain_odds(toxic, clean, corpus, t) for t in asked], atol=1e-4)


def test_chance_law_is_found_again():
    draw = np.random.default_rng(1)
    n = draw.integers(50, 2000, 4000)
    # Greatest of about k * n * exp(-rate * s) segments.
    best = (np.log(0.05 * n) + draw.gumbel(size=len(n))) / 0.8
    law = toxicity.fit_chance(best, n)
    assert abs(law.rate - 0.8) < 0.05 and abs(math.log(law.k / 0.05)) < 0.25


def test_evidence_adds_up_significant_segments():
    law = toxicity.Chance(1.0, 0.1)
    alone = law.evidence(9.0, 100)
    assert math.isclose(toxicity.total_evidence([9.0, 8.0, 1.0], 100, law), alone + law.evidence(8.0, 100))
    assert toxicity.total_evidence([], 100, law) < toxicity.total_evidence([1.0], 100, law) < alone


def test_held_out_documents(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = op13_toxic_segments(spark, DIR).collect()
    assert len(rows) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, truth[r.doc_id].toxic) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == t for p, t in held]) > 0.93
    assert np.mean([p for p, t in held if t == 0]) < 0.04


def test_passages_hold_the_planted_words(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    calm = " ".join(["the", "thing", "and", "of"] * 40)
    text = f"{calm} idiot moron scum the loser {calm}"
    score, n, found = next(model.passages([text]))
    begin, end = found[0][:2]
    assert score > 0.5 and n == len(plain_tokens(text)) and len(found) == 1
    # Common words beside the passage may score a little above nothing.
    assert re.fullmatch(r"((the|thing|and|of) ){0,2}idiot moron scum the loser( (the|thing|and|of)){0,2}", text[begin:end])
    assert next(model.passages([calm]))[0] < 0.3


def test_awkward_rows(spark):
    docs = messy_documents(spark)
    labels = spark.createDataFrame(
        [(r.doc_id, 1, k % 3) for k, r in enumerate(docs.collect())] + [(None, 1, 1), (4, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model, "__score", "__passages")
    rows = scored.collect()
    assert len(rows) == docs.count() and scored.columns == [*docs.columns, "__score", "__passages"]
    assert all(0 <= r["__score"] <= 1 for r in rows)
    assert len({r["__score"] for r in rows if not plain_tokens(r.text)}) == 1


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(messy_documents(spark), none)
    assert [s for s, _, _ in model.passages([None, "", "a b"])] == [0.5] * 3
    only = spark.createDataFrame([(k, 0) for k in range(200)], "doc_id long, toxic int")
    assert all(s < 0.05 for s, _, _ in toxicity.train(messy_documents(spark), only).passages(["a", None]))
    assert toxicity.score(no_documents(spark), toxicity.train(no_documents(spark), none)).count() == 0


def test_scores_do_not_depend_on_neighbours(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    texts = [r.text for r in docs.limit(20).collect()]
    assert [s for s, _, _ in model.passages(texts)] == [next(model.passages([t]))[0] for t in texts]
