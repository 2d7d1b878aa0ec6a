from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import WORD, components, messy_documents, no_documents, sentence

from pyspark.sql import functions as F

from coldtrace.llm import embeddings, minhash, recompress, substring
from coldtrace.llm.components import components as spark_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    ws = WORD.findall((text or "").translate(LOWER))
    if len(ws) < n:
        return {tuple(ws)} if ws else set()
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}


def brute_near(rows, n):
    sets = [(r.doc_id, shingles(r.text, n)) for r in rows]
    linked = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and None not in (a, b) and 100 * len(x & y) >= 80 * len(x | y):
                linked.append((a, b))
    found = components({a for a, _ in sets if a is not None}, linked)
    return Counter((a, len(x), found.get(a)) for a, x in sets)


@pytest.mark.parametrize("words, seed", [(2, 1), (5, 2)])
def test_near_duplicates_equal_brute_force(spark, words, seed):
    docs = messy_documents(spark, seed)
    found = Counter(tuple(r) for r in minhash.near_duplicates(docs, words).collect())
    assert found == brute_near(docs.collect(), words)


def test_near_duplicates_of_the_test_table(spark):
    from conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = Counter(tuple(r) for r in minhash.near_duplicates(docs, 5).collect())
    assert found == brute_near(docs.collect(), 5)


def test_chains_of_near_copies_stay_connected(spark):
    """Each text is near its neighbours only; hubs alone would not connect the ends."""
    draw = random.Random(9)
    ws = sentence(draw, 120, 100000).split()
    rows = []
    for k in range(24):
        rows.append((100 - k, " ".join(ws)))
        for _ in range(4):
            ws[draw.randrange(len(ws))] = f"n{draw.random()}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in minhash.near_duplicates(docs, 2).collect()) == brute_near(docs.collect(), 2)


def test_no_near_duplicates(spark):
    assert minhash.near_duplicates(no_documents(spark)).count() == 0


def test_keys_meet_within_the_distance():
    """Two signatures that differ in DISTANCE places share a chunk with one wrong place at most."""
    chunks = np.array_split(np.arange(minhash.PLACES), minhash.CHUNKS)
    draw = np.random.default_rng(0)
    for _ in range(2000):
        wrong = set(draw.choice(minhash.PLACES, minhash.DISTANCE, replace=False).tolist())
        assert any(len(wrong & set(c.tolist())) <= 1 for c in chunks)
    assert minhash.DISTANCE // minhash.CHUNKS == 1


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_union_find(spark, seed):
    draw = random.Random(seed)
    linked = [(draw.randrange(300), draw.randrange(300)) for _ in range(150)]
    linked += [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(2000, 2080)] + [(7, 7)]
    edges = spark.createDataFrame([*linked, (None, 3)], "a long, b long")
    found = {r.node: r.component for r in spark_components(edges).collect()}
    nodes = {n for a, b in linked if a != b for n in (a, b)}
    assert found == components(nodes, [e for e in linked if e[0] != e[1]])


def brute_removal(rows, window):
    """Words covered by a window that starts earlier elsewhere; rows without an id stay whole."""
    first, texts = {}, {}
    for r in rows:
        ws = WORD.findall(r.text or "")
        texts[id(r)] = ws
        if r.doc_id is None:
            continue
        for i in range(len(ws) - window + 1):
            g = tuple(ws[i : i + window])
            first[g] = min(first.get(g, (r.doc_id, i)), (r.doc_id, i))
    out = Counter()
    for r in rows:
        ws = texts[id(r)]
        gone = set()
        if r.doc_id is not None:
            for i in range(len(ws) - window + 1):
                if first[tuple(ws[i : i + window])] < (r.doc_id, i):
                    gone.update(range(i, i + window))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out[r.doc_id, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("window, seed", [(20, 1), (50, 1), (7, 2)])
def test_removal_equals_brute_force(spark, window, seed):
    docs = messy_documents(spark, seed)
    found = Counter(
        (r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in substring.remove_repeats(docs, window).collect()
    )
    assert found == brute_removal(docs.collect(), window)


def test_removal_with_few_words(spark):
    """Texts over two or three words: runs, periods and chance repeats of all lengths."""
    draw = random.Random(3)
    texts = [sentence(draw, draw.randrange(1, 260), draw.choice([1, 2, 3])) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = Counter(
        (r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in substring.remove_repeats(docs).collect()
    )
    assert found == brute_removal(docs.collect(), 20)


def test_nothing_to_remove(spark):
    assert substring.remove_repeats(no_documents(spark)).count() == 0


def test_equal_windows_have_equal_anchors():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 4, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 1000, 1000, 2500, 4000])
    level = recompress.words_level(words, first)
    windows = np.concatenate([np.arange(a, b - 19) for a, b in zip(first[:-1], first[1:]) if b - a >= 20])
    names, places = recompress.anchors(level, windows, 20)
    seen = {}
    for w, name, place in zip(windows, names, places):
        got = seen.setdefault(words[w : w + 20].tobytes(), (name, place - w))
        assert got == (name, place - w) and w <= place < w + 20


def vectors(seed=2):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(150, 16))
    near = base[:1] + 0.05 * draw.normal(size=(90, 16))
    pairs = base[1:40] + 0.08 * draw.normal(size=(39, 16))
    rows = [list(map(float, v)) for v in np.concatenate([base, near, pairs])]
    rows += [rows[3]] * 3 + [[2 * x for x in rows[4]]] + [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows.append([None, *rows[5][1:]])
    rows.append([1e300, *[0.0] * 15])
    return rows


def brute_links(rows):
    def usable(v):
        return bool(v) and None not in v and bool(np.isfinite(v).all()) and any(v)

    unit = {k: np.array(v) / np.abs(v).max() for k, v in rows if k is not None and usable(v)}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    linked = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    degree = Counter(n for e in linked for n in e)
    found = components([k for k, _ in rows if k is not None], linked)
    return Counter((k, degree[k], found.get(k)) for k, _ in rows)


def test_links_equal_brute_force(spark):
    rows = [(3 * k, v) for k, v in enumerate(vectors())] + [(None, vectors()[1])]
    table = spark.createDataFrame([(a, b, 1, "x", "y") for a, b in rows], "vec_id long, embedding array<double>, label int, id string, unit string")
    found, recall = embeddings.near_vectors(table)
    assert recall == 1.0
    assert Counter(tuple(r) for r in found.collect()) == brute_links(rows)


def test_saturated_lists_are_enlarged(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LIST", 4)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rows = list(enumerate(vectors(5)))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, _ = embeddings.near_vectors(table)
    assert Counter(tuple(r) for r in found.collect()) == brute_links(rows)


def test_dense_clusters_wider_than_the_threshold(spark, monkeypatch):
    """Saturated vectors whose neighbours reach beyond their leader's list."""
    monkeypatch.setattr(embeddings, "LIST", 4)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    draw = np.random.default_rng(4)
    spread = draw.normal(size=(2, 1, 8)) + 0.45 * np.pad(draw.normal(size=(2, 200, 3)), ((0, 0), (0, 0), (0, 5)))
    rows = [(2 * k + 1, list(map(float, v))) for k, v in enumerate(spread.reshape(-1, 8))]
    links = brute_links(rows)
    assert max(n for _, n, _ in links) > 40
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, _ = embeddings.near_vectors(table)
    assert Counter(tuple(r) for r in found.collect()) == links


def test_audit_sees_lost_pairs_beside_a_crowd(spark):
    """Odd ids, a crowd with nearly all links and isolated pairs, of which half are lost."""
    draw = np.random.default_rng(6)
    crowd = draw.normal(size=(1, 16)) + 0.01 * draw.normal(size=(60, 16))
    ends = draw.normal(size=(40, 16))
    every = np.concatenate([crowd, ends, ends + 1e-3])
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    ids = [2 * k + 1 for k in range(len(every))]
    units = spark.createDataFrame([(i, v.tobytes()) for i, v in zip(ids, every)], "id long, unit binary")
    near = every @ every.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))]
    lost = {i for k in range(20) for i in (ids[60 + k], ids[100 + k])}
    known = [e for e in links if e[0] not in lost]
    schema = "a long, b long"
    assert embeddings.audit(spark.createDataFrame(links, schema), units) == 1.0
    assert len(known) > 0.98 * len(links)
    assert embeddings.audit(spark.createDataFrame(known, schema), units) == pytest.approx(0.5)
    assert embeddings.audit(spark.createDataFrame(known, schema), units, 70) < 0.99


def test_low_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "STARTS", 2, raising=False)
    monkeypatch.setattr(embeddings, "DOUBLINGS", 1)
    monkeypatch.setattr(embeddings, "audit", lambda *_: 0.5)
    table = spark.createDataFrame(list(enumerate(vectors(5)))[:40], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="0.5"):
        embeddings.near_vectors(table)


def test_no_vectors(spark):
    found, recall = embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert found.count() == 0 and recall == 1.0


def test_crowds_of_almost_similar_texts(spark, monkeypatch):
    """Many variants of a text around the threshold, over several blocks."""
    monkeypatch.setattr(minhash, "FAMILY_BYTES", 16 * 8 * 146)
    monkeypatch.setattr(minhash, "BUCKET_BYTES", 16 * 96)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    draw = random.Random(11)
    base = sentence(draw, 150, 100000).split()
    rows = []
    for k in range(120):
        ws = list(base)
        for _ in range(draw.choice([2, 4, 5, 6, 7])):
            ws[draw.randrange(len(ws))] = f"n{draw.random()}"
        rows.append((k, " ".join(ws)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in minhash.near_duplicates(docs, 5).collect()) == brute_near(docs.collect(), 5)


def test_a_family_makes_rows_in_proportion(spark):
    """Rows that meet in tasks: one a member and one more for those outside the largest component."""
    schema = "family long, id long, label long, n long"

    def met(members, outside):
        rows = [(1, k, k if k < outside else -1, 200) for k in range(members)]
        frame = spark.createDataFrame(rows, schema)
        return minhash._sides(frame, "family", 8 * F.col("n"), minhash.FAMILY_BYTES)

    for members in (400, 1600):
        assert met(members, members // 4).count() == members + members // 4
    # Every pair with an end outside meets, also over several blocks.
    rows = [(1, k, k if k < 30 else -1, 200) for k in range(100)]
    cut = minhash._sides(spark.createDataFrame(rows, schema), "family", 8 * F.col("n"), 16 * 1600).collect()
    tasks = {}
    for r in cut:
        tasks.setdefault((r.i, r.j), ([], []))[r.is_left].append(r.id)
    pairs = {frozenset((x, y)) for others, left in tasks.values() for x in left for y in others if x != y}
    assert len(tasks) > 4 and pairs == {frozenset((x, y)) for x in range(30) for y in range(100) if x != y}


def test_ids_on_different_texts(spark):
    draw = random.Random(4)
    a, b = sentence(draw, 60, 10000), sentence(draw, 60, 10000)
    near = lambda t: t + " tail"
    rows = [(3, a), (5, a), (5, b), (7, None), (7, "x y"), (7, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs, 2).collect())
    assert found == Counter([(3, 3), (5, 3), (5, 5), (7, 7), (7, 7), (7, 7)])
    crossed = spark.createDataFrame([(5, a), (5, b), (8, near(b)), (9, near(a)), (2, near(a))], docs.schema)
    rows = {(r.doc_id, r.version): r.component_id for r in minhash.judged_rows(crossed, 2).collect()}
    known = {(r.doc_id, r.v): r.text for r in crossed.select("*", minhash.version(F.col("text")).alias("v")).collect()}
    assert {(i, known[i, v][:9]): c for (i, v), c in rows.items()} == {
        (5, a[:9]): 2, (9, a[:9]): 2, (2, a[:9]): 2, (5, b[:9]): 5, (8, b[:9]): 5,
    }


def test_bits_count_what_sets_share(monkeypatch):
    draw = np.random.default_rng(2)
    base = np.unique(draw.integers(0, 1 << 63, 300, dtype=np.uint64))
    sets = [np.unique(np.r_[draw.choice(base, n, replace=False), draw.integers(0, 1 << 63, 9, dtype=np.uint64)]) for n in (0, 1, 250, 280, 290)]
    sets += [base, base[:250], np.unique(draw.integers(0, 1 << 63, 70, dtype=np.uint64))]
    x, y = (z.ravel() for z in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    x, y = x[x != y], y[x != y]
    sizes = np.array([len(s) for s in sets])
    plain = [len(np.intersect1d(sets[p], sets[q])) / len(np.union1d(sets[p], sets[q])) >= 0.8 for p, q in zip(x, y)]
    assert minhash._similar(x, y, sets, sizes, minhash._bitsets(sets)).tolist() == plain
    monkeypatch.setattr(minhash, "BITSET_BYTES", 8)
    assert minhash._bitsets(sets) is None
    assert minhash._similar(x, y, sets, sizes, None).tolist() == plain
