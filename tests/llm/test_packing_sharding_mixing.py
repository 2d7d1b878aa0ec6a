from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import WORD, messy_documents, no_documents
from pyspark.sql import functions as F

from coldtrace.llm import mixing, packing, sharding
from coldtrace.llm.queries import tokenizer_path


def folder(tmp_path):
    return str(tmp_path / "map")


def test_shards_hold_every_row_in_gapless_slots(spark, tmp_path):
    docs = messy_documents(spark)
    rows = sharding.shard_documents(docs, folder(tmp_path), shards=5, slots=64).collect()
    size = lambda t: len((t or "").encode()) + 8
    expected = Counter((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_are_near_equal_and_maps_are_versioned(spark, tmp_path):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.pmod(F.xxhash64("id"), F.lit(90)).cast("int")).alias("text")
    )
    rows = sharding.shard_documents(docs, folder(tmp_path), shards=24)
    loads = [r.b for r in rows.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 24 and max(loads) - min(loads) < 90
    first, second = (sharding.load_map(spark, folder(tmp_path), v) for v in (1, 2))
    assert (sharding.load_map(spark, folder(tmp_path)) == second).all() and (first != second).any()
    sizes, _ = sharding.slot_totals(rows)
    grown = sharding.rebalance(second, sizes, 25)
    loads = np.bincount(grown, weights=sizes, minlength=25)
    assert (grown == 24).any() and loads.max() - loads.min() < 200
    assert (grown != second).sum() < len(grown) / 5  # only some slots move


def test_no_documents_in_shards(spark, tmp_path):
    assert sharding.shard_documents(no_documents(spark), folder(tmp_path)).count() == 0


def brute_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in held)
        total = sum(weight[s] for s in names if s not in held)
        target = {s: most * sizes[s] if s in held else left * weight[s] / total for s in names}
        over = {s for s in names if s not in held and target[s] > most * sizes[s]}
        if not over:
            return target
        held |= over


def test_mix_targets_and_copies(spark):
    docs = messy_documents(spark)
    rows = mixing.with_copies(docs).collect()
    n_words = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += n_words(r.text)
    targets = brute_targets(sizes)
    assert len(rows) == docs.count()
    for r in rows:
        assert r["__size"] == n_words(r.text) and r["__source_size"] == sizes[r.source]
        assert r["__target"] == pytest.approx(targets[r.source])
        rate = targets[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r["__copies"] in (int(rate), int(rate) + 1) and r["__copies"] <= 3
    again = {(r.doc_id, r.text): r["__copies"] for r in mixing.with_copies(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.text): r["__copies"] for r in rows}
    mixed = Counter((r.doc_id, r.text) for r in mixing.mix(docs).collect())
    emitted = Counter()
    for r in rows:
        emitted[r.doc_id, r.text] += r["__copies"]
    assert mixed == +emitted and mixing.mix(docs).columns == docs.columns


def test_sources_come_near_their_targets(spark):
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("x "), (F.pmod("id", F.lit(40)) + 1).cast("int")).alias("text"),
        F.when(F.pmod("id", F.lit(3)) == 0, "hot").otherwise(F.concat(F.lit("s"), F.pmod("id", F.lit(7)))).alias("source"),
    )
    taken = F.sum(F.col("__size") * F.col("__copies")).alias("taken")
    for r in mixing.with_copies(docs).groupBy("source", "__target").agg(taken).collect():
        assert abs(r.taken - r["__target"]) < 0.06 * r["__target"]


def test_nothing_to_mix(spark):
    assert mixing.mix(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, " ", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["__target"] for r in mixing.with_copies(blank).collect()] == [0.0, 0.0]


def check_packing(docs, rows, length):
    tokenizer = packing._tokenizer(tokenizer_path())
    whole = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END]
        whole[r.doc_id, np.array(ids, "<u4").tobytes()] += 1
    expected = Counter()
    for (doc_id, ids), n in whole.items():
        expected[doc_id] += n * len(ids) // 4
    found, by_sequence = Counter(), defaultdict(list)
    for r in rows:
        found[r.doc_id] += r.length
        assert len(r.ids) == 4 * r.length > 0
        assert any(d == r.doc_id and i[4 * r.start : 4 * (r.start + r.length)] == bytes(r.ids) and len(i) == 4 * r.doc_tokens for d, i in whole)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    spaces = 0
    for places in by_sequence.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
        spaces += length - at
    return spaces / (length * max(1, len(by_sequence)))


@pytest.mark.parametrize("parts", [1, 40])
def test_packing_round_trip(spark, parts):
    docs = messy_documents(spark).repartition(parts)
    rows = packing.pack(docs, tokenizer_path(), length=256, most=4).collect()
    assert check_packing(docs, rows, 256) < 0.08


def test_packing_of_whole_table(spark):
    from conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path()).collect()
    assert check_packing(docs, rows, packing.LENGTH) < 0.03


def test_nothing_to_pack(spark):
    assert packing.pack(no_documents(spark), tokenizer_path()).count() == 0


def test_best_fit_and_bound():
    packer = packing.Packer(0, 0, length=10, most=2)
    piece = lambda n: (1, 0, n, b"", n)
    assert packer.add(piece(6)) == [] and packer.add(piece(7)) == []
    assert [r[2] for r in packer.add(piece(3))] == [7, 3]  # fills the one with least room
    packer.add(piece(8))
    assert [r[2] for r in packer.add(piece(9))] == [8]  # the fullest makes place
    assert sorted(r[2] for r in packer.rest(True)) == [6, 9]
