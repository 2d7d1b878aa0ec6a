from __future__ import annotations

import hashlib
import random
from collections import Counter

from cases import WORD, messy_documents, no_documents
from pyspark.sql import functions as F

from coldtrace.llm import quality_rules, warc

PAGES = "record_id long, url string, payload string, data string, digest string, first string"


def pages(spark):
    draw = random.Random(4)
    long = "".join(draw.choice("aé你\n ") for _ in range(5000))
    payloads = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "y" * 100, long, long]
    payloads += ["a\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\nb" * 60, "WARC/1.0\r\n" * 30, "ends in WARC/1.0"]
    rows = [(k + 10, None if k % 4 == 0 else f"http://h/{k}\r\nX: y", p, "1", None, "z") for k, p in enumerate(payloads)]
    rows += [rows[4], (None, None, "y" * 100, None, None, None), (None, "u", None, None, None, None)]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, PAGES).repartition(3)


def test_archives_give_the_pages_back(spark, tmp_path):
    table = pages(spark)
    path = str(tmp_path / "warc")
    warc.write_archives(table, path, size=1000)
    found = Counter(
        (r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in warc.read_archives(spark, path).collect()
    )
    rows = [(r.record_id, (r.payload or "").encode()) for r in table.collect()]
    first = {}
    for record, payload in rows:
        if record is not None and len(payload) >= 100:
            first[payload] = min(record, first.get(payload, record))
    expected = Counter()
    for record, payload in rows:
        refers = first.get(payload)
        refers = None if refers == record else refers
        kind = "response" if refers is None else "revisit"
        expected[record, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers] += 1
    assert found == expected


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


def test_chunks_carry_running_digests(spark):
    payload = bytes(range(256)) * 9
    table = spark.createDataFrame([(1, payload), (2, None)], "record_id long, payload binary")
    rows = [r for r in warc.chunk_table(table, 1000).collect() if r.record_id == 1]
    assert [r.chunk_no for r in rows] == [1, 2, 3] and [r.is_last for r in rows] == [False, False, True]
    for k, r in enumerate(rows):
        assert r.digest == hashlib.sha256(payload[: 1000 * (k + 1)]).hexdigest()
    assert b"".join(bytes(r.data) for r in rows) == payload


def test_reader_refuses_damage():
    page = {"record_id": 1, "url": None, "payload": b"z" * 50, "payload_bytes": 50, "refers_to": None}
    page["payload_digest"] = hashlib.sha256(page["payload"]).hexdigest()
    values = [v[len(warc.MARK) :] + b"\r\n\r\n" for v in warc._written(page, 20)]
    assert len(values) == 3
    for damaged in (values[:2], [values[0], values[2]], [values[0], values[1].replace(b"zz", b"zy"), values[2]]):
        reader = warc._Reader()
        try:
            for value in damaged:
                reader.feed(value)
            reader.end()
        except ValueError:
            continue
        raise AssertionError("damage went unnoticed")


def brute_measures(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    counts = Counter(windows)
    covered = {p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(ws),
        sum(map(len, ws)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_ledger_measures_and_bits(spark):
    docs = messy_documents(spark)
    rows = quality_rules.ledger(docs).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = Counter((r.doc_id, *[r[n] for n in names]) for r in rows)
    assert found == Counter((r.doc_id, *brute_measures(r.text)) for r in docs.collect())
    for r in rows:
        assert bool(r.failed & 1) == (r.n_words < 20)
        assert bool(r.failed & 2) == (100 * r.n_repeat_words > 30 * r.n_words)


def test_policies_and_ablation_come_from_the_bits(spark):
    judged = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 4), (5, 4)], "doc_id long, failed long")
    kept = {v: [r.doc_id for r in quality_rules.apply_policy(judged, v).filter("kept").orderBy("doc_id").collect()] for v in (1, 2)}
    assert kept == {1: [1, 4, 5], 2: [1]}
    only = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablation(judged, 2).collect()}
    assert only["too_few_words"] == (2, 1) and only["many_symbols"] == (2, 2) and only["shouting"] == (0, 0)


def test_empty_ledger(spark):
    assert quality_rules.ledger(no_documents(spark)).count() == 0


def test_clean_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.apply_policy(quality_rules.ledger(docs)).join(labels, "doc_id")
    clean, kept = F.col("quality") == 1, F.col("kept")
    row = judged.agg(
        F.count_if(clean & ~kept & (F.col("n_words") >= 20)).alias("lost"),
        F.count_if(~clean & kept).alias("missed"),
        F.count_if(~clean).alias("bad"),
    ).first()
    assert row.lost == 0 and row.missed <= 0.05 * row.bad
