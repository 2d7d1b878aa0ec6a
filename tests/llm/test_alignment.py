from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from cases import messy_documents, messy_texts, no_documents, sentence

from coldtrace.llm import alignment
from coldtrace.llm.queries import op12_anchored_windows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def other_tokens():
    """Tokens by the vocabularies' own libraries, and their bytes by the pieces' texts."""
    first = tokenizers.Tokenizer.from_file(A)
    first.encode_special_tokens = True
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    spelled = {int(n): base64.b64decode(x) for x, n in map(bytes.split, lines)}
    second = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(token):
        text = second.id_to_piece(token)
        return bytes.fromhex(text[3:5]) if second.is_byte(token) else text.replace("▁", " ").encode()

    def tokens(text):
        a = [(t, spelled[t]) for t in first.encode(" " + text, add_special_tokens=False).ids]
        return a, [(t, piece(t)) for t in second.encode(text)]

    return tokens


def brute(rows):
    tokens, links, held = other_tokens(), [], Counter()
    out = []
    for doc_id, text in rows:
        a, b = tokens(text) if text else ([], [])
        whole = (b" " + text.encode()) if text else b""
        if not text or any(b"".join(x for _, x in side) != whole for side in (a, b)):
            out.append([doc_id, 0, 0, 0, 0, 0, 0, ""])
            links.append(Counter())
            continue
        ends = []
        for side in (a, b):
            at, total = {}, 0
            for k, (_, spelled) in enumerate(side):
                total += len(spelled)
                at[total] = k + 1
            ends.append(at)
        groups, i, j = [], 0, 0
        for place in sorted(ends[0].keys() & ends[1].keys()):
            k, m = ends[0][place], ends[1][place]
            groups.append(([t for t, _ in a[i:k]], [t for t, _ in b[j:m]]))
            i, j = k, m
        found = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        links.append(found)
        held.update(found.keys())
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append([doc_id, len(a), len(b), len(groups), found.total(), 0, 0, hashlib.sha256(text.encode()).hexdigest()])
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for row, found in zip(out, links):
        row[5] = sum(n for p, n in found.items() if held[p] == most[p[0]])
        row[6] = sum(n * held[p] for p, n in found.items())
    return sorted(map(tuple, out), key=str), held


def result(found):
    return sorted((tuple(r) for r in found.select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("block", ["4m", "2k"])
def test_same_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    docs = messy_documents(spark)
    odd = ["a▁b", "<s> <0x41> </s>", "\x00\x01", " lead", "trail  ", "tab\tand\r\nlines", "a" * 500, "漢字かな" * 40, "é 😀👍🏽"]
    more = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    found, counts = alignment.align(docs, A, B)
    expected, held = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(found) == expected
    assert {(r.a, r.b): r.n for r in counts.collect()} == dict(held)


def test_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert result(op12_anchored_windows(spark, folder)) == brute(rows)[0]


def test_empty_table(spark):
    found, counts = alignment.align(no_documents(spark), A, B)
    assert found.count() == 0 and counts.count() == 0


def test_windows_are_remembered_and_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    draw = random.Random(3)
    texts = [sentence(draw, 30) for _ in range(20)] + messy_texts()[:5]
    memory = alignment.Windows(*alignment._tokenizers(A, B))
    import pyarrow as pa

    ids = pa.array(range(len(texts)), pa.int64())
    first, second = (alignment.align_block(memory, 0, ids, texts).drop_columns(["windows"]) for _ in range(2))
    assert first.equals(second) and len(memory.known) > 50
    found = alignment.spelled_texts(memory.first, memory.second, ["w1 w1 w1", None, "w2 w1"])
    number = alignment.numbered_windows(memory, found, *alignment.windows_of(memory.first, memory.second, found))
    assert number[0] == number[1] == number[2] == number[4] != number[3] and found.rows.tolist() == [0, 2]


def test_a_block_does_not_copy_the_memory():
    memory = alignment.Windows(*alignment._tokenizers(A, B))
    texts = ["one two", "three"]
    ids = pa.array([1, 2])
    plain = alignment.align_block(memory, 0, ids, texts)
    for held in (memory.pairs, memory.times):
        held.extend(range(1 << 19))
    tracemalloc.start()
    again = alignment.align_block(memory, 0, ids, texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert again == plain
    assert peak < 1 << 21
    assert all(isinstance(key, bytes) for key in memory.known)


def test_a_block_takes_few_bytes_for_each_of_its_texts():
    draw = random.Random(5)
    texts = [sentence(draw, 400) for _ in range(300)]
    memory = alignment.Windows(*alignment._tokenizers(A, B))
    ids = pa.array(range(len(texts)), pa.int64())
    once = alignment.align_block(memory, 0, ids, texts)
    tracemalloc.start()
    again = alignment.align_block(memory, 0, ids, texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert again == once
    assert peak < 45 * sum(map(len, texts))


def test_wide_groups_are_counted():
    found = {}
    alignment.linked_pairs([1, 2, 1] * 5, [7] * 9, found)
    assert found == {1 << alignment.BITS | 7: 90, 2 << alignment.BITS | 7: 45}


def test_ranks_give_the_merged_tokens():
    from conftest import SF_DIR
    import duckdb

    rows = duckdb.sql(f"SELECT text FROM '{SF_DIR.replace('0.001', '0.01')}/documents.parquet' WHERE text IS NOT NULL").fetchall()
    own = tokenizers.Tokenizer.from_file(A)
    own.encode_special_tokens = True
    ranked = alignment.ByteLevel(A)
    texts = [t for (t,) in rows] + [t for t in messy_texts() if t] + ["   a\t \n b'll don't '' x1y2 \u00a0\x85 \x1c z", "<|endoftext|>"]
    for text in texts:
        assert ranked.ids(text).tolist() == own.encode(" " + text, add_special_tokens=False).ids


def test_windows_of_equal_and_repeated_pairs():
    memory = alignment.Windows(*alignment._tokenizers(A, B))
    first, second = memory.first, memory.second
    found = alignment.spelled_texts(first, second, ["a a a a b", "a a a a b", "----" * 40])
    ends = list(zip(found.edges_a[:-1].tolist(), found.edges_a[1:].tolist(), found.edges_b[:-1].tolist(), found.edges_b[1:].tolist()))
    numbers = memory.numbers(found.a, found.b, ends)
    assert numbers == [0, 0, 1] and memory.numbers(found.a, found.b, ends) == numbers
    for number, (i, j, k, m) in zip((0, 1), (ends[0], ends[2])):
        at = slice(memory.edges[number], memory.edges[number + 1])
        pairs, times = memory.pairs[at], memory.times[at]
        # Every pair once, and all links of the window counted.
        assert len(set(pairs)) == len(pairs) and sum(times) == memory.links[number]
        assert {p >> alignment.BITS for p in pairs} == set(found.a[i:j].tolist())
        assert {p & (1 << alignment.BITS) - 1 for p in pairs} == set(found.b[k:m].tolist())
    assert max(memory.times[: memory.edges[1]]) > 1
