from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import WORD
from pyspark.sql import functions as F

from coldtrace.llm import prefix_trie
from coldtrace.llm.queries import op11_prefix_table

SCHEMA = "conv_id long, turn long, role string, text string, conv string, k string, a string, depth string, n long"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def heads(conv):
    return conv - conv % 20, F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(4))


def brute(rows, borrow=True):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            turns.setdefault(c, []).append(((turn is not None, turn or 0), key, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(found)] for c, found in turns.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if borrow else 0
        built[c] = own.get(c - c % 20, [])[:h] + mine[h:]
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, held in members.items():
        below = [v for v in members if v[: len(node)] == node]
        kids = [v for v in members if len(v) == len(node) + 1 and v[:-1] == node]
        leaves = [v for v in below if not any(len(w) == len(v) + 1 and w[:-1] == v for w in members)]
        saved = sum((len(members[v]) - 1) * len(WORD.findall(v[-1][1])) for v in below if v)
        ends = sorted(c for c in held if len(built[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), len(kids), len(leaves), saved, digest))
    return sorted(out)


def conversations(seed: int, count: int = 40):
    draw = random.Random(seed)
    rows, trunk = [], [(draw.choice("ua"), f"t{k} x") for k in range(13)]
    for c in draw.sample(range(0, 90), count):
        if draw.random() < 0.4:  # a common beginning, copies among them
            path = trunk[: draw.choice([3, 13, 13, draw.randrange(14)])]
        else:
            path = [(draw.choice(["u", None]), draw.choice(["a b", "", None, "c\n d e"])) for _ in range(draw.randrange(1, 9))]
        turns = list(range(len(path)))
        if path and draw.random() < 0.2:
            turns[0] = None
        if len(path) > 2 and draw.random() < 0.2:
            turns[2] = turns[1]
        rows += [(c, turn, *x) for turn, x in zip(turns, path)]
    rows += rows[5:8]
    draw.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "1", "2", 7) for r in rows], SCHEMA).repartition(3)


def result(found):
    rows = [tuple(r) for r in found.select(*NAMES).collect()]
    return sorted(rows)


@pytest.mark.parametrize("seed, target, band", [(1, 1 << 18, 1 << 12), (2, 12, 3), (3, 9, 1)])
def test_same_as_brute_force(spark, seed, target, band):
    rows = conversations(seed) + [(None, 0, "u", "x")]
    found = prefix_trie.prefix_trie(frame(spark, rows), heads, target, band)
    assert result(found) == brute(rows)


def test_without_heads_and_a_long_conversation(spark):
    long = [(7, k, "u", f"w{k % 5} y") for k in range(400)]
    rows = long + [(9, *r[1:]) for r in long[:390]] + [(11, *r[1:]) for r in long[:400]] + [(3, 0, "u", "other")]
    found = prefix_trie.prefix_trie(frame(spark, rows), None, 50, 16)
    assert result(found) == brute(rows, borrow=False)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, []), heads).count() == 0


def test_test_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert result(op11_prefix_table(spark, folder)) == brute(rows)


def test_digests_go_on_over_a_cut(spark):
    rows = [(5, k, "u", f"t{k}") for k in range(60)] + [(6, 0, "u", "z")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = prefix_trie._numbered(frame(spark, rows))
        assert numbered.select("part").distinct().count() > 1
        turns = prefix_trie._turns(numbered).filter("conv = 5").orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [t.pos for t in turns] == list(range(1, 61))
    assert all((x.a, x.b) == (y.pa, y.pb) for x, y in zip(turns, turns[1:]))


def test_slots_are_minimal_and_verified():
    draw = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        high, low = draw.integers(0, 1 << 61, n), draw.integers(0, 1 << 61, n)
        table = prefix_trie.SlotTable(high, low)
        assert sorted(table.find(high, low).tolist()) == list(range(n))
        assert (table.find(high + 1, low) == -1).all()


def test_products_modulo_the_prime():
    draw = random.Random(0)
    values = [0, 1, prefix_trie.PRIME - 1] + [draw.randrange(prefix_trie.PRIME) for _ in range(200)]
    x, y = np.array(values, np.uint64), np.array(values[::-1], np.uint64)
    expected = [a * b % prefix_trie.PRIME for a, b in zip(values, values[::-1])]
    assert prefix_trie.times(x, y).tolist() == expected
    exponents = np.arange(50)
    assert prefix_trie.powers(12345, exponents).tolist() == [pow(12345, e, prefix_trie.PRIME) for e in range(50)]
