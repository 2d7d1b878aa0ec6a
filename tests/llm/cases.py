"""Awkward rows that all operators meet in the tests, and small reference versions."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "size slot shard score kept id a b key name version part n start center label words".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in EXTRA
)


def sentence(draw: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def messy_texts(seed: int = 1) -> list[str | None]:
    """NULL, blank, short, very long, copied, nearly copied and periodic texts."""
    draw = random.Random(seed)
    shared = sentence(draw, 70)
    texts = [None, "", " \t\n\x0b\f\r ", "one", "One two", "a b c d e f g h", "  x y"]
    texts += [sentence(draw, draw.randrange(5, 200)) for _ in range(25)]
    texts += [shared, shared, f"{sentence(draw, 30)} {shared} {sentence(draw, 9)}", shared + " tail"]
    near = shared.split()
    for _ in range(8):
        changed = list(near)
        changed[draw.randrange(len(changed))] = "other"
        texts.append(" ".join(changed))
    texts += ["na " * 90, "na " * 61 + "x", "ab cd " * 50, "x y z\n" * 40, sentence(draw, 9000, 3000)]
    texts += [sentence(draw, 60, 2) for _ in range(3)] + ["Straße ÉCOLE naïve ﬁn don't <|endoftext|> #*$%&|<>!! 你好"]
    return texts


def messy_documents(spark, seed: int = 1, ids: bool = True):
    """Documents with those texts, NULLs in every column, repeated rows, and clashing columns."""
    draw = random.Random(seed)
    texts = messy_texts(seed)
    draw.shuffle(texts)
    rows = []
    for k, text in enumerate(texts):
        lang = draw.choice(["en", "de", None])
        source = draw.choice(["hot", "hot", "b", "é", "", None])
        rows.append((k * 3 + 1, text, lang, source, None, *[draw.choice(["7", None])] * len(EXTRA)))
    rows += rows[5:9]
    if ids:
        rows += [(None, t, None, None, None, *[None] * len(EXTRA)) for t in (None, "", texts[12], texts[12])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def components(nodes, linked) -> dict:
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}
