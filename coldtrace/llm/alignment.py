"""Tokens of two tokenizers aligned by the bytes they cover.

Every document is tokenized whole by both. Byte offsets where tokens of both end and both next tokens
begin with a blank are anchors; they cut the document into windows, mostly words. A window's alignment
depends on its ids alone and is remembered by them, within a task. The groups of a document are those
of its windows, one after the other.

How many documents hold a pair of ids linked is counted over all documents: blocks of documents, an
Arrow batch each, add up their own distinct pairs first, so a pair costs a row per block. The counts
go back to the blocks in the same form, where they are summed per window and then per document.

NULL and empty texts, and texts that the tokens of either tokenizer do not spell byte by byte, have
no tokens: zeros, and an empty `groups_sha256`. Equal rows are documents of their own. Columns other
than `doc_id` and `text` are ignored.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import mix
from coldtrace.llm.common import bound_batches
from coldtrace.session import materialise

# Fixed value: how byte-level vocabularies of this kind split a text before merging.
PARTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Windows that a task remembers before it begins anew with the next block.
REMEMBERED = 3 << 16
#: Bytes of a block of documents, about.
BLOCK = "4m"
#: Bytes of a row group of the table of blocks.
ROW_GROUP = 32 << 20
#: Four bytes that are no id, between the ids of both sides of a window.
NO_ID = b"\xff" * 4
#: An id pair as one number: ids of the second tokenizer have so many bits.
BITS = 20
#: Links of a group beyond which its ids are counted before they are paired.
WIDE = 64


def byte_of_symbol() -> dict[str, int]:
    """Byte that each symbol of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others for the code points from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizer:
    """Ids of a text, and per id the number of its bytes, whether they begin with a blank, its digits."""

    def _spelled(self, spelling: list[bytes]) -> None:
        self.size = np.array([len(s) for s in spelling], np.int64)
        self._bytes = np.frombuffer(b"".join(spelling), np.uint8)
        self._at = np.cumsum(self.size) - self.size
        self.blank = np.array([s[:1] == b" " for s in spelling])
        self.name = [str(number) for number in range(len(spelling))]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        return self._bytes[places + np.repeat(self._at[ids] - (ends - sizes), sizes)]


class ByteLevel(Tokenizer):
    """A byte-level vocabulary, read from its file and applied by ranks.

    Ids of such a vocabulary are in the order of its merges, so joining the pair of least rank gives the
    same tokens as its list of merges, several times as fast.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        symbols, special = byte_of_symbol(), {token["id"] for token in described["added_tokens"]}
        vocabulary = described["model"]["vocab"]
        ranks = {
            bytes(symbols[c] for c in token): number for token, number in vocabulary.items() if number not in special
        }
        self._of = tiktoken.Encoding("byte level", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        spelling = [b""] * (max(vocabulary.values()) + 1)
        for token, number in ranks.items():
            spelling[number] = token
        self._spelled(spelling)

    def ids(self, text: str) -> np.ndarray:
        return self._of.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int32)


class Pieces(Tokenizer):
    def __init__(self, path: str):
        import sentencepiece

        self._of = sentencepiece.SentencePieceProcessor(model_file=path)
        spelling = []
        for number in range(self._of.get_piece_size()):
            piece = self._of.id_to_piece(number)
            is_byte = self._of.is_byte(number)
            spelling.append(bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode())
        self._spelled(spelling)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._of.encode(text), np.int32)


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> tuple[Tokenizer, Tokenizer]:
    """Loaded once per Python worker."""
    return ByteLevel(path_a), Pieces(path_b)


def linked_pairs(ga: list[int], gb: list[int], found: dict[int, int]) -> None:
    """Adds to `found` how often each id pair of a group is linked.

    A pair is one number, the second id in its lowest BITS bits.
    """
    if len(ga) * len(gb) <= WIDE:
        for p in ga:
            p <<= BITS
            for q in gb:
                found[p | q] = found.get(p | q, 0) + 1
    else:
        counted = Counter(gb)
        for p, n in Counter(ga).items():
            for q, m in counted.items():
                found[p << BITS | q] = found.get(p << BITS | q, 0) + n * m


class Windows:
    """Alignments of the windows met so far, by their ids."""

    def __init__(self, first: Tokenizer, second: Tokenizer):
        self.first, self.second = first, second
        self.size_a, self.size_b = first.size.tolist(), second.size.tolist()
        self.clear()

    def forget(self) -> None:
        """Between two blocks: begins anew if too much is remembered."""
        if len(self.known) > REMEMBERED:
            self.clear()

    def numbers(self, a: np.ndarray, b: np.ndarray, ends: Iterable[tuple[int, int, int, int]]) -> list[int]:
        """Numbers of the windows of ids i to j of `a` and k to m of `b`, for every (i, j, k, m)."""
        bytes_a, bytes_b = a.tobytes(), b.tobytes()
        known, width_a, width_b, numbers = self.known, a.itemsize, b.itemsize, []
        for i, j, k, m in ends:
            key = bytes_a[i * width_a : j * width_a] + NO_ID + bytes_b[k * width_b : m * width_b]
            found = known.get(key)
            # Ids become Python numbers for new windows only, not for the whole block.
            numbers.append(self._add(key, a[i:j].tolist(), b[k:m].tolist()) if found is None else found)
        return numbers

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.text: list[str] = []
        self.groups, self.links = array("q"), array("q")
        self.edges, self.pairs, self.times = array("q", [0]), array("q"), array("q")

    def _add(self, key: bytes, a: list[int], b: list[int]) -> int:
        """Aligns a window: a group ends at each place where tokens of both sides end."""
        size_a, size_b, name_a, name_b = self.size_a, self.size_b, self.first.name, self.second.name
        found: dict[int, int] = {}
        # Pairs of the groups of one token on either side, which most groups are.
        single = []
        text, links = [], 0
        i = j = x = y = begin_a = begin_b = 0
        for p in a:
            x += size_a[p]
            i += 1
            while y < x:
                y += size_b[b[j]]
                j += 1
            if x != y:
                continue
            if i - begin_a == 1 == j - begin_b:
                q = b[begin_b]
                text.append(name_a[p] + "|" + name_b[q])
                single.append(p << BITS | q)
            else:
                ga, gb = a[begin_a:i], b[begin_b:j]
                text.append(",".join([name_a[p] for p in ga]) + "|" + ",".join([name_b[q] for q in gb]))
                linked_pairs(ga, gb, found)
                links += len(ga) * len(gb)
            begin_a, begin_b = i, j
        if found or len(set(single)) < len(single):
            for pair in single:
                found[pair] = found.get(pair, 0) + 1
        else:
            found = dict.fromkeys(single, 1)
        self.text.append(";".join(text))
        self.groups.append(len(text))
        self.links.append(links + len(single))
        self.pairs.extend(found)
        self.times.extend(found.values())
        self.edges.append(len(self.pairs))
        number = self.known[key] = len(self.known)
        return number


@dataclass
class Spelled:
    """The texts of a block whose tokens spell them, one after the other: ids and where texts begin."""

    rows: np.ndarray
    a: np.ndarray
    b: np.ndarray
    edges_a: np.ndarray
    edges_b: np.ndarray


def spelled_texts(first: Tokenizer, second: Tokenizer, texts: list[str | None]) -> Spelled:
    """Tokenizes whole texts and keeps those that the tokens of both sides spell byte by byte."""
    rows, ids = [], []
    for row, text in enumerate(texts):
        if text:
            spelling = b" " + text.encode()
            a, b = first.ids(text), second.ids(text)
            if first.size[a].sum() == len(spelling) == second.size[b].sum():
                # Text by text: places in the spellings take many times the bytes of what is compared.
                if first.bytes_of(a).tobytes() == spelling == second.bytes_of(b).tobytes():
                    rows.append(row)
                    ids.append((a, b))
    edges = [np.r_[0, np.cumsum([len(x[side]) for x in ids])].astype(np.int64) for side in (0, 1)]
    return Spelled(np.array(rows, np.int64), _joined([x[0] for x in ids]), _joined([x[1] for x in ids]), *edges)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _hashes(ids: np.ndarray, cuts: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of the ids from every cut to the next one."""
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
        back = np.uint64(pow(int(base), -1, 1 << 64))
        # The powers of one base exist at a time.
        sums = np.zeros(len(ids) + 1, np.uint64)
        terms = mix(ids.astype(np.uint64), seed)
        terms *= _powers(base, len(ids))[1:]
        np.cumsum(terms, out=sums[1:])
        del terms
        lengths = np.diff(cuts).astype(np.uint64)
        return mix((sums[cuts[1:]] - sums[cuts[:-1]]) * _powers(back, len(ids))[cuts[:-1]] + lengths, seed + 1)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(count + 1, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, out=powers)


def windows_of(first: Tokenizer, second: Tokenizer, found: Spelled) -> tuple[np.ndarray, np.ndarray]:
    """Where windows begin, and at last end, in the ids of either side.

    A window begins where a token of both sides does and both begin with a blank; each text begins one,
    with the blank in front of it.
    """
    marked_a, starts_a = _blanks(first, found.a)
    marked_b, starts_b = _blanks(second, found.b)
    _, at_a, at_b = np.intersect1d(starts_a, starts_b, assume_unique=True, return_indices=True)
    return np.r_[marked_a[at_a], len(found.a)], np.r_[marked_b[at_b], len(found.b)]


def _blanks(side: Tokenizer, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ids that begin with a blank, and the bytes before each of them."""
    marked = np.flatnonzero(side.blank[ids])
    sizes = side.size[ids]
    return marked, np.cumsum(sizes)[marked] - sizes[marked]


def numbered_windows(memory: Windows, found: Spelled, cuts_a: np.ndarray, cuts_b: np.ndarray) -> np.ndarray:
    """Number of every window of a block; equal ones, told by 128 bits of their ids, are looked up once."""
    if len(cuts_a) < 2:
        return np.zeros(0, np.int64)
    hash_a, hash_b = _hashes(found.a, cuts_a, 41), _hashes(found.b, cuts_b, 43)
    seed = 0
    while True:
        with np.errstate(over="ignore"):
            both = mix(hash_a + mix(hash_b, seed), seed)
        _, at, back = np.unique(both, return_index=True, return_inverse=True)
        if (hash_a == hash_a[at][back]).all() and (hash_b == hash_b[at][back]).all():
            break
        seed += 1
    # Read one number at a time: as lists they would take five times the bytes.
    ends = zip(*map(memoryview, (cuts_a[at], cuts_a[at + 1], cuts_b[at], cuts_b[at + 1])))
    return np.array(memory.numbers(found.a, found.b, ends), np.int64)[back]


def _spread(edges: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places edges[k] to edges[k+1] of every k in `of`, one after the other, and their numbers."""
    sizes = edges[of + 1] - edges[of]
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(edges[of] - (ends - sizes), sizes)
    return places, sizes


ALIGNED = (
    "block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, windows array<int>, repeats array<int>, "
    # Of the whole block, in its first row: pairs of each window, and documents of each pair.
    "edges array<int>, window_pairs array<long>, window_times array<long>, "
    "pairs array<long>, holders array<long>"
)


def align_block(memory: Windows, block: int, doc_ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
    """One row per document of a block: its figures, and its windows by their number in the block."""
    memory.forget()
    found = spelled_texts(memory.first, memory.second, texts)
    cuts_a, cuts_b = windows_of(memory.first, memory.second, found)
    numbers = numbered_windows(memory, found, cuts_a, cuts_b)
    # Seen in place: nothing is added to the memory from here on.
    edges, pairs, times, groups, links = (
        np.frombuffer(x, np.int64) for x in (memory.edges, memory.pairs, memory.times, memory.groups, memory.links)
    )
    n, count = len(texts), len(found.rows)
    # Windows of a text stand together; a text begins where one of them does.
    begins = np.searchsorted(cuts_a[:-1], found.edges_a)
    figures = {"n_a": np.diff(found.edges_a), "n_b": np.diff(found.edges_b)}
    for name, values in (("n_groups", groups), ("n_links", links)):
        running = np.r_[0, np.cumsum(values[numbers])] if len(numbers) else np.zeros(1, np.int64)
        figures[name] = running[begins[1:]] - running[begins[:-1]]
    digests = [""] * n
    for row, i, j in zip(found.rows.tolist(), begins[:-1].tolist(), begins[1:].tolist()):
        whole = ";".join([memory.text[k] for k in numbers[i:j].tolist()])
        digests[row] = hashlib.sha256(whole.encode()).hexdigest()
    used, local = np.unique(numbers, return_inverse=True)
    of_text = np.repeat(np.arange(count), np.diff(begins))
    once, often = np.unique(of_text * max(1, len(used)) + local, return_counts=True)
    text_of, window = np.divmod(once, max(1, len(used)))
    # Distinct pairs of each text, and in how many texts of the block each pair stands.
    places, sizes = _spread(edges, used)
    distinct, rank = np.unique(pairs[places], return_inverse=True)
    of_window = np.r_[0, np.cumsum(sizes)]
    spread, repeated = _spread(of_window, window)
    held = rank[spread]
    del spread
    held += np.repeat(text_of, repeated) * max(1, len(distinct))
    # Sorted in place: many times as fast as the hash table of np.unique.
    held.sort()
    held = held[np.r_[True, held[1:] != held[:-1]]] if len(held) else held
    holders = np.bincount(held % max(1, len(distinct)), minlength=len(distinct))

    def in_rows(values: np.ndarray) -> pa.Array:
        out = np.zeros(n, np.int64)
        out[found.rows] = values
        return pa.array(out)

    per_row = np.zeros(n, np.int64)
    per_row[found.rows] = np.bincount(text_of, minlength=count)
    offsets = pa.array(np.r_[0, np.cumsum(per_row)].astype(np.int32))
    lists = lambda values: pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))
    once_a_block = lambda values, kind: pa.array([values] + [None] * (n - 1), pa.list_(kind))
    columns = {
        "block": pa.array(np.full(n, block)),
        "row": pa.array(np.arange(n, dtype=np.int32)),
        "doc_id": doc_ids,
        **{name: in_rows(values) for name, values in figures.items()},
        "groups_sha256": pa.array(digests, pa.string()),
        "windows": lists(window),
        "repeats": lists(often),
        "edges": once_a_block(of_window.astype(np.int32), pa.int32()),
        "window_pairs": once_a_block(pairs[places], pa.int64()),
        "window_times": once_a_block(times[places], pa.int64()),
        "pairs": once_a_block(distinct, pa.int64()),
        "holders": once_a_block(holders, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the number in each row."""
    lists = column.combine_chunks()
    counts = np.array([len(x) for x in lists], np.int64)
    return lists.flatten().to_numpy(), counts


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def sum_block(docs: pa.Table, counted: pa.Table) -> pa.Table:
    """Sums of the corpus counts over the links of every document of a block."""
    first = int(np.argmin(docs["row"].to_numpy()))
    edges = np.array(docs["edges"][first].as_py(), np.int64)
    pairs = docs["window_pairs"][first].values.to_numpy()
    times = docs["window_times"][first].values.to_numpy()
    order = np.argsort(counted["pair"].to_numpy())
    at = np.searchsorted(counted["pair"].to_numpy()[order], pairs)
    windows, of_doc = _flat(docs["windows"])
    repeats, _ = _flat(docs["repeats"])
    ends = np.cumsum(of_doc)
    sums = {}
    for name, column in (("count_sum", "n"), ("n_best", "best")):
        weight = counted[column].to_numpy().astype(np.int64)[order]
        running = np.r_[0, np.cumsum(times * weight[at])] if len(pairs) else np.zeros(1, np.int64)
        per_window = running[edges[1:]] - running[edges[:-1]]
        running = np.r_[0, np.cumsum(per_window[windows] * repeats)]
        sums[name] = running[ends] - running[ends - of_doc]
    kept = {n: docs[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(
        kept | {"n_best": sums["n_best"], "count_sum": sums["count_sum"], "groups_sha256": docs["groups_sha256"]}
    )


def align(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Aligned documents, one row each, and the corpus counts of linked id pairs (`a`, `b`, `n`, `best`).

    `path_a` is a byte-level vocabulary of the tokenizers library, `path_b` a sentencepiece model.
    """
    spark = docs.sparkSession
    bound_batches(spark, BLOCK)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory = Windows(*_tokenizers(path_a, path_b))
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(b for b in batches if b.num_rows):
            texts = batch.column("text").to_pylist()
            yield align_block(memory, (part << 32) + number, batch.column("doc_id"), texts)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # A row of this table holds megabytes: with small row groups a task keeps few of them until it writes.
    blocks = materialise(narrow.mapInArrow(aligned, ALIGNED), **{"parquet.block.size": ROW_GROUP})
    of_block = blocks.filter("row = 0").select("block", F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
    of_block = of_block.select("block", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    counts = materialise(of_block.groupBy("pair").agg(F.sum("holders").alias("n")))
    first_id = F.shiftright("pair", BITS)
    # At most a row per id of the first vocabulary.
    highest = counts.groupBy(first_id.alias("a")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("a", first_id).join(F.broadcast(highest), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )
    known = of_block.join(counts, "pair").select(F.col("block").alias("of"), "pair", "n", "best")
    wanted = blocks.drop("pairs", "holders").groupBy("block")
    result = wanted.cogroup(known.groupBy("of")).applyInArrow(sum_block, RESULT)
    named = counts.select(
        F.shiftright("pair", BITS).alias("a"),
        F.col("pair").bitwiseAND((1 << BITS) - 1).alias("b"),
        "n",
        "best",
    )
    return result, named
