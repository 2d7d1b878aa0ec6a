"""Bounded-space online packing of tokenized documents.

Each partition is packed in one pass with a fixed number of open sequences: a piece goes where it
leaves the least room; if it fits nowhere, the fullest open sequence is emitted to make place. The
sequences still open at the end of a partition are merged: over groups of partitions first, so that
no task gets more of them than a bound, at last in one group that cuts pieces to fill sequences.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import blocks, utf8, word_hashes, word_spans
from coldtrace.llm.common import bound_batches
from coldtrace.session import materialise

LENGTH = 4096
#: Open sequences of a partition.
OPEN = 64
#: Partitions whose open sequences are merged in one task.
FAN_IN = 16
END = 2
#: Words, and parts of words, whose ids a task remembers; further ones are tokenized as they come.
REMEMBER = 2_000_000
PARTS = 250_000
#: New words that join the remembered ones at a time.
LOT = 50_000
#: Bytes of ids in one batch of pieces.
BATCH = 8 << 20

# Letters that case folding and normalization treat one by one, and marks other than apostrophes.
_CUT = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

FIELDS = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids", pa.binary()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("is_open", pa.bool_()),
    ("part", pa.int64()),
]
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, is_open boolean, part long"
)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Known:
    """Ids of the words met so far, by the words' hashes, in sorted arrays of about 30 bytes a word.

    New words wait in a dictionary and join the arrays in lots. Beyond REMEMBER words the arrays
    stay as they are.
    """

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<u4")
        self.waiting: dict[int, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def find(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes the arrays hold, and where."""
        if not len(self.hashes):
            return np.zeros(len(distinct), bool), np.zeros(len(distinct), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return self.hashes[at] == distinct, at

    def add(self, words: dict[int, bytes]) -> None:
        self.waiting.update(words)
        if len(self.waiting) < LOT:
            return
        if len(self.hashes) < REMEMBER:
            hashes = np.fromiter(self.waiting, np.uint64, len(self.waiting))
            sizes = np.fromiter(map(len, self.waiting.values()), np.int64, len(hashes)) // 4
            begins = len(self.pool) + np.cumsum(sizes) - sizes
            fresh = np.frombuffer(b"".join(self.waiting.values()), "<u4")
            self.pool = np.concatenate([self.pool, fresh])
            order = np.argsort(hashes)
            at = np.searchsorted(self.hashes, hashes[order])
            self.hashes = np.insert(self.hashes, at, hashes[order])
            self.begins = np.insert(self.begins, at, begins[order])
            self.sizes = np.insert(self.sizes, at, sizes[order])
        self.waiting = {}


@lru_cache(maxsize=2)
def _remembered(path: str) -> _Known:
    return _Known()


def _gathered(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of `pool`, one after the other."""
    upto = np.cumsum(sizes)
    total = int(upto[-1]) if len(upto) else 0
    return pool[np.repeat(begins - upto + sizes, sizes) + np.arange(total)]


def _as_bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _parts_ids(parts: set[str], tokenizer) -> dict[str, bytes]:
    """Ids of parts that are letters only, or marks only: the former in one call, by word number."""
    letters = [p for p in parts if p[:1].isalpha()]
    found = {}
    if letters:
        encoded = tokenizer.encode(" ".join(letters), add_special_tokens=False)
        ids, word = np.array(encoded.ids, "<u4"), np.array(encoded.word_ids)
        at = np.searchsorted(word, np.arange(len(letters) + 1))
        data = ids.tobytes()
        found = {p: data[4 * a : 4 * b] for p, a, b in zip(letters, at[:-1].tolist(), at[1:].tolist())}
    for part in parts:
        if part not in found:
            found[part] = _as_bytes(tokenizer.encode(part, add_special_tokens=False).ids) if part else b""
    return found


def _new_words(words: set[bytes], path: str) -> dict[bytes, bytes]:
    """Ids of words not met before: letters and the marks behind them are tokens of their own."""
    tokenizer, parts = _tokenizer(path), _remembered(path).parts
    cut, whole = {}, []
    for word in words:
        match = _CUT(word.decode())
        if match:
            cut[word] = (match[1].lower(), match[2])
        else:
            whole.append(word)
    fresh = _parts_ids({p for both in cut.values() for p in both if p not in parts}, tokenizer)
    parts.update(fresh)
    found = {word: parts[letters] + parts[marks] for word, (letters, marks) in cut.items()}
    if len(parts) > PARTS:
        for part in fresh:
            del parts[part]
    if whole:
        encoded = tokenizer.encode_batch([w.decode() for w in whole], add_special_tokens=False)
        found.update((word, _as_bytes(e.ids)) for word, e in zip(whole, encoded))
    return found


def token_ids(texts: pa.Array, path: str) -> Iterator[bytes]:
    """Ids of each text as little-endian 32-bit numbers, without the end id; NULL has none.

    No token of the tokenizer spans ASCII white space, so each distinct word of a block of texts is
    tokenized once, or remembered by its 64-bit hash, and the texts' ids are gathered from that.
    """
    known = _remembered(path)
    data, offsets = utf8(texts)
    for _, part, at in blocks(data, offsets):
        starts, ends, first = word_spans(part, at)
        distinct, one, which = np.unique(
            word_hashes(part, starts, ends), return_index=True, return_inverse=True
        )
        held, place = known.find(distinct)
        others = np.flatnonzero(~held)
        names = distinct[others].tolist()
        ids = list(map(known.waiting.get, names))
        new = [k for k, found in enumerate(ids) if found is None]
        if new:
            whole, at_new = part.tobytes(), one[others[new]]
            words = [whole[a:b] for a, b in zip(starts[at_new].tolist(), ends[at_new].tolist())]
            fresh = _new_words(set(words), path)
            for k, word in zip(new, words):
                ids[k] = fresh[word]
        sizes = np.zeros(len(distinct), np.int64)
        sizes[held] = known.sizes[place[held]]
        sizes[others] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        # The block's own pool: what is remembered, then the rest.
        old = _gathered(known.pool, known.begins[place[held]], sizes[held])
        pool = np.concatenate([old, np.frombuffer(b"".join(ids), "<u4")])
        begins = np.zeros(len(distinct), np.int64)
        begins[held] = np.cumsum(sizes[held]) - sizes[held]
        begins[others] = len(old) + np.cumsum(sizes[others]) - sizes[others]
        counts = sizes[which]
        stream = _gathered(pool, begins[which], counts).tobytes()
        known.add({names[k]: ids[k] for k in new})
        cuts = (4 * np.concatenate([[0], np.cumsum(counts)])[first]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield stream[a:b]


class Packer:
    """Best fit over at most `most` open sequences. Pieces are tuples of the first five FIELDS."""

    def __init__(self, part: int, level: int, length: int = LENGTH, most: int = OPEN):
        self.part, self.length, self.most = part, length, most
        self.first_id = (level << 56) | (part << 32)
        self.made = 0
        self.room: list[tuple[int, int]] = []  # (room left, key), ascending
        self.held: dict[int, list[tuple]] = {}
        self.keys = 0

    def _close(self, pieces: list[tuple], is_open: bool = False) -> list[tuple]:
        rows, offset = [], 0
        for piece in pieces:
            rows.append((*piece, self.first_id + self.made, offset, is_open, self.part))
            offset += piece[2]
        self.made += 1
        return rows

    def add(self, piece: tuple) -> list[tuple]:
        """Places a piece; rows of the sequences that this closes."""
        size, rows = piece[2], []
        at = bisect_left(self.room, (size, -1))
        if at < len(self.room):
            room, key = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                _, fullest = self.room.pop(0)
                rows += self._close(self.held.pop(fullest))
            self.keys += 1
            room, key = self.length, self.keys
            self.held[key] = []
        self.held[key].append(piece)
        if room == size:
            rows += self._close(self.held.pop(key))
        else:
            insort(self.room, (room - size, key))
        return rows

    def rest(self, is_open: bool) -> list[tuple]:
        """Rows of what is still open."""
        rows = [r for _, key in self.room for r in self._close(self.held.pop(key), is_open)]
        self.room = []
        return rows


def pieces_of(doc_id: int | None, ids: bytes, length: int = LENGTH) -> list[tuple]:
    """A document's full sequences and its remainder."""
    tokens = len(ids) // 4
    return [
        (doc_id, a, min(length, tokens - a), ids[4 * a : 4 * (a + length)], tokens)
        for a in range(0, tokens, length)
    ]


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0
    schema = pa.schema(FIELDS)

    def batch():
        columns = [pa.array(c, f.type) for c, f in zip(zip(*kept), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        kept.append(row)
        size += len(row[3]) + 64
        if size >= BATCH:
            yield batch()
            kept, size = [], 0
    if kept:
        yield batch()


def _fill(pieces: list[tuple], packer: Packer) -> Iterator[tuple]:
    """Fills sequences to the brim, cutting the piece that reaches past the end."""
    held, used = [], 0
    for doc_id, start, length, ids, tokens in pieces:
        while length:
            take = min(length, packer.length - used)
            held.append((doc_id, start, take, ids[: 4 * take], tokens))
            start, length, ids, used = start + take, length - take, ids[4 * take :], used + take
            if used == packer.length:
                yield from packer._close(held)
                held, used = [], 0
    if held:
        yield from packer._close(held)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, most: int = OPEN) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most `length` tokens.

    `ids` holds a piece's tokens. A document's tokens end with the id END; a NULL or empty text has
    that id alone. Rows that repeat, with or without an id, are documents of their own. Other
    columns are ignored; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"), "text", F.spark_partition_id().cast("long").alias("part")
    )
    end = np.array([END], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed():
            packer = None
            for batch in batches:
                if packer is None:
                    if not batch.num_rows:
                        continue
                    packer = Packer(batch.column(2)[0].as_py(), 0, length, most)
                texts = token_ids(batch.column(1), tokenizer)
                for doc_id, ids in zip(batch.column(0).to_pylist(), texts):
                    for piece in pieces_of(doc_id, ids + end, length):
                        yield from packer.add(piece)
            if packer is not None:
                yield from packer.rest(True)

        yield from _batches(placed())

    level = materialise(rows.mapInArrow(packed, SCHEMA))
    done, number = level.filter(~F.col("is_open")), 0
    while True:
        waiting = level.filter("is_open")
        last = waiting.agg(F.max("part").alias("m")).first().m
        if last is None:
            return done
        number += 1
        groups = int(last) // FAN_IN + 1
        level = _merge(waiting, groups, number, length, most)
        if groups == 1:
            return done.unionByName(level)
        level = materialise(level)
        done = done.unionByName(level.filter(~F.col("is_open")))


def _merge(waiting: DataFrame, groups: int, level: int, length: int, most: int) -> DataFrame:
    """Packs open sequences of FAN_IN partitions anew, largest pieces first.

    A group holds at most FAN_IN * `most` sequences. The last group leaves nothing open.
    """

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        part = table["group"][0].as_py()
        names = [name for name, _ in FIELDS[:5]]
        pieces = list(zip(*[table[name].to_pylist() for name in names]))
        pieces.sort(key=lambda p: (-p[2], p[0] is None, p[0], p[1], p[3]))
        packer = Packer(part, level, length, most)

        def placed():
            if groups == 1:
                yield from _fill(pieces, packer)
                return
            for piece in pieces:
                yield from packer.add(piece)
            yield from packer.rest(True)

        yield from _batches(placed())

    grouped = waiting.withColumn("group", F.floor(F.col("part") / FAN_IN).cast("long"))
    return grouped.groupBy("group").applyInArrow(_as_table(merged), SCHEMA)


def _as_table(merged):
    schema = pa.schema(FIELDS)
    return lambda table: pa.Table.from_batches(list(merged(iter(table.to_batches()))), schema)
