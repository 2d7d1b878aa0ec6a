"""Word boundaries and hashes of Arrow text columns as numpy arrays, a block of documents at a time.

Used inside Arrow functions: nothing here knows Spark. Words are what ASCII white space leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Documents are handled in blocks of about so many bytes, so that memory doesn't follow the batch.
BLOCK = 1 << 20
#: Words of more bytes are hashed one by one: polynomials modulo 2**64 are weak for long strings.
LONG = 64

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(256, dtype=np.uint64), 11)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    name = str(base)
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        table = np.cumprod(steps, dtype=np.uint64)
        if n > 4 * BLOCK:  # kept for the usual sizes only
            return table
        _powers[name] = table
    return _powers[name][:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = column.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, offsets) of runs of whole documents of about BLOCK bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per document the number of words before it."""
    white = _WHITE[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0] = after[-1] = True
        before[1:], after[:-1] = white[:-1], white[1:]
        edges = offsets[1:-1]
        before[edges[edges < len(data)]] = True
        after[edges[edges > 0] - 1] = True
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(~white & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _power(_BASE, len(data)), out=sums[1:], dtype=np.uint64)
        plain = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
        hashed = mix(plain ^ mix((ends - starts).astype(np.uint64)))
    for k in np.flatnonzero(ends - starts > LONG):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        hashed[k] = int.from_bytes(digest, "little")
    return hashed


def hash_pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit name of an ordered pair of 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(mix(left, 1) * np.uint64(0xFF51AFD7ED558CCD) + right, 2)
