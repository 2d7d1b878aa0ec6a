"""Recompression of word sequences: parse levels and locally determined anchors, in numpy.

Each round names maximal runs of one symbol, then pairs of a left and a right symbol; sides are
drawn from the symbol's name and the round. A name is a hash of what it stands for, so all tasks
of all machines give equal stretches of words the same symbols without exchanging anything, but for
symbols near the ends of a stretch, which may join with what stands outside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from coldtrace.llm.arrays import hash_pairs, mix

#: Rounds without run naming between the first and this one keep more of a window determined.
RUNS_FROM = 7
#: Anchors are phrases of so many symbols after so many rounds.
ANCHOR_ROUNDS = 2
ANCHOR_SYMBOLS = 3


@dataclass
class Level:
    """Symbols of a block of documents: names, first words, and whether one ends its document."""

    names: np.ndarray
    starts: np.ndarray
    last: np.ndarray
    n_words: int

    def ends(self) -> np.ndarray:
        return np.append(self.starts[1:], self.n_words)


def words_level(hashed: np.ndarray, first: np.ndarray) -> Level:
    """Words as symbols; `first` holds per document the number of words before it, and the total."""
    last = np.zeros(len(hashed), bool)
    closing = first[1:][np.diff(first) > 0] - 1
    last[closing] = True
    return Level(hashed, np.arange(len(hashed)), last, len(hashed))


def name_runs(level: Level) -> tuple[Level, np.ndarray]:
    """Maximal runs of one symbol as one symbol each; also how many symbols each one holds."""
    n = len(level.names)
    opens = np.ones(n, bool)
    opens[1:] = (level.names[1:] != level.names[:-1]) | level.last[:-1]
    at = np.flatnonzero(opens)
    counts = np.diff(np.append(at, n))
    names = level.names[at]
    many = np.flatnonzero(counts > 1)
    if len(many):
        names[many] = hash_pairs(mix(names[many], 31), counts[many].astype(np.uint64))
    return Level(names, level.starts[at], level.last[at + counts - 1], level.n_words), counts


def is_right(names: np.ndarray, round_: int) -> np.ndarray:
    return mix(names, 40 + round_) >> np.uint64(63) == 1


def name_pairs(level: Level, right: np.ndarray) -> tuple[Level, np.ndarray]:
    """Left symbols joined with a right one behind them; also which of the new symbols are pairs."""
    n = len(level.names)
    joins = np.zeros(n, bool)
    joins[:-1] = ~right[:-1] & right[1:] & ~level.last[:-1]
    kept = np.ones(n, bool)
    kept[1:] = ~joins[:-1]
    names = level.names.copy()
    at = np.flatnonzero(joins)
    names[at] = hash_pairs(names[at], names[at + 1])
    last = level.last.copy()
    last[at] = level.last[at + 1]
    return Level(names[kept], level.starts[kept], last[kept], level.n_words), joins[kept]


def long_nodes(level: Level, least: int, rounds: int):
    """Symbols of at least `least` words, once each: (names, starts, ends, period).

    `period` is the length of what a run repeats, 0 for pairs.
    """
    found = []
    for round_ in range(rounds):
        if round_ == 0 or round_ >= RUNS_FROM:
            level, counts = name_runs(level)
            ends = level.ends()
            at = np.flatnonzero((counts > 1) & (ends - level.starts >= least))
            sizes = ends[at] - level.starts[at]
            found.append((level.names[at], level.starts[at], ends[at], sizes // counts[at]))
        level, paired = name_pairs(level, is_right(level.names, round_))
        ends = level.ends()
        at = np.flatnonzero(paired & (ends - level.starts >= least))
        found.append((level.names[at], level.starts[at], ends[at], np.zeros(len(at), np.int64)))
        if level.last.all():
            break
    return tuple(np.concatenate(parts) for parts in zip(*found))


def anchors(level: Level, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, given by its first word, a phrase of symbols that only its words determine.

    From a window's left end on, a symbol is certain once nothing outside can join it: the first
    run may go on outside, and a right symbol may join with one outside. The right end mirrors
    this. The symbols in between occur wherever the window's words do. Of the phrases of
    ANCHOR_SYMBOLS symbols among them, the first of the least hash is taken; if there are fewer
    symbols, all of them, and if none, the window's first word. Returns names and first words:
    equal windows have equal names, at the same place.
    """
    names, places = level.names[windows].copy(), windows.copy()
    from_, to = windows, windows + width
    live = np.arange(len(windows))
    n = level.n_words
    for round_ in range(ANCHOR_ROUNDS):
        at = np.zeros(n + 1, np.int64)
        at[level.starts] = np.arange(len(level.starts))
        at[n] = len(level.starts)
        first, end = at[from_], at[to]
        if round_ == 0:
            runs, counts = name_runs(level)
            of = np.repeat(np.arange(len(counts)), counts)
            first, end = of[first] + 1, of[end - 1]
            level = runs
        right = is_right(level.names, round_)
        padded = np.append(right, False)
        first = first + padded[np.minimum(first, len(right))]
        end = end - ~right[np.maximum(end - 1, 0)]
        certain = np.flatnonzero(first < end)
        starts = np.append(level.starts, n)
        live, from_, to = live[certain], starts[first[certain]], starts[end[certain]]
        level, _ = name_pairs(level, right)
    at = np.zeros(n + 1, np.int64)
    at[level.starts] = np.arange(len(level.starts))
    at[n] = len(level.starts)
    first, count = at[from_], at[to] - at[from_]
    phrase = level.names
    for m in range(1, ANCHOR_SYMBOLS + 1):
        if m > 1:
            phrase = hash_pairs(phrase[:-1], level.names[m - 1 :])
        mine = np.flatnonzero(count == m if m < ANCHOR_SYMBOLS else count >= m)
        least, where = phrase[first[mine]], first[mine].copy()
        open_ = np.arange(len(mine))
        for k in range(1, int(count.max(initial=m)) - m + 1):
            open_ = open_[count[mine[open_]] >= m + k]
            at_k = first[mine[open_]] + k
            other = phrase[at_k]
            lower = other < least[open_]
            least[open_[lower]] = other[lower]
            where[open_[lower]] = at_k[lower]
        names[live[mine]] = mix(least, 50 + m)
        places[live[mine]] = level.starts[where]
    return names, places
