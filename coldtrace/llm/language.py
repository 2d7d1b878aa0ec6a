"""Language identification: words first, then ever shorter character n-grams.

A word known from training is scored by its log frequency in each language. An unseen word falls
back to its longest n-grams that are known in any language, then to shorter ones.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.common import small_side, uniform

#: Documents of each language that the model is fitted on, about; drawn by id.
SAMPLE = 800
#: A word counts as known from so many occurrences in the sample on.
KNOWN = 3
GRAMS = (5, 4, 3, 2, 1)
#: Unseen words whose scores a task remembers; beyond it, it forgets them all and starts again.
REMEMBER = 200_000
UNKNOWN = "und"

_RUNS = re.compile(r"[^\W\d_]+")
_FLOOR = 0.5


def letters(text: str | None) -> list[str]:
    return _RUNS.findall(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    row_of: dict[str, int]
    rows: np.ndarray
    gram_of: dict[str, int]
    gram_rows: np.ndarray
    unseen: np.ndarray
    _later: dict[str, int] = field(default_factory=dict)
    _later_rows: np.ndarray | None = None

    def backed_off(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's n-grams of the longest length of which any is known."""
        return self.all_backed_off([word])[0]

    def all_backed_off(self, words: list[str]) -> np.ndarray:
        """The scores of many words, their n-grams averaged at once."""
        get, picked, counts = self.gram_of.get, [], []
        for word in words:
            for n in GRAMS:
                known = [at for at in map(get, grams(word, n)) if at is not None]
                if known:
                    break
            picked += known
            counts.append(len(known))
        found = np.array(counts, np.intp)
        rows = np.repeat(self.unseen[None, :], len(words), axis=0)
        some = found > 0
        if picked:
            starts = (np.cumsum(found) - found)[some]
            sums = np.add.reduceat(self.gram_rows.take(picked, axis=0), starts, axis=0)
            rows[some] = sums / found[some][:, None]
        return rows

    def _places(self, words: list[str]) -> list[int]:
        """Where the scores of so many unseen words lie in `_later_rows`, at most REMEMBER of them."""
        if len(self._later) + len(words) > REMEMBER and len(self._later) + len(set(words)) > REMEMBER:
            self._later.clear()
        if self._later_rows is None:
            self._later_rows = np.empty((1024, len(self.languages)))
        places = list(map(self._later.get, words))
        if None in places:
            first = len(self._later)
            fresh = list(dict.fromkeys(word for word, at in zip(words, places) if at is None))
            self._later.update(zip(fresh, range(first, first + len(fresh))))
            while len(self._later_rows) < len(self._later):
                self._later_rows = np.concatenate([self._later_rows, np.empty_like(self._later_rows)])
            self._later_rows[first : len(self._later)] = self.all_backed_off(fresh)
            places = list(map(self._later.get, words))
        return places

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text; `und` and 0 without a letter or without training."""
        names, scores = [], np.zeros(len(texts))
        if not self.languages:
            return [UNKNOWN] * len(texts), scores
        for k, text in enumerate(texts):
            found = letters(text)
            if not any(ch.isalpha() for run in found for ch in run):
                names.append(UNKNOWN)
                continue
            total = np.zeros(len(self.languages))
            places = list(map(self.row_of.get, found))
            later = []
            if None in places:
                later = [word for word, at in zip(found, places) if at is None]
                places = [at for at in places if at is not None]
            if places:
                total += self.rows.take(places, axis=0).sum(axis=0)
            for first in range(0, len(later), REMEMBER):
                more = self._places(later[first : first + REMEMBER])
                # Added to the total one after the other.
                total = np.vstack([total, self._later_rows.take(more, axis=0)]).sum(axis=0)
            odds = np.exp(total - total.max())
            best = int(np.argmax(odds))
            names.append(self.languages[best])
            scores[k] = odds[best] / odds.sum()
        return names, scores


def fit(counts: list[tuple[str, str, int]]) -> Model:
    """Model of (word, language, occurrences)."""
    languages = sorted({language for _, language, _ in counts})
    place = {language: k for k, language in enumerate(languages)}
    words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    parts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    for word, language, n in counts:
        words[word][place[language]] += n
        for length in GRAMS:
            for gram in grams(word, length):
                parts[gram][place[language]] += n
    totals = sum(words.values(), np.zeros(len(languages))) + 1
    known = sorted(w for w, c in words.items() if c.sum() >= KNOWN)
    rows = np.zeros((len(known), len(languages)))
    for k, word in enumerate(known):
        rows[k] = np.log((words[word] + _FLOOR) / totals)
    by_length: Counter = Counter()
    length_totals: dict[int, np.ndarray] = {n: np.zeros(len(languages)) for n in GRAMS}
    for gram, c in parts.items():
        length_totals[len(gram)] += c
        by_length[len(gram)] += 1
    common = [g for g, c in parts.items() if c.sum() >= KNOWN]
    gram_rows = np.zeros((len(common), len(languages)))
    for k, g in enumerate(common):
        smoothed = length_totals[len(g)] + _FLOOR * by_length[len(g)]
        gram_rows[k] = np.log((parts[g] + _FLOOR) / smoothed)
    return Model(
        languages,
        {w: k for k, w in enumerate(known)},
        rows,
        {g: k for k, g in enumerate(common)},
        gram_rows,
        np.zeros(len(languages)),
    )


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from; rows without an id belong to them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on about `sample` documents of each language, drawn by id, held-out ones left out."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = usable.groupBy("lang").agg(F.count("*").alias("__n"))
    drawn = usable.join(small_side(sizes), "lang").filter(
        uniform(F.col("doc_id").cast("string"), "fit") < F.lit(sample) / F.col("__n")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((word, language) for word in letters(text))
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array([w for w, _ in counts], pa.string()),
                    "lang": pa.array([x for _, x in counts], pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )

    words = drawn.select("text", "lang").mapInArrow(counted, "word string, lang string, n long")
    total = words.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    table = total.toArrow()  # of a bounded sample
    return fit(sorted(zip(*[table[c].to_pylist() for c in ("word", "lang", "n")])))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; repeated rows are judged one by one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the sample makes it

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judged, f"doc_id {kind}, lang_pred string, score double")
