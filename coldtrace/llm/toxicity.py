"""Toxic passages as maximum-scoring segments of token log-odds.

A token's score is the log-odds of its rate in toxic against clean documents, lowered by their
standard error. Rates have Dirichlet priors: for the first letters of a token the counts of the whole corpus,
for longer beginnings and the token itself what the next shorter beginning says; rare and unseen
tokens are judged by how they begin. Tokens that are not clearly more frequent in toxic documents
cost a constant, so segments end where toxic tokens become sparse. A scan in linear time finds all maximal segments of a document, those that no longer stretch around
or inside them improves. Scores of the best segments of clean documents follow an extreme-value law
in the document's length; fitted to them, it tells how many segments of such a score chance brings.
A document is judged by the sum of its significant segments on that scale, turned into a probability
by logistic regression.

NULL and empty texts and texts without a letter have no token; their score is that of a document
without any evidence. Equal rows are scored alike; columns other than `text` are kept untouched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import mix
from coldtrace.llm.common import extended, small_side, uniform
from coldtrace.session import materialise

#: Lengths of the beginnings that a token is judged by, shortest first.
BEGINNINGS = (3, 4, 5, 6)
#: Buckets of counts, and those of the corpus counts of the shortest beginnings.
BUCKETS = 1 << 21
CORPUS_BUCKETS = 1 << 14
#: Weight of the corpus prior in tokens, and of a shorter beginning in occurrences.
CORPUS_WEIGHT = 1000.0
PRIOR_WEIGHT = 2.0
#: Weight, in occurrences, of the prior that a unit is as frequent in both classes.
EVEN_WEIGHT = 0.5
#: Occurrences from which a longer beginning, or the token, is judged by itself.
LEAST_COUNT = 3
#: Log-odds that a token needs to count as toxic (twice as frequent), and what any other token costs.
LEAST_ODDS = float(np.log(2))
COST = 0.1
#: Standard errors by which log-odds are lowered.
ERRORS = 1.0
#: Labelled documents of each class that the model is fitted on, about; drawn by id.
SAMPLE = 4000
#: Segments below this score are no finding.
LEAST_SCORE = 1.0
#: Expected number of chance segments up to which a segment is significant.
SIGNIFICANT = 0.05
THRESHOLD = 0.3
#: Code points of one block of documents.
BLOCK = 1 << 19


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point 0: no letter, 1: letter or mark, 2: a token of its own (ideographs, kana)."""
    kinds = np.zeros(0x110000, np.int8)
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] in "LM":
            kinds[code] = 1
    for begin, end in ((0x3040, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x40000)):
        kinds[begin:end] *= 2
    return kinds


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        text = (text or "").lower()
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


@dataclass
class Tokens:
    """Tokens of a block: place in it, hashes of token and beginnings, and per text those before it.

    A beginning as long as the token is missing: its hash is that of the token.
    """

    starts: np.ndarray
    ends: np.ndarray
    units: list[np.ndarray]
    edges: np.ndarray
    text_at: np.ndarray


def tokens(texts: list[str]) -> Tokens:
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _letters()[codes]
    text_at = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    inside = kinds > 0
    before = np.r_[False, inside[:-1]]
    alone, after_alone = kinds == 2, np.r_[False, kinds[:-1] == 2]
    starts = np.flatnonzero(inside & (~before | alone | after_alone))
    last = np.r_[~inside[1:] | alone[1:], True] | alone
    ends = np.flatnonzero(inside & last) + 1
    place = np.zeros(len(codes), np.uint64)
    if len(starts):
        since = np.searchsorted(starts, np.arange(len(codes)), "right") - 1
        place = (np.arange(len(codes)) - starts[np.maximum(since, 0)]).astype(np.uint64)
    with np.errstate(over="ignore"):
        turned = mix(mix(codes.astype(np.uint64), 3) + mix(place, 5), 7)
        sums = np.r_[np.uint64(0), np.cumsum(turned, dtype=np.uint64)]
        units = [mix(sums[np.minimum(starts + n, ends)] - sums[starts], 9) for n in BEGINNINGS]
        units.append(mix(sums[ends] - sums[starts], 9))
    return Tokens(starts, ends, units, np.searchsorted(starts, text_at), text_at)


def unit_buckets(found: Tokens) -> list[np.ndarray]:
    """Bucket of every token's beginnings and of the token; -1 where a beginning is the whole token."""
    size, out = found.ends - found.starts, []
    for level, unit in enumerate(found.units):
        bucket = (mix(unit, 11 + level) % np.uint64(BUCKETS)).astype(np.int64)
        if level < len(BEGINNINGS):
            bucket[size <= BEGINNINGS[level]] = -1
        out.append(bucket)
    return out


def corpus_buckets(found: Tokens) -> np.ndarray:
    return (found.units[0] % np.uint64(CORPUS_BUCKETS)).astype(np.int64)


@dataclass(frozen=True)
class Odds:
    """Occurrences of units in toxic and clean documents, and of first letters in the corpus."""

    toxic: np.ndarray
    clean: np.ndarray
    toxic_tokens: float
    clean_tokens: float
    corpus: np.ndarray

    def of(self, found: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of every token and their standard error, once per distinct token of the block."""
        _, first, back = np.unique(found.units[-1], return_index=True, return_inverse=True)
        once = Tokens(found.starts[first], found.ends[first], [u[first] for u in found.units], found.edges, found.text_at)
        labelled = max(1.0, self.toxic_tokens + self.clean_tokens)
        toxic_share = self.toxic_tokens / labelled
        share = np.full(len(first), toxic_share)  # of a unit's occurrences, in toxic documents
        frequency = np.maximum(self.corpus[corpus_buckets(once)], 1) / max(1.0, float(self.corpus.sum()))
        weight = CORPUS_WEIGHT * frequency
        odds, error = np.zeros(len(first)), np.zeros(len(first))
        even = np.log(max(self.clean_tokens, 1.0)) - np.log(max(self.toxic_tokens, 1.0))
        begun = np.zeros(len(first), bool)
        for bucket in unit_buckets(once):
            known = bucket >= 0
            a, b = (np.where(known, counts[np.maximum(bucket, 0)], 0) for counts in (self.toxic, self.clean))
            here = known & (~begun | (a + b >= LEAST_COUNT))
            # The first unit of a token rests on the corpus, each further one on the unit before.
            a = a + weight * share + EVEN_WEIGHT * toxic_share + 1e-9
            b = b + weight * (1 - share) + EVEN_WEIGHT * (1 - toxic_share) + 1e-9
            odds = np.where(here, np.log(a) - np.log(b) + even, odds)
            error = np.where(here, np.sqrt(1 / a + 1 / b), error)
            share = np.where(here, a / (a + b), share)
            begun |= known
            weight = np.where(begun, PRIOR_WEIGHT, weight)
        return odds[back], error[back]

    def scores(self, found: Tokens) -> np.ndarray:
        odds, error = self.of(found)
        low = odds - ERRORS * error
        return np.where(low > LEAST_ODDS, low, -COST)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of a sequence, in order.

    Runs of positive scores are candidates. A new one is joined with the nearest candidate that begins
    lower, when it also ends higher; the links between candidates make the search linear.
    """
    positive = np.r_[False, scores > 0, False]
    begins = np.flatnonzero(positive[1:] & ~positive[:-1])
    ends = np.flatnonzero(positive[:-1] & ~positive[1:])
    sums = np.r_[0.0, np.cumsum(scores)]
    first, last, low, high, lower = [], [], [], [], []
    for i, j, x, y in zip(begins.tolist(), ends.tolist(), sums[begins].tolist(), sums[ends].tolist()):
        while True:
            k = len(low) - 1
            while k >= 0 and low[k] >= x:
                k = lower[k]
            if k < 0 or high[k] >= y:
                break
            i, x = first[k], low[k]
            for column in (first, last, low, high, lower):
                del column[k:]
        first.append(i)
        last.append(j)
        low.append(x)
        high.append(y)
        lower.append(k)
    return [(i, j, y - x) for i, j, x, y in zip(first, last, low, high)]


@dataclass(frozen=True)
class Chance:
    """Extreme-value law: about `k * n * exp(-rate * s)` segments of n clean tokens reach score s."""

    rate: float = 1.0
    k: float = 0.1

    def evidence(self, score: float | np.ndarray, n: int | np.ndarray) -> float | np.ndarray:
        """Minus the logarithm of that number."""
        return self.rate * score - np.log(self.k * np.maximum(n, 1))


def fit_chance(best: np.ndarray, n: np.ndarray) -> Chance:
    """Most likely law of the best scores of clean documents of n tokens each."""
    used = n > 0
    best, n = best[used].astype(float), n[used].astype(float)
    if len(best) < 2 or best.max() <= best.min():
        return Chance()
    found = []
    for rate in np.geomspace(0.02, 20, 400):
        tail = n * np.exp(-rate * best)
        k = len(best) / tail.sum()
        found.append((len(best) * np.log(rate) + (np.log(k * n) - rate * best).sum(), rate, k))
    _, rate, k = max(found)
    return Chance(float(rate), float(k))


def total_evidence(found: list[float], n: int, chance: Chance) -> float:
    """Sum over the significant segments, else the greatest of the others."""
    if not found:
        return float(chance.evidence(0.0, n))
    evidence = chance.evidence(np.array(found), n)
    significant = evidence[evidence >= -np.log(SIGNIFICANT)]
    return float(significant.sum() if len(significant) else evidence.max())


def fit_logistic(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Offset and slope by Newton's steps, with a faint pull of both towards zero."""
    offset, slope = 0.0, 0.0
    spread = float(np.std(x)) or 1.0
    z = x / spread
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(offset + slope * z, -30, 30)))
        gap, curve = weights * (labels - p), weights * p * (1 - p) + 1e-9
        gradient = np.array([gap.sum() - 1e-3 * offset, (gap * z).sum() - 0.1 * slope])
        a, b, d = curve.sum() + 1e-3, (curve * z).sum(), (curve * z * z).sum() + 0.1
        step = np.linalg.solve(np.array([[a, b], [b, d]]), gradient)
        offset, slope = offset + np.clip(step[0], -2, 2), slope + np.clip(step[1], -2, 2)
    return float(offset), float(max(slope, 0.0) / spread)


@dataclass(frozen=True)
class Model:
    odds: Odds
    chance: Chance
    offset: float
    slope: float

    def passages(self, texts: list[str | None]) -> Iterator[tuple[float, int, list[tuple[int, int, float, float]]]]:
        """Per text its score, its tokens, and its significant passages.

        A passage has its first and one past its last code point, its score, and the number of such
        segments that chance brings.
        """
        for n, found in _found(self.odds, texts):
            total = total_evidence([s for _, _, s in found], n, self.chance)
            score = 1 / (1 + np.exp(-np.clip(self.offset + self.slope * total, -700, 700)))
            marked = []
            for i, j, s in found:
                expected = float(np.exp(-self.chance.evidence(s, n)))
                if expected <= SIGNIFICANT:
                    marked.append((i, j, s, expected))
            yield float(score), n, marked


def _found(odds: Odds, texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """Per text the number of tokens and the segments that score at all, in code points."""
    for block in _blocks(texts):
        found = tokens(block)
        scores = odds.scores(found)
        for k in range(len(block)):
            a, b = found.edges[k], found.edges[k + 1]
            out = []
            for i, j, s in segments(scores[a:b]):
                if s >= LEAST_SCORE:
                    at = found.text_at[k]
                    out.append((int(found.starts[a + i] - at), int(found.ends[a + j - 1] - at), float(s)))
            yield int(b - a), out


# -- fitting -------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned; rows without an id belong to them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """Tokens of all documents by their first letters, at most CORPUS_BUCKETS numbers."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CORPUS_BUCKETS, np.int64)
        for batch in batches:
            for block in _blocks(batch.column("text").to_pylist()):
                total += np.bincount(corpus_buckets(tokens(block)), minlength=CORPUS_BUCKETS)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": met, "n": total[met]})

    sums = docs.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, counts = sums.toArrow(), np.zeros(CORPUS_BUCKETS)
    counts[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return counts


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """About `sample` labelled documents of each class in two folds, and all labels by class."""
    usable = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    counts = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(sample / n)).otherwise(share)
    name = F.col("doc_id").cast("string")
    drawn = usable.filter(uniform(name, "toxic") < share).withColumn(
        "fold", (uniform(name, "fold") < 0.5).cast("int")
    )
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(small_side(drawn), "doc_id")
    return materialise(texts.dropDuplicates(["doc_id"]).select("text", "label", "fold")), counts


def _unit_counts(sampled: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, float, float]]:
    """Per fold the occurrences of units by class, and the tokens; at most 4 * BUCKETS numbers."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            text = batch.column("text").to_pylist()
            for cell in range(4):
                picked = [t for t, x, y in zip(text, label, fold) if 2 * y + x == cell]
                for block in _blocks(picked):
                    found = tokens(block)
                    every = np.concatenate([b[b >= 0] for b in unit_buckets(found)])
                    met, n = np.unique(every, return_counts=True)
                    # Tokens are counted beyond the buckets.
                    met, n = np.r_[met, BUCKETS], np.r_[n, len(found.starts)]
                    yield pa.RecordBatch.from_pydict(
                        {"cell": np.full(len(met), cell, np.int32), "bucket": met, "n": n}
                    )

    sums = sampled.mapInArrow(counted, "cell int, bucket long, n long").groupBy("cell", "bucket")
    table = sums.agg(F.sum("n").alias("n")).toArrow()
    cell, bucket, n = (table[c].to_numpy() for c in ("cell", "bucket", "n"))
    out = {}
    for fold in (0, 1):
        sides = []
        for label in (1, 0):
            counts = np.zeros(BUCKETS + 1, np.float32)
            on = cell == 2 * fold + label
            counts[bucket[on]] = n[on]
            sides.append(counts)
        toxic, clean = sides
        out[fold] = (toxic[:-1], clean[:-1], float(toxic[-1]), float(clean[-1]))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Corpus counts over all documents; everything else from about `sample` labelled ones a class.

    The sample's halves judge each other for the chance law and the final probability. Labels other
    than 0 and 1 and rows without an id are no labels; of two labels of an id the higher one holds.
    Without labels of both classes every score is the share of toxic labels, or 0.5 without any.
    """
    sampled, labelled = _sampled(docs, labels, sample)
    corpus = corpus_counts(docs)
    counts = _unit_counts(sampled)
    parts = {fold: Odds(*counts[fold], corpus) for fold in counts}
    whole = Odds(
        parts[0].toxic + parts[1].toxic, parts[0].clean + parts[1].clean,
        parts[0].toxic_tokens + parts[1].toxic_tokens, parts[0].clean_tokens + parts[1].clean_tokens, corpus,
    )
    prior = labelled.get(1, 0) / sum(labelled.values()) if labelled else 0.5
    if not labelled.get(0) or not labelled.get(1):
        prior = min(max(prior, 0.01), 0.99)
        return Model(whole, Chance(), float(np.log(prior / (1 - prior))), 0.0)
    shared = sampled.sparkSession.sparkContext.broadcast(parts)  # as large as the bucket tables

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            text = batch.column("text").to_pylist()
            for half in (0, 1):
                on = np.flatnonzero(fold == half)
                rows = list(_found(shared.value[1 - half], [text[k] for k in on]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "label": label[on],
                        "n": pa.array([n for n, _ in rows], pa.int64()),
                        "found": pa.array([[s for _, _, s in f] for _, f in rows], pa.list_(pa.float64())),
                    }
                )

    # One short row per sampled document.
    rows = sampled.mapInArrow(judged, "label int, n long, found array<double>").toArrow().to_pylist()
    label = np.array([r["label"] for r in rows])
    clean = [r for r in rows if r["label"] == 0]
    best = np.array([max(r["found"], default=0.0) for r in clean])
    chance = fit_chance(best, np.array([r["n"] for r in clean]))
    x = np.array([total_evidence(r["found"], r["n"], chance) for r in rows])
    drawn = np.bincount(label, minlength=2)
    weights = np.array([labelled[k] / max(1, drawn[k]) for k in (0, 1)])[label]
    if not drawn.all():
        return Model(whole, chance, float(np.log(prior / (1 - prior))), 0.0)
    return Model(whole, chance, *fit_logistic(x, label, weights * len(rows) / weights.sum()))


PASSAGES = "array<struct<begin:long,end:long,score:double,by_chance:double>>"


def score(docs: DataFrame, model: Model, name: str = "score", passages: str = "passages") -> DataFrame:
    """All columns of `docs`, the score of every whole text, and its significant passages.

    A passage is given by its first and one past its last code point in the lower-cased text, its score
    and the number of such segments expected by chance.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the bucket tables
    text_at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("by_chance", pa.float64())]))
    keys = ("begin", "end", "score", "by_chance")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(shared.value.passages(batch.column(text_at).to_pylist()))
            scores = pa.array([s for s, _, _ in rows], pa.float64())
            marked = pa.array([[dict(zip(keys, m)) for m in found] for _, _, found in rows], kind)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores, marked], names=[*batch.schema.names, name, passages]
            )

    return docs.mapInArrow(scored, extended(docs.schema, **{name: "double", passages: PASSAGES}))
