"""Quality classifier on supervised subword embeddings.

A document is the average of the vectors of its words and of their character n-grams, all hashed
into one table of buckets; a softmax layer on the average gives the class. Vectors and layer are
trained together by stochastic gradient descent in numpy. As average and layer are linear, a
bucket's share in the difference of the two classes is one number: documents are scored with that
table, which has the size of the bucket table whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import mix
from coldtrace.llm.common import extended, small_side, uniform

BUCKETS = 1 << 16
DIMENSION = 8
GRAMS = (3, 4)
RECURS = 4
EPOCHS = 6
RATE = 2.0
#: Labelled documents of each class that the model is fitted on, about; drawn by id.
SAMPLE = 2000
THRESHOLD = 0.3
#: Code points of one block of documents while features are made.
BLOCK = 1 << 19

_WHITE = np.array([0x20, *range(0x09, 0x0E)], np.uint32)


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature, and per document the number of features before it.

    Features are the words, within a word and the blank on either side all n-grams, and pairs of
    equal words up to RECURS words apart, which share a bucket for each distance.
    """
    joined = " " + " ".join(texts) + " "
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
    white = np.isin(codes, _WHITE)
    codes[white] = 32
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=edges[1:])
    scrambled = mix(codes.astype(np.uint64), 3)
    at, buckets = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            count = len(codes) - n + 1
            if count <= 0:
                continue
            inside = np.ones(count, bool)
            value = np.zeros(count, np.uint64)
            for k in range(n):
                value = value * np.uint64(0x100000001B3) + scrambled[k : k + count]
                if 0 < k < n - 1:
                    inside &= ~white[k : k + count]
            first = np.flatnonzero(inside)
            at.append(first)
            buckets.append(mix(value[first], n) % np.uint64(BUCKETS))
        starts = np.flatnonzero(~white[1:] & white[:-1]) + 1
        ends = np.flatnonzero(white[1:] & ~white[:-1]) + 1
        if len(starts):
            # Words by the sum of their scrambled characters, each turned by its place.
            place = np.arange(len(codes)) - np.repeat(
                np.r_[0, starts], np.diff(np.r_[0, starts, len(codes)])
            )
            turned = mix(scrambled + mix(place.astype(np.uint64), 5), 7)
            sums = np.r_[np.uint64(0), np.cumsum(turned, dtype=np.uint64)]
            words = mix(sums[ends] - sums[starts], 9)
            at.append(starts)
            buckets.append(words % np.uint64(BUCKETS))
            of = np.searchsorted(edges, starts, "right")
            for back in range(1, RECURS + 1):
                same = np.flatnonzero((words[back:] == words[:-back]) & (of[back:] == of[:-back]))
                at.append(starts[same + back])
                recurs = mix(np.full(len(same), back, np.uint64), 13)
                buckets.append(recurs % np.uint64(BUCKETS))
    if not at:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    at, buckets = np.concatenate(at), np.concatenate(buckets).astype(np.int32)
    order = np.argsort(at, kind="stable")
    return buckets[order], np.searchsorted(at[order], edges)


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        text = text or ""
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


@dataclass(frozen=True)
class Model:
    """`weights`: each bucket's share in the logit of class 1 against class 0; `bias`: the rest."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of class 1; a text without features has that of its bias."""
        out = []
        for block in _blocks(texts):
            buckets, edges = _features(block)
            sums = np.r_[0.0, np.cumsum(self.weights[buckets], dtype=np.float64)]
            counts = np.diff(edges)
            out.append((sums[edges[1:]] - sums[edges[:-1]]) / np.maximum(counts, 1))
        logits = np.concatenate(out) + self.bias if out else np.zeros(0)
        return 1 / (1 + np.exp(-logits))


def fit(texts: list[str], labels: np.ndarray, prior: float = 0.5, seed: int = 0) -> Model:
    """Trains vectors and layer; `prior` is the share of class 1 where the model is to be used.

    Without labels of both classes the score is the prior of the only class, or 0.5.
    """
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        prior = 0.5 if not len(labels) else (0.99 if labels[0] == 1 else 0.01)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior))))
    draws = np.random.default_rng(seed)
    vectors = draws.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    layer = np.zeros((2, DIMENSION))
    documents = []
    for block in _blocks(texts):
        buckets, edges = _features(block)
        for a, b in zip(edges[:-1], edges[1:]):
            ids, counts = np.unique(buckets[a:b], return_counts=True)
            documents.append((ids, counts / max(1, b - a)))
    steps, step = EPOCHS * len(documents), 0
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    for _ in range(EPOCHS):
        for k in draws.permutation(len(documents)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, shares = documents[k]
            if not len(ids):
                continue
            hidden = shares @ vectors[ids]
            logits = layer @ hidden
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[labels[k]] -= 1
            error *= balance[labels[k]]
            back = layer.T @ error
            layer -= rate * np.outer(error, hidden)
            # Shares of a document add up to one; the square root keeps rare features moving.
            vectors[ids] -= rate * np.sqrt(shares)[:, None] * back / np.sqrt(shares).sum()
    weights = (vectors @ (layer[1] - layer[0])).astype(np.float32)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    return Model(weights, float(np.log(prior / (1 - prior))))


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are not learned; rows without an id belong to them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on about `sample` labelled documents of each class, drawn by id, held-out ones left out.

    Labels other than 0 and 1 and rows without an id are no labels; of two labels of an id the
    lower one holds.
    """
    usable = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
    )
    counts = {r.label: r.n for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(sample / n)).otherwise(share)
    drawn = small_side(usable.filter(uniform(F.col("doc_id").cast("string"), "fit") < share))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(drawn, "doc_id")
    rows = texts.select("doc_id", "text", "label").dropDuplicates(["doc_id"])
    schema = "weights binary, bias double"
    arrow = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("label", pa.int32())])
    prior = counts.get(1, 0) / max(1, sum(counts.values()))

    def fit_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, arrow).sort_by("doc_id")
        model = fit(table["text"].to_pylist(), table["label"].to_numpy(), prior)
        yield pa.RecordBatch.from_pydict(
            {"weights": [model.weights.tobytes()], "bias": [model.bias]},
            schema=pa.schema([("weights", pa.binary()), ("bias", pa.float64())]),
        )

    # One task by design: the sample is bounded, and descent takes one step after the other.
    shaped = rows.select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int"))
    fitted = shaped.coalesce(1).mapInArrow(fit_once, schema).first()
    if fitted is None:  # not a row, so not a task
        return fit([], np.zeros(0))
    return Model(np.frombuffer(fitted.weights, np.float32), fitted.bias)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of `docs` and the score of every whole text; NULL and empty texts have one too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the bucket table
    text_at = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(shared.value.scores(batch.column(text_at).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, values], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(scored, extended(docs.schema, **{name: "double"}))
