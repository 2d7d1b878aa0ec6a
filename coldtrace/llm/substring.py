"""Exact removal of repeated word passages by recompression.

1. Every document is parsed into symbols (`recompress`). Names depend on content alone, so equal
   passages share their interior symbols in all tasks. Of each symbol of LONG words or more, every
   occurrence but the first is repeated text as a whole. Copies fall to a few high symbols each.
2. What is left are windows outside such symbols. Equal windows share an anchor, a phrase of symbols
   that only their own words determine: anchors seen once rule their windows out.
3. Windows of repeated anchors are compared by a 128-bit digest of their words; all but the first
   of equal ones are repeated text. A first window is never inside a symbol of step 1, since that
   symbol's earlier occurrence would hold an earlier one. So the result is exact.

Texts are dealt by row once, into a bucketed table; findings of the steps come to them as narrow
rows and the texts stay where they are. Findings are settled within a batch as far as they can be,
then dealt by name, sorted, and compared with the row before: a name that half of all documents
hold sends one row per batch, and no task holds a group in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.llm import recompress
from coldtrace.llm.arrays import blocks, mix, utf8, word_hashes, word_spans
from coldtrace.llm.common import bound_batches, dealt
from coldtrace.session import materialise, scratch_root

WINDOW = 20
LONG = 48
ROUNDS = 64

_BASES = [
    (b, np.uint64(pow(int(b), -1, 1 << 64)))
    for b in mix(np.arange(2, dtype=np.uint64), 61) | np.uint64(1)
]


def _digests(hashed: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Digest of the words from `starts` to `ends`; two independent ones make 128 bits."""
    base, inverse = _BASES[which]
    with np.errstate(over="ignore"):
        power = np.full(len(hashed) + 1, base, np.uint64)
        turned = np.full(len(hashed) + 1, inverse, np.uint64)
        power[0] = turned[0] = 1
        power, turned = np.cumprod(power, dtype=np.uint64), np.cumprod(turned, dtype=np.uint64)
        sums = np.zeros(len(hashed) + 1, np.uint64)
        np.cumsum(mix(hashed, 62 + which) * power[:-1], out=sums[1:], dtype=np.uint64)
        return mix((sums[ends] - sums[starts]) * turned[starts])


def _bucketed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) of documents with an id, dealt by row number."""
    spark = docs.sparkSession
    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    writer = rows.repartition(n, "row").write.bucketBy(n, "row").option("compression", "zstd")
    writer.option("path", f"{scratch_root(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def _with(texts: DataFrame, found: DataFrame, how: str = "left") -> DataFrame:
    """Texts and a list that was found for them; only the narrow side moves."""
    more = [c for c in found.columns if c != "row"]
    return texts.join(found, "row", how).select("row", "doc_id", "text", *more)


def _parsed(batch: pa.RecordBatch):
    """Per block of documents: first document, word hashes, words before each document."""
    data, offsets = utf8(batch.column(2))
    for first, part, at in blocks(data, offsets):
        starts, ends, words = word_spans(part, at)
        yield first, word_hashes(part, starts, ends), words


def _lists(column: pa.ListArray, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the lists of `n` rows from `first` on, and the row each belongs to."""
    part = column.slice(first, n)
    sizes = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return part.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(n), sizes)


def _behind_first(*keys: np.ndarray) -> np.ndarray:
    """Marks rows behind the first of their group, by (name, check, doc_id, start); ties are first."""
    name, check, doc_id, start = keys
    order = np.lexsort((start, doc_id, check, name))
    name, check, doc_id, start = (k[order] for k in keys)
    opens = np.ones(len(order), bool)
    opens[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
    head = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
    behind = np.empty(len(order), bool)
    behind[order] = (doc_id != doc_id[head]) | (start != start[head])
    return behind


PLACE = "name long, check long, row long, doc_id long, start int, end int"
PLACES = [c.split()[0] for c in PLACE.split(", ")]


def _settled(parts: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
    """Findings (name, check, document, start, end) of a batch; `later` marks what it can tell."""
    name, check, of, start, end = (np.concatenate(p) for p in zip(*parts))
    row, doc_id = (batch.column(k).to_numpy()[of] for k in (0, 1))
    columns = [name.view(np.int64), check.view(np.int64), row, doc_id, start.astype(np.int32), end.astype(np.int32)]
    later = _behind_first(*columns[:2], *columns[3:5])
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(later)], names=[*PLACES, "later"])


def _later(found: DataFrame) -> DataFrame:
    """(row, start, end) of findings with an earlier equal one: smaller document or start."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None  # name, check, document and start of the first of the running group
        for batch in batches:
            if not batch.num_rows:
                continue
            name, check, doc_id, start = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
            opens = np.ones(len(name), bool)
            opens[1:] = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
            if head is not None and head[:2] == (name[0], check[0]):
                opens[0] = False
            first = np.maximum.accumulate(np.where(opens, np.arange(len(name)), -1))
            seen = first >= 0
            behind = np.where(seen, (doc_id != doc_id[first]) | (start != start[first]), False)
            if head is not None:
                behind |= ~seen & ((doc_id != head[2]) | (start != head[3]))
            last = first[-1]
            if last >= 0:
                head = (name[last], check[last], doc_id[last], start[last])
            yield batch.select(["row", "start", "end"]).filter(pa.array(behind))

    open_ = found.filter(~F.col("later")).select(*PLACES)
    sorted_ = open_.repartition("name", "check").sortWithinPartitions("name", "check", "doc_id", "start")
    schema = "row long, start int, end int"
    return sorted_.mapInArrow(compared, schema).unionByName(found.filter("later").select("row", "start", "end"))


def _span(start, end):
    """Both ends in one number; lists of them are read as arrays by the Arrow functions."""
    return F.shiftleft(start.cast("long"), 32) + end.cast("long")


def _listed(rows: DataFrame, name: str, second: str = "end") -> DataFrame:
    """(row, spans): all spans of a row in one list, no longer than its text has words."""
    return rows.groupBy("row").agg(F.collect_list(_span(F.col("start"), F.col(second))).alias(name))


def _long_symbols(texts: DataFrame, least: int, window: int) -> DataFrame:
    """Findings: all symbols of `least` words or more.

    Inside a run all but its first period repeats the period before; that part is `later` at once.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, inner = [], []
            for first, hashed, words in _parsed(batch):
                if not len(hashed):
                    continue
                level = recompress.words_level(hashed, words)
                names, starts, ends, period = recompress.long_nodes(level, least, ROUNDS)
                of = np.searchsorted(words, starts, "right") - 1
                check = _digests(hashed, starts, ends, 0)
                parts.append((names, check, of + first, starts - words[of], ends - words[of]))
                runs = np.flatnonzero((period > 0) & (ends - starts - period >= window))
                inner.append(
                    (of[runs] + first, (starts + period - words[of])[runs], (ends - words[of])[runs])
                )
            if not parts:
                continue
            yield _settled(parts, batch)
            of, start, end = (np.concatenate(p) for p in zip(*inner))
            none = np.zeros(len(of), np.int64)
            columns = [none, none, *(batch.column(k).to_numpy()[of] for k in (0, 1))]
            columns += [start.astype(np.int32), end.astype(np.int32), np.ones(len(of), bool)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=[*PLACES, "later"])

    return texts.mapInArrow(found, PLACE + ", later boolean")


def _open_windows(
    words: np.ndarray, window: int, spans: np.ndarray, of: np.ndarray
) -> np.ndarray:
    """First words of all windows that lie in no span."""
    covered = np.zeros(words[-1] + 1, np.int32)
    np.add.at(covered, words[of] + (spans >> 32), 1)
    np.add.at(covered, words[of] + (spans & 0xFFFFFFFF) - window + 1, -1)
    counts = np.maximum(np.diff(words) - window + 1, 0)
    before = np.cumsum(counts) - counts
    windows = np.repeat(words[:-1] - before, counts) + np.arange(counts.sum())
    return windows[np.cumsum(covered)[windows] == 0]


def _anchor_runs(joined: DataFrame, window: int) -> DataFrame:
    """(name, row, start, n, repeated, asks): runs of `n` open windows with one anchor.

    `repeated` anchors stand more than once in their batch; the first of each name asks for it.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for first, hashed, words in _parsed(batch):
                windows = _open_windows(words, window, *_lists(batch.column(3), first, len(words) - 1))
                if not len(windows):
                    continue
                names, places = recompress.anchors(recompress.words_level(hashed, words), windows, window)
                opens = np.ones(len(windows), bool)
                opens[1:] = (
                    (names[1:] != names[:-1])
                    | (places[1:] != places[:-1])
                    | (windows[1:] != windows[:-1] + 1)
                )
                at = np.flatnonzero(opens)
                of = np.searchsorted(words, windows[at], "right") - 1
                counts = np.diff(np.append(at, len(windows)))
                parts.append((names[at], of + first, windows[at] - words[of], counts))
            if not parts:
                continue
            names, of, start, counts = (np.concatenate(p) for p in zip(*parts))
            _, one, which, times = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
            asks = np.zeros(len(names), bool)
            asks[one] = True
            columns = [names.view(np.int64), batch.column(0).to_numpy()[of], start.astype(np.int32)]
            columns += [counts.astype(np.int32), times[which] > 1, asks]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns)], names=["name", "row", "start", "n", "repeated", "asks"]
            )

    return joined.mapInArrow(
        found, "name long, row long, start int, n int, repeated boolean, asks boolean"
    )


def _candidates(runs: DataFrame) -> DataFrame:
    """(row, start, n) of the runs whose anchor stands elsewhere, too."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, which the next batch may belong to; and whether it is known
        columns = ["row", "start", "n"]
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays([*batch.columns], names=batch.schema.names)
            name, known = batch.column(0).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            same = name[1:] == name[:-1]
            twice = np.zeros(len(name), bool)
            twice[1:] |= same
            twice[:-1] |= same
            if held is not None:
                before, is_twice = held
                meets = before.column(0)[0].as_py() == name[0]
                twice[0] |= meets
                if (is_twice or meets) and not before.column(4)[0].as_py():
                    yield before.select(columns)
            settled = twice & ~known
            settled[-1] = False
            yield batch.select(columns).filter(pa.array(settled))
            held = batch.slice(len(name) - 1, 1), bool(twice[-1])
        if held is not None and held[1] and not held[0].column(4)[0].as_py():
            yield held[0].select(columns)

    asking = runs.filter("asks").select("name", "row", "start", "n", "repeated")
    answered = dealt(asking, ["name"]).mapInArrow(compared, "row long, start int, n int")
    return answered.unionByName(runs.filter("repeated").select("row", "start", "n"))


def _windows(joined: DataFrame, window: int) -> DataFrame:
    """Findings: the windows listed as runs in column 3."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for first, hashed, words in _parsed(batch):
                runs, of = _lists(batch.column(3), first, len(words) - 1)
                if not len(runs):
                    continue
                starts, counts = words[of] + (runs >> 32), runs & 0xFFFFFFFF
                before = np.cumsum(counts) - counts
                windows = np.repeat(starts - before, counts) + np.arange(counts.sum())
                document = np.repeat(of, counts)
                digests = [_digests(hashed, windows, windows + window, k) for k in (0, 1)]
                at = windows - words[document]
                parts.append((*digests, document + first, at, at + window))
            if parts:
                yield _settled(parts, batch)

    return joined.mapInArrow(found, PLACE + ", later boolean")


def _kept_words(joined: DataFrame) -> DataFrame:
    """(row, n_words, n_removed, kept): words outside all spans, one blank between; keeps doc_id, text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for k, text in enumerate(batch.column(2)):
                words = text.as_buffer().to_pybytes().split()
                sizes.append(len(words))
                spans = batch.column(3)[k].values
                if spans is not None and len(spans):
                    ends = spans.to_numpy(zero_copy_only=False)
                    inside = np.zeros(len(words) + 1, np.int32)
                    np.add.at(inside, ends >> 32, 1)
                    np.add.at(inside, ends & 0xFFFFFFFF, -1)
                    stays = np.flatnonzero(np.cumsum(inside)[:-1] == 0)
                    removed.append(len(words) - len(stays))
                    words = [words[i] for i in stays]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(4),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "version", "n_words", "n_removed", "kept"],
            )

    schema = "doc_id long, version long, n_words long, n_removed long, kept string"
    return joined.withColumn("version", F.xxhash64("text")).mapInArrow(cut, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, version, n_words, n_removed, kept) of every row of `docs` (doc_id, text).

    A word goes if a window of `window` words around it also starts earlier, in a document of smaller
    id or in the same one; windows are those of the input. `kept` holds the other words, `version`
    is xxhash64 of the text. NULL texts have no words. Rows without an id have no place in the order:
    they stay whole and nothing is judged by them. Equal rows of one id judge each other not.
    """
    bound_batches(docs.sparkSession)
    texts = _bucketed(docs)
    symbols = materialise(_long_symbols(texts, max(LONG, window), window))
    spans = materialise(_listed(_later(symbols), "spans"))
    runs = materialise(_anchor_runs(_with(texts, spans), window))
    candidates = _listed(_candidates(runs), "runs", "n")
    windows = materialise(_windows(_with(texts, candidates, "inner"), window))
    cuts = _listed(_later(windows), "cuts")
    none = F.array().cast("array<bigint>")
    both = spans.join(cuts, "row", "full").select(
        "row", F.concat(F.coalesce("spans", none), F.coalesce("cuts", none)).alias("all_spans")
    )
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("long").alias("row"),
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
        none.alias("all_spans"),
    )
    return _kept_words(_with(texts, both)).unionByName(_kept_words(nameless))
