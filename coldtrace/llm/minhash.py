"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature holds PLACES minimum hashes of 16 bits. Its places are split into CHUNKS chunks; by the
pigeonhole principle two signatures that differ in at most DISTANCE places agree on some chunk but
for DISTANCE // CHUNKS places, here one. Each chunk is therefore indexed once for every place that
may be wrong, with that place left out: any two signatures within DISTANCE share a key. Signatures
of sets with a Jaccard similarity of 0.8 differ in 9.6 places on average, and in more than DISTANCE
with a probability of 0.00005; such a link is lost unless other links join its ends.

Equal sets are one class from the start. Among classes that share a key, links are sought where
they still matter: twice, each class is compared with one hub of its buckets. Then signatures alone
join classes within DISTANCE to families, and in each family the members outside its largest
component are compared with all others: a link between two components has such an end. A member
travels once for every block of those it meets, and blocks are filled by bytes, so families below a
block cost their size. All links are confirmed on the full sets; of a crowd of copies, or of texts
that are nearly similar enough, pairs are compared inside tasks and never written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import blocks, hash_pairs, lower_ascii, mix, utf8, word_hashes, word_spans
from coldtrace.llm.common import bound_batches, dealt, grouped, salted_join, small_side
from coldtrace.llm.components import components
from coldtrace.session import materialise

PLACES = 48
CHUNKS = 11
DISTANCE = 21
SIMILARITY = (80, 100)
STAR_ROUNDS = 2
#: Members that are compared with as many others at a time.
BLOCK = 512
#: Bytes of signatures of a bucket, and of sets of a family, that a task holds of either side.
BUCKET_BYTES = 1 << 18
FAMILY_BYTES = 8 << 20
#: Bytes of the sets of a task as bits, beyond which pairs are compared one by one.
BITSET_BYTES = 64 << 20

_MASKS = mix(np.arange(PLACES, dtype=np.uint64), 21)
_FACTORS = mix(np.arange(PLACES, dtype=np.uint64), 22) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `words` words, A-Z in lower case.

    A text of fewer words has its whole sequence as one; without words the set is empty.
    """
    data, offsets = utf8(column)
    for _, part, at in blocks(data, offsets):
        part = lower_ascii(part)
        starts, ends, first = word_spans(part, at)
        hashed = word_hashes(part, starts, ends)
        rolled = hashed
        for k in range(1, words):
            if len(hashed) > k:
                rolled = hash_pairs(rolled[: len(hashed) - k], hashed[k:])
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                whole = hashed[a : a + 1]
                for k in range(a + 1, b):
                    whole = hash_pairs(whole, hashed[k : k + 1])
                yield whole
            else:
                yield hashed[:0]


def _signatures(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """16-bit signature of every run of values that begins at `firsts`; no run is empty."""
    out = np.empty((len(firsts), PLACES), np.uint16)
    with np.errstate(over="ignore"):
        for k in range(PLACES):
            least = np.minimum.reduceat((values ^ _MASKS[k]) * _FACTORS[k], firsts)
            out[:, k] = mix(least) & np.uint64(0xFFFF)
    return out


def _sketch(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """Sizes, two order-free digests, and signatures of some sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    low, high = np.zeros((2, len(sets)), np.uint64)
    marks: list[bytes | None] = [None] * len(sets)
    if len(full):
        values = np.concatenate([sets[k] for k in full])
        firsts = np.r_[0, np.cumsum(sizes[full])[:-1]]
        low[full] = np.add.reduceat(mix(values, 23), firsts)
        high[full] = np.add.reduceat(mix(values, 24), firsts)
        for k, row in zip(full, _signatures(values, firsts)):
            marks[k] = row.tobytes()
    return sizes, low.view(np.int64), high.view(np.int64), marks


def version(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("version")


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, version, n_shingles, low, high, signature) of every whole text."""
    fields = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("version", pa.int64()),
            ("n_shingles", pa.int64()),
            ("low", pa.int64()),
            ("high", pa.int64()),
            ("signature", pa.binary()),
        ]
    )

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, kept, size = [], [], 0

            def flush():
                parts.append(_sketch(kept))  # noqa: B023
                kept.clear()  # noqa: B023

            for found in shingle_sets(batch.column(1), words):
                kept.append(found)
                size += len(found)
                if size > 1 << 17:
                    flush()
                    size = 0
            flush()
            columns = [pa.array(np.concatenate([p[k] for p in parts])) for k in range(3)]
            marks = pa.array([m for p in parts for m in p[3]], pa.binary())
            named = [batch.column(0), batch.column(2), *columns, marks]
            yield pa.RecordBatch.from_arrays(named, schema=fields)

    rows = docs.select(F.col("doc_id").cast("long"), "text", version(F.col("text")))
    schema = "doc_id long, version long, n_shingles long, low long, high long, signature binary"
    return rows.mapInArrow(sketched, schema)


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, id, n) for every chunk and every place of it that may be wrong."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                ids = part.column(0).to_numpy()
                marks = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16)
                places = marks.reshape(len(ids), PLACES).astype(np.uint64)
                keys = []
                for c, chunk in enumerate(np.array_split(np.arange(PLACES), CHUNKS)):
                    for out in chunk:
                        key = np.full(len(ids), c * PLACES + out, np.uint64)
                        for place in chunk[chunk != out]:
                            key = hash_pairs(key, places[:, place])
                        keys.append(key)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.tile(ids, len(keys))),
                        pa.array(np.tile(part.column(2).to_numpy(), len(keys))),
                    ],
                    names=["key", "id", "n"],
                )

    return classes.select("id", "signature", "n").mapInArrow(keyed, "key long, id long, n long")


def _apart(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sets are less similar than SIMILARITY."""
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return SIMILARITY[1] * shared < SIMILARITY[0] * (len(left) + len(right) - shared)


def _bitsets(sets: list[np.ndarray]) -> np.ndarray | None:
    """Sets as rows of bits over the shingles that two or more of them hold; None if that is too large."""
    values = np.concatenate(sets)
    shingles, of, counts = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    width = (int(column[-1]) + 64) // 64
    if len(sets) * width * 8 > BITSET_BYTES:
        return None
    held = np.flatnonzero(counts[of] > 1)
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[held]
    at = column[of[held]].astype(np.uint64)
    bits = np.zeros((len(sets), max(width, 1)), np.uint64)
    np.bitwise_or.at(bits, (rows, (at >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (at & np.uint64(63)))
    return bits


def _similar(
    x: np.ndarray, y: np.ndarray, sets: list[np.ndarray], sizes: np.ndarray, bits: np.ndarray | None
) -> np.ndarray:
    """Which of the pairs (x, y) of rows have sets that are similar enough."""
    if bits is None:
        return np.array([not _apart(sets[p], sets[q]) for p, q in zip(x.tolist(), y.tolist())], bool)
    shared = np.empty(len(x), np.int64)
    step = max(1, (1 << 22) // bits.shape[1])
    for k in range(0, len(x), step):
        both = bits[x[k : k + step]] & bits[y[k : k + step]]
        shared[k : k + step] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    return SIMILARITY[1] * shared >= SIMILARITY[0] * (sizes[x] + sizes[y] - shared)


def _sets_of(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, set) of the documents in `ids`: sorted shingle hashes as bytes, written once."""

    def of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sets, size = [], [], 0
            for k, found in enumerate(shingle_sets(batch.column(1), words)):
                names.append(batch.column(0)[k].as_py())
                sets.append(found.tobytes())
                size += len(sets[-1])
                if size > 8 << 20 or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["id", "set"]
                    )
                    names, sets, size = [], [], 0

    asked = small_side(ids.distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(asked, "id", "left_semi")
    return materialise(texts.mapInArrow(of_sets, "id long, set binary"))


def confirm(pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of document ids whose full sets are similar enough."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(k)] for k in (2, 3))
            close = pa.array([not _apart(x, y) for x, y in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(close)

    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, words)
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(end), F.col("set").alias(f"set_{end}")), end)
    rows = pairs.select("a", "b", "set_a", "set_b")
    return rows.mapInArrow(compared, "a long, b long").distinct()


def _labelled(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """Bucket rows (key, id, n) with the label of what is connected so far, of undecided buckets only."""
    if found is None:
        return buckets.withColumn("label", F.col("id"))
    named = found.select(F.col("node").alias("id"), F.col("component"))
    rows = buckets.join(named, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("label")
    )
    open_keys = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    return rows.join(open_keys.filter("x != y").select("key"), "key", "left_semi")


def _size_fits(a: str, b: str):
    return F.least(a, b) * SIMILARITY[1] >= F.greatest(a, b) * SIMILARITY[0]


def _star_pairs(rows: DataFrame, round_: int) -> DataFrame:
    """One pair a class at most: with the hub of fitting size that it shares the most keys with."""
    first = F.min(F.struct(F.xxhash64(F.lit(round_), "id").alias("o"), "id", "label", "n")).alias("hub")
    hubs = rows.groupBy("key").agg(first).select(
        "key",
        F.col("hub.id").alias("hub"),
        F.col("hub.label").alias("hub_label"),
        F.col("hub.n").alias("hub_n"),
    )
    met = rows.join(hubs, "key").filter(F.col("label") != F.col("hub_label"))
    shared = met.filter(_size_fits("n", "hub_n")).groupBy("id", "hub").count()
    best = shared.groupBy("id").agg(F.max_by("hub", F.struct("count", F.xxhash64("hub"))).alias("hub"))
    return best.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _sides(rows: DataFrame, by: str, weight: Column, size: int) -> DataFrame:
    """Rows of each group dealt to tasks that compare those outside its largest component with all.

    Both sides are cut into blocks of about `size` of `weight`; task (i, j) gets block i of the rows
    outside, with `is_left`, and block j of all rows.
    """
    counted = rows.groupBy(by, "label").agg(F.sum(weight).alias("w"))
    tops = counted.groupBy(by).agg(
        F.max_by("label", F.struct("w", "label")).alias("top"),
        F.ceil(F.sum("w") / size).cast("int").alias("rights"),
        F.greatest(F.lit(1), F.ceil((F.sum("w") - F.max("w")) / size)).cast("int").alias("lefts"),
    )
    placed = salted_join(rows, tops, [by], [F.col("id")], "inner")
    place = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    task = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("is_left"))
    each = lambda parts: F.sequence(F.lit(0), F.col(parts) - 1)
    as_right = F.transform(each("lefts"), lambda i: task(i, place("rights"), False))
    as_left = F.transform(each("rights"), lambda j: task(place("lefts"), j, True))
    both = F.when(F.col("label") != F.col("top"), F.concat(as_right, as_left)).otherwise(as_right)
    return placed.select(*rows.columns, F.inline(both))


def _near_in_task(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of left and other rows with different labels that may be similar; their distances.

    Some BLOCK rows of either side at a time.
    """
    labels, sizes = group["label"].to_numpy(), group["n"].to_numpy()
    marks = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint16).reshape(len(labels), -1)
    is_left = group["is_left"].to_numpy(zero_copy_only=False)
    lefts, rights = np.flatnonzero(is_left), np.flatnonzero(~is_left)
    for a in range(0, len(lefts), BLOCK):
        left = lefts[a : a + BLOCK]
        for b in range(0, len(rights), BLOCK):
            right = rights[b : b + BLOCK]
            far = np.zeros((len(left), len(right)), np.uint8)
            for place in range(PLACES):
                far += marks[left, place][:, None] != marks[right, place]
            low = np.minimum(sizes[left][:, None], sizes[right])
            high = np.maximum(sizes[left][:, None], sizes[right])
            fits = (far <= DISTANCE) & (low * SIMILARITY[1] >= high * SIMILARITY[0])
            rows, columns = np.nonzero(fits & (labels[left][:, None] != labels[right]))
            if len(rows):
                yield left[rows], right[columns], far[rows, columns]


def _near_pairs(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that join rows of a bucket with different labels, within DISTANCE and of fitting sizes.

    Buckets are compared inside tasks; of the pairs of a task those leave it that join its labels.
    """
    known = rows.drop("n").join(classes.select("id", "n", "signature"), "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "i", "j"]):
            ids, joined = group["id"].to_numpy(), _Joined(group["label"].to_numpy())
            for x, y, _ in _near_in_task(group):
                ends = [(p, q) for p, q in zip(x.tolist(), y.tolist()) if joined.join(p, q)]
                if ends:
                    yield _pairs(ids, ends)

    met = dealt(_sides(known, "key", F.lit(2 * PLACES), BUCKET_BYTES), ["key", "i", "j"])
    return met.mapInArrow(compared, "a long, b long").distinct()


def _near_stars(rows: DataFrame, classes: DataFrame, round_: int) -> DataFrame:
    """Pairs of a class and a hub of one of its buckets, within DISTANCE and of fitting sizes."""
    order = F.struct(F.xxhash64(F.lit(round_), "id").alias("o"), "id", "label")
    hubs = rows.groupBy("key").agg(F.min(order).alias("hub")).select(
        "key", F.col("hub.id").alias("hub"), F.col("hub.label").alias("hub_label")
    )
    met = rows.join(hubs, "key").filter("label != hub_label")
    pairs = met.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    for end in ("a", "b"):
        known = classes.select(
            F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}")
        )
        pairs = pairs.join(known, end)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16) for k in (2, 3))
            far = (s.reshape(-1, PLACES) != t.reshape(-1, PLACES)).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(far <= DISTANCE))

    fitting = pairs.filter(_size_fits("n_a", "n_b")).select("a", "b", "s_a", "s_b")
    return fitting.mapInArrow(near, "a long, b long")


def _families(buckets: DataFrame, classes: DataFrame, links: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component): classes joined by links and by signatures within DISTANCE.

    Hubs first join what they can; then all pairs of different families are compared. So any two
    classes within DISTANCE that share a key, which all such do, are in one family in the end.
    """
    for round_ in range(STAR_ROUNDS + 1):
        rows = materialise(_labelled(buckets, found))
        if rows.isEmpty():
            break
        if round_ < STAR_ROUNDS:
            near = _near_stars(rows, classes, 10 + round_)
        else:
            near = _near_pairs(rows, classes)
        links = materialise(links.unionByName(near))
        found = components(links)
    return found


class _Joined:
    """Which labels of some rows are connected."""

    def __init__(self, labels: np.ndarray):
        names, of = np.unique(labels, return_inverse=True)
        self._of, self._parent = of.tolist(), list(range(len(names)))

    def _root(self, row: int) -> int:
        parent, k = self._parent, self._of[row]
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def join(self, x: int, y: int) -> bool:
        """Connects the labels of two rows; whether they were apart."""
        p, q = self._root(x), self._root(y)
        self._parent[q] = p
        return p != q


def _pairs(ids: np.ndarray, ends: list[tuple[int, int]]) -> pa.RecordBatch:
    """Pairs of ids, the smaller one first."""
    pairs = np.sort(ids[np.array(ends)], axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, k]) for k in (0, 1)], names=["a", "b"])


def _links_left(
    families: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, words: int
) -> DataFrame:
    """Links between members of a family that are not connected yet, confirmed on full sets.

    Members are compared inside tasks with their sets at hand, as bits over the shingles that they
    share; of the links those go out that connect components.
    """
    label = found.withColumnRenamed("node", "id").withColumnRenamed("component", "label")
    members = (
        classes.select("id", "n", "signature")
        .join(families.withColumnRenamed("node", "id").withColumnRenamed("component", "family"), "id")
        .join(label, "id", "left")
        .withColumn("label", F.coalesce("label", "id"))
    )
    open_ = members.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    members = materialise(members.join(open_.filter("x != y").select("family"), "family", "left_semi"))
    rows = _sides(members, "family", 8 * F.col("n"), FAMILY_BYTES).join(
        _sets_of(members.select("id"), docs, words), "id"
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["family", "i", "j"]):
            ids, joined = group["id"].to_numpy(), _Joined(group["label"].to_numpy())
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in group["set"]]
            sizes, bits = group["n"].to_numpy(), _bitsets(sets)
            for x, y, _ in _near_in_task(group):
                close = _similar(x, y, sets, sizes, bits)
                pairs = zip(x[close].tolist(), y[close].tolist())
                ends = [(p, q) for p, q in pairs if joined.join(p, q)]
                if ends:
                    yield _pairs(ids, ends)

    fields = ["family", "i", "j", "id", "label", "n", "signature", "is_left", "set"]
    return dealt(rows.select(*fields), ["family", "i", "j"]).mapInArrow(compared, "a long, b long")


def _told_apart(docs: DataFrame, made: DataFrame) -> DataFrame | None:
    """(id, doc_id, text) of the rows whose id stands on texts with different sets, or None.

    Each of them gets an id of its own below all others.
    """
    differ = [F.min(c) != F.max(c) for c in ("low", "high", "n_shingles")]
    several = made.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        (differ[0] | differ[1] | differ[2]).alias("differ"), F.min("doc_id").alias("least")
    )
    clashing = materialise(several.filter("differ").select("doc_id"))
    if clashing.isEmpty():
        return None
    least = made.agg(F.min("doc_id")).first()[0]
    rows = docs.join(clashing, "doc_id", "left_semi")
    own = F.lit(least - 1) - F.monotonically_increasing_id()
    return materialise(rows.select(own.alias("id"), "doc_id", "text"))


def near_duplicates(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs`, as `judged_rows` finds them."""
    return judged_rows(docs, words).drop("version")


def judged_rows(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, version, n_shingles, component_id) of every row of `docs` (doc_id, text).

    Documents are linked from a Jaccard similarity of 0.8 on; a component goes by its smallest id.
    Texts without words are linked with nothing, as are rows without an id, whose component is NULL.
    Rows that share an id are documents of their own where their sets differ: each has the component
    of its text. `version` is the hash of the text, which tells such rows apart.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    made = materialise(sketches(docs, words))
    clashing = _told_apart(docs, made)
    if clashing is None:
        return _near_duplicates(docs, made, words)
    rest = docs.join(clashing.select("doc_id").distinct(), "doc_id", "left_anti")
    unique = materialise(rest.unionByName(clashing.select(F.col("id").alias("doc_id"), "text")))
    found = _near_duplicates(unique, materialise(sketches(unique, words)), words)
    real = clashing.select(F.col("id").alias("doc_id"), F.col("doc_id").alias("real"))
    named = materialise(found.join(real, "doc_id", "left").withColumn("doc_id", F.coalesce("real", "doc_id")))
    smallest = named.groupBy("component_id").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "component_id", "left").select(
        "doc_id", "version", "n_shingles", F.col("smallest").alias("component_id")
    )


def _near_duplicates(docs: DataFrame, made: DataFrame, words: int) -> DataFrame:
    """The same where every id stands on one text only."""
    classes = materialise(
        made.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("low", "high", F.col("n_shingles").alias("n"))
        .agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.count("*").alias("copies"))
    )
    keys = materialise(index_keys(classes))
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    buckets = materialise(keys.join(shared, "key", "left_semi"))
    links, found = None, None
    for round_ in range(STAR_ROUNDS):
        rows = materialise(_labelled(buckets, found))
        if links is not None and rows.isEmpty():
            break
        new = confirm(materialise(_star_pairs(rows, round_)), docs, words)
        links = materialise(new if links is None else links.unionByName(new))
        found = components(links)
    families = _families(buckets, classes, links, found)
    links = materialise(links.unionByName(_links_left(families, found, classes, docs, words)))
    found = components(links)
    # Classes of copies lead to their smallest id, and from there to the component.
    copied = classes.filter("copies > 1").select("low", "high", F.col("n").alias("n_shingles"), "id")
    copied = copied.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "low", "high", "n_shingles", F.coalesce("component", "id").alias("of_class")
    )
    rows = salted_join(made.drop("signature"), copied, ["low", "high", "n_shingles"], [F.col("doc_id")])
    single = found.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "of_doc")
    return rows.join(single, "doc_id", "left").select(
        "doc_id",
        "version",
        "n_shingles",
        F.when(
            F.col("n_shingles") > 0, F.coalesce("of_class", "of_doc", "doc_id")
        ).otherwise(F.col("doc_id")).alias("component_id"),
    )
