"""Prefix trie of conversations over minimal-perfect-hash node tables.

A node is a distinct sequence of first turns, named by a polynomial digest of two times 61 bits. The
digest of a prefix follows from the one before it and can be carried over a cut of the data, so a
conversation of any length is digested by many tasks. Prefixes are dealt to shards of bounded size.
Each shard enumerates its distinct digests, gives each a slot of a minimal perfect hash, verifies
every lookup against the digest kept in the slot, and scatters counts into flat arrays.

Shards overlap in nodes near the root; sums by digest give the counts of the whole trie. For sums
over subtrees every node is owned by one shard, the one that holds its smallest conversation. A
shard adds what it owns upwards through the parent slots, deepest level first; as all ancestors of a
node lie in its shard, the sums of the shards add up to those of the trie. A conversation of more
than `band` turns is cut into bands, tables of their own, and what its deeper bands own enters a band
at the band's last node.

Turns are ordered by `turn`, NULL first, ties by the digest of role and text; equal rows are turns of
their own. NULL role or text is empty. Rows without a conversation id belong to none and are left
out. An empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.arrays import mix
from coldtrace.llm.common import n_words, small_side
from coldtrace.session import materialise

PRIME = (1 << 61) - 1
BASES = (0x0F2B93C1A7D45E69, 0x1B7E4D9035C6A8F3)
#: Prefix rows of a shard, about, and turns of a band at most.
TARGET = 1 << 18
BAND = 1 << 12
#: Turns that a conversation may take over from another one.
HEADS = 3
#: Conversation ids joined into one row before a node's list is digested.
CHUNK = 4096
EMPTY = hashlib.sha256(b"").hexdigest()

#: Conversation and number of its first turns that replace those of conversation `id`.
Heads = Callable[[Column], tuple[Column, Column]]


# -- arithmetic modulo the prime -----------------------------------------------------------------


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Product modulo the prime of values below it."""
    low = np.uint64((1 << 31) - 1)
    xh, xl, yh, yl = x >> np.uint64(31), x & low, y >> np.uint64(31), y & low
    mid = xh * yl + xl * yh
    ml = mid & np.uint64((1 << 30) - 1)
    return _reduced(
        np.uint64(2) * xh * yh + (mid >> np.uint64(30)) + (ml << np.uint64(31)) + xl * yl
    )


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    left = exponents.astype(np.uint64)
    square = np.full(len(left), base, np.uint64)
    result = np.ones(len(left), np.uint64)
    while left.any():
        result = np.where(left & np.uint64(1), times(result, square), result)
        square, left = times(square, square), left >> np.uint64(1)
    return result


def shifted(digest: np.ndarray, by: np.ndarray, steps: np.ndarray, base: int) -> np.ndarray:
    """Digests whose beginning is changed by `by`, `steps` turns before their end."""
    moved = times(by.astype(np.uint64), powers(base, steps))
    return _reduced(digest.astype(np.uint64) + moved).astype(np.int64)


# -- minimal perfect hash ------------------------------------------------------------------------


class SlotTable:
    """Slots 0 to n-1 for n distinct pairs of 64-bit keys.

    Level by level, the keys that meet no other key at their place of a bit array keep it; the rank
    of its bit is the slot. Slots hold their key: a lookup of any other key is found out.
    """

    SPREAD = 2.0

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.seed = 0
        while not self._built(high, low):  # two keys with one 64-bit hash never part
            self.seed += 1

    def _hash(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(mix(high.astype(np.uint64), 31 + self.seed) + low.astype(np.uint64), 32)

    def _built(self, high: np.ndarray, low: np.ndarray) -> bool:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        hashed, left, taken = self._hash(high, low), np.arange(len(high)), 0
        self.high, self.low = np.empty(len(high), np.int64), np.empty(len(high), np.int64)
        while len(left):
            if len(self.levels) == 60:
                return False
            size = max(8, int(len(left) * self.SPREAD))
            place = (mix(hashed[left], len(self.levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            slot = taken + np.cumsum(alone) - 1
            keeps = alone[place]
            self.high[slot[place[keeps]]] = high[left[keeps]]
            self.low[slot[place[keeps]]] = low[left[keeps]]
            self.levels.append((size, alone, slot))
            taken, left = taken + int(keeps.sum()), left[~keeps]
        return True

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of every key, -1 for keys that the table does not hold."""
        hashed, left = self._hash(high, low), np.arange(len(high))
        found = np.full(len(high), -1, np.int64)
        for level, (size, alone, slot) in enumerate(self.levels):
            place = (mix(hashed[left], level) % np.uint64(size)).astype(np.int64)
            keeps = alone[place]
            found[left[keeps]] = slot[place[keeps]]
            left = left[~keeps]
        known = found >= 0
        known[known] = (self.high[found[known]] == high[known]) & (self.low[found[known]] == low[known])
        return np.where(known, found, -1)


# -- digests of prefixes -------------------------------------------------------------------------


def _numbered(conversations: DataFrame) -> DataFrame:
    """Turns in order, written once: place `k` and digest within the part of a conversation that
    lies in partition `part`."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    half = lambda at: F.conv(F.substring(name, at, 15), 16, 10).cast("long") + 1
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        half(1).alias("t"),
        half(17).alias("u"),
        n_words(text).alias("words"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "t", "u"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv long, t long, words long, part int, seq long, k long, a long, b long, pa long, pb long"

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        conv, k, a, b = None, 0, 0, 0
        x, y = BASES
        for batch in batches:
            convs = batch.column("conv").to_pylist()
            rows = []
            for c, t, u in zip(convs, batch.column("t").to_pylist(), batch.column("u").to_pylist()):
                if c != conv:
                    conv, k, a, b = c, 0, 0, 0
                before = (a, b)
                k, a, b = k + 1, (a * x + t) % PRIME, (b * y + u) % PRIME
                rows.append((seq, k, a, b, *before))
                seq += 1
            more = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"),
                    batch.column("t"),
                    batch.column("words"),
                    pa.array(np.full(len(rows), part, np.int32)),
                    *[pa.array(np.ascontiguousarray(more[:, i])) for i in range(6)],
                ],
                names="conv t words part seq k a b pa pb".split(),
            )

    return materialise(ranged.mapInArrow(digested, schema))


def _carried(numbered: DataFrame) -> dict[int, tuple[int, int, int, int]]:
    """Per partition that begins inside a conversation: it, its turns so far, and their digest.

    One row per partition comes to the driver.
    """
    ends = numbered.groupBy("part").agg(
        F.min_by("conv", "seq").alias("first"),
        F.max_by(F.struct("conv", "k", "a", "b"), "seq").alias("last"),
    )
    found, conv, k, a, b = {}, None, 0, 0, 0
    for row in ends.orderBy("part").collect():
        last = row.last
        if row.first == conv:
            found[row.part] = (conv, k, a, b)
        if last.conv == conv:
            a = (a * pow(BASES[0], last.k, PRIME) + last.a) % PRIME
            b = (b * pow(BASES[1], last.k, PRIME) + last.b) % PRIME
            k += last.k
        else:
            conv, k, a, b = last.conv, last.k, last.a, last.b
    return found


def _turns(numbered: DataFrame) -> DataFrame:
    """Turns with their place `pos` in the conversation and the digests up to and before them."""
    carried = _carried(numbered)
    schema = "conv long, t long, words long, pos long, a long, b long, pa long, pb long"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n).to_numpy().copy() for n in "k a b pa pb".split()}
            conv, part = batch.column("conv").to_numpy(), batch.column("part").to_numpy()
            steps = columns["k"].copy()
            for p in np.unique(part):
                if int(p) not in carried:
                    continue
                c, k, a, b = carried[int(p)]
                on = np.flatnonzero((part == p) & (conv == c))
                columns["k"][on] += k
                for name, by, base, back in (
                    ("a", a, 0, 0), ("b", b, 1, 0), ("pa", a, 0, 1), ("pb", b, 1, 1)
                ):
                    by = np.full(len(on), by, np.int64)
                    columns[name][on] = shifted(columns[name][on], by, steps[on] - back, BASES[base])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("t"), batch.column("words")]
                + [pa.array(columns[n]) for n in "k a b pa pb".split()],
                names="conv t words pos a b pa pb".split(),
            )

    return numbered.drop("seq").mapInArrow(placed, schema)


def _profiles(turns: DataFrame, heads: Heads | None) -> DataFrame:
    """One row per conversation: what it takes over, and how that changes its digests.

    `cut` own turns fall away, `m` turns of the other conversation come in front; `da`, `db` are the
    change of the digest where the own turns go on; `front` holds the turns in front.
    """
    at = lambda n: F.max(F.when(F.col("pos") == n, F.struct("a", "b", "words", "t", "pa", "pb")))
    firsts = [at(n).alias(f"s{n}") for n in range(1, HEADS + 2)]
    own = turns.groupBy("conv").agg(F.max("pos").alias("len"), *firsts)
    if heads is None:
        base, h = F.col("conv"), F.lit(0)
    else:
        base, h = heads(F.col("conv"))
    own = own.withColumns({"base": base, "h": F.least(h, F.lit(HEADS)).cast("long")})
    lent = own.select(
        F.col("conv").alias("base"),
        F.col("len").alias("base_len"),
        *[F.col(f"s{n}").alias(f"f{n}") for n in range(1, HEADS + 1)],
    )
    both = own.join(lent, "base", "left") if heads is not None else own.select(
        "*", F.lit(0).cast("long").alias("base_len"), *[F.col(f"s{n}").alias(f"f{n}") for n in range(1, HEADS + 1)]
    )
    both = both.withColumns(
        {
            "cut": F.least("h", "len"),
            "m": F.least("h", F.coalesce("base_len", F.lit(0))).cast("long"),
        }
    )

    def picked(prefix: str, index: str, field: str, most: int) -> Column:
        value = F.lit(0).cast("long")
        for n in range(1, most + 1):
            value = F.when(F.col(index) == n, F.col(f"{prefix}{n}.{field}")).otherwise(value)
        return value

    prime = F.lit(PRIME)
    change = {
        f"d{x}": F.pmod(picked("f", "m", x, HEADS) - picked("s", "cut", x, HEADS), prime) for x in "ab"
    }
    after = both.withColumn("after", F.col("cut") + 1)
    first = F.when(F.col("m") > 0, F.col("f1.t")).otherwise(
        reduce(
            lambda value, n: F.when(F.col("after") == n, F.col(f"s{n}.t")).otherwise(value),
            range(1, HEADS + 2),
            F.lit(None).cast("long"),
        )
    )
    fronts = F.slice(F.array(*[F.col(f"f{n}") for n in range(1, HEADS + 1)]), F.lit(1), F.col("m").cast("int"))
    size = F.col("m") + F.col("len") - F.col("cut")
    return after.withColumns(change).select(
        "conv", "cut", "m", "da", "db",
        size.alias("size"),
        F.coalesce(F.when(size > 0, first), F.lit(0)).alias("first"),
        fronts.alias("front"),
    )


def _prefixes(turns: DataFrame, profiles: DataFrame, target: int, band: int) -> DataFrame:
    """Every prefix of every rebuilt conversation, the empty one included, with its shard and band."""
    total = profiles.agg(F.sum(F.col("size") + 1)).first()[0] or 0
    shards = max(1, math.ceil(2 * total / target))
    # First turns under which more rows lie than a shard should hold, at most total / target of them.
    crowded = (
        profiles.groupBy("first")
        .agg(F.sum(F.col("size") + 1).alias("rows"))
        .filter(F.col("rows") > target)
        .select("first", F.ceil(F.col("rows") / target).alias("salts"))
    )
    dealt = profiles.join(small_side(crowded), "first", "left").withColumn(
        "salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("conv"), "salts")).otherwise(0)
    )
    keys = ["conv", "first", "salt", "size"]
    none = F.lit(0).cast("long")
    empty = dealt.select(
        *keys, none.alias("depth"), none.alias("words"),
        *[none.alias(n) for n in ("a", "b", "pa", "pb")],
    )
    front = dealt.select(*keys, F.posexplode("front").alias("i", "x")).select(
        *keys, (F.col("i") + 1).cast("long").alias("depth"), "x.words", "x.a", "x.b", "x.pa", "x.pb"
    )
    # The profile is one row per conversation; a long one is split as a skewed join.
    rest = turns.drop("t").join(dealt.select(*keys, "cut", "m", "da", "db"), "conv").filter("pos > cut")
    schema = (
        "conv long, first long, salt long, size long, depth long, words long, "
        "a long, b long, pa long, pb long"
    )

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = {n: batch.column(n).to_numpy() for n in batch.schema.names}
            steps = v["pos"] - v["cut"]
            depth = steps + v["m"]
            made = [
                shifted(v[n], v[by], steps - back, BASES[base])
                for n, by, base, back in (("a", "da", 0, 0), ("b", "db", 1, 0), ("pa", "da", 0, 1), ("pb", "db", 1, 1))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in keys] + [pa.array(depth), batch.column("words")]
                + [pa.array(x) for x in made],
                names=[*keys, "depth", "words", "a", "b", "pa", "pb"],
            )

    long_keys = rest.withColumn("salt", F.col("salt").cast("long"))
    rest = long_keys.mapInArrow(rebuilt, schema)
    names = rest.columns
    rows = rest.unionByName(front.select(*names)).unionByName(empty.select(*names))
    at = F.floor(F.col("depth") / band)
    shard = F.pmod(F.xxhash64("first", "salt", "band"), F.lit(shards)).cast("int")
    # The last node of a band heads the next one: there it stands for its place only.
    ghost = (F.col("depth") % band == band - 1) & (F.col("size") > F.col("depth"))
    return materialise(
        rows.select(
            "*",
            (F.col("depth") == F.col("size")).alias("is_end"),
            F.explode(
                F.when(ghost, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ).alias("next"),
            at.alias("own_band"),
        )
        .withColumn("band", (F.col("own_band") + F.col("next")).cast("long"))
        .select(
            "conv", "depth", "words", "a", "b", "pa", "pb", "is_end", "band",
            (F.col("next") == 1).alias("ghost"), shard.alias("shard"), "size",
        )
    )


# -- node tables ---------------------------------------------------------------------------------

NODES = (
    "shard int, band long, slot int, parent int, a long, b long, pa long, pb long, depth long, "
    "words long, n long, ends long, least_conv long, ghost boolean"
)


def node_table(rows: pa.Table) -> pa.Table:
    """The node table of one shard and band: distinct prefixes in slot order, counts scattered."""
    v = {n: rows[n].to_numpy() for n in ("conv", "depth", "words", "a", "b", "pa", "pb", "is_end", "ghost")}
    order = np.lexsort((v["b"], v["a"]))
    a, b = v["a"][order], v["b"][order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    table = SlotTable(a[new], b[new])
    slot = table.find(v["a"], v["b"])
    size = len(table.high)
    if (slot < 0).any() or len(np.unique(slot)) != size:
        raise ValueError("a prefix has no slot of its own")
    kept = {n: np.empty(size, np.int64) for n in ("depth", "words", "pa", "pb")}
    for name, column in kept.items():
        column[slot] = v[name]
        if (column[slot] != v[name]).any():
            raise ValueError("two prefixes share a digest")
    real = ~v["ghost"]
    n = np.bincount(slot[real], minlength=size)
    ends = np.bincount(slot[real & v["is_end"]], minlength=size)
    least = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(least, slot[real], v["conv"][real])
    ghost = n == 0
    parent = table.find(kept["pa"], kept["pb"])
    parent[kept["depth"] == 0] = -1
    if ((parent < 0) & ~ghost & (kept["depth"] > 0)).any():
        raise ValueError("a prefix lies in a shard without the one before it")
    head = {name: pa.repeat(rows[name][0], size) for name in ("shard", "band")}
    return pa.table(
        head
        | {"slot": pa.array(np.arange(size, dtype=np.int32)), "parent": pa.array(parent.astype(np.int32))}
        | {"a": table.high, "b": table.low, "pa": kept["pa"], "pb": kept["pb"]}
        | {"depth": kept["depth"], "words": kept["words"], "n": n, "ends": ends}
        | {"least_conv": least, "ghost": ghost}
    )


SUMS = (
    "a long, b long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long"
)


def accumulate(rows: pa.Table) -> pa.Table:
    """Sums over subtrees of one shard and band, from what it owns, deepest level first."""
    size = rows.num_rows
    slot = rows["slot"].to_numpy()
    names = "a b depth parent n ends conv_id words least_conv ghost more_saved more_leaves".split()
    v = {}
    for name in names:
        column = rows[name].to_numpy()
        v[name] = np.empty(size, column.dtype)
        v[name][slot] = column
    owned = ~v["ghost"] & (v["least_conv"] == v["conv_id"])
    saved = np.where(owned, (v["n"] - 1) * v["words"], 0) + v["more_saved"]
    leaves = (owned & (v["ends"] == v["n"])).astype(np.int64) + v["more_leaves"]
    children = np.zeros(size, np.int64)
    np.add.at(children, v["parent"][owned & (v["parent"] >= 0)], 1)
    by_depth = np.argsort(v["depth"], kind="stable")
    levels = np.flatnonzero(np.r_[True, np.diff(v["depth"][by_depth]) > 0])
    for begin, end in zip(levels[::-1], np.r_[levels[1:], size][::-1]):
        level = by_depth[begin:end]
        level = level[v["parent"][level] >= 0]
        np.add.at(saved, v["parent"][level], saved[level])
        np.add.at(leaves, v["parent"][level], leaves[level])
    above = pa.array(v["conv_id"][v["parent"]], mask=v["parent"] < 0)
    ghost = v["ghost"]
    return pa.table(
        {"a": v["a"], "b": v["b"], "conv_id": v["conv_id"], "depth": v["depth"]}
        | {"parent_conv_id": above, "n_convs": v["n"], "n_children": children}
        # What a band owns reaches the bands above it through `_from_deeper_bands`.
        | {"n_leaves": np.where(ghost, 0, leaves), "saved_tokens": np.where(ghost, 0, saved)}
    )


def _whole_counts(nodes: DataFrame) -> DataFrame:
    """Counts of each node over all shards; checks that shards mean the same prefix by a digest."""
    same = [F.min(n) == F.max(n) for n in ("depth", "words", "pa", "pb")]
    known = reduce(lambda x, y: x & y, same)
    wrong = F.raise_error(F.lit("two prefixes share a digest")).cast("long")
    return nodes.filter(~F.col("ghost")).groupBy("a", "b").agg(
        F.when(known, F.sum("n")).otherwise(wrong).alias("n"),
        F.sum("ends").alias("ends"),
        F.min("least_conv").alias("conv_id"),
    )


def _from_deeper_bands(prefixes: DataFrame, joined: DataFrame, band: int) -> DataFrame:
    """What conversations own in the bands below a band, at their last node in it."""
    owned = joined.filter(~F.col("ghost") & (F.col("least_conv") == F.col("conv_id")))
    leaf = (F.col("ends") == F.col("n")).cast("long")
    by_band = owned.groupBy("conv_id", "band").agg(
        F.sum((F.col("n") - 1) * F.col("words")).alias("s"), F.sum(leaf).alias("l")
    ).filter("band > 0")
    spread = by_band.select(
        F.col("conv_id").alias("conv"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("band") - 1)).alias("band"),
        "s", "l",
    )
    below = spread.groupBy("conv", "band").agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
    last = prefixes.filter(~F.col("ghost") & (F.col("depth") % band == band - 1)).select(
        "conv", "band", "shard", "a", "b"
    )
    return last.join(below, ["conv", "band"]).groupBy("shard", "band", "a", "b").agg(
        F.sum("s").alias("more_saved"), F.sum("l").alias("more_leaves")
    )


# -- members that end at a node ------------------------------------------------------------------


def _end_lists(prefixes: DataFrame) -> DataFrame:
    """Per node that conversations end at, the digest of their ids in order.

    Ids are sorted over all tasks and joined in chunks; only chunks of a node meet, one after the
    other, in one running digest.
    """
    ends = prefixes.filter("is_end AND NOT ghost").select("a", "b", "conv")
    order = ["a", "b", "conv"]
    ranged = ends.repartitionByRange(*order).sortWithinPartitions(*order)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunk = TaskContext.get().partitionId(), 0
        node, ids = None, []

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names="a b part chunk ids".split()
            )

        for batch in batches:
            rows = []
            for a, b, conv in zip(*[batch.column(n).to_pylist() for n in order]):
                if (a, b) != node or len(ids) == CHUNK:
                    if ids:
                        rows.append((*node, part, chunk, ",".join(ids)))
                        chunk += 1
                    node, ids = (a, b), []
                ids.append(str(conv))
            yield packed(rows)
        if ids:
            yield packed([(*node, part, chunk, ",".join(ids))])

    chunks = ranged.mapInArrow(chunked, "a long, b long, part int, chunk long, ids string")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 3
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "ends_sha256"]
            )

        for batch in batches:
            rows = []
            for a, b, ids in zip(*[batch.column(n).to_pylist() for n in ("a", "b", "ids")]):
                if (a, b) == node:
                    running.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, running.hexdigest()))
                node, running = (a, b), hashlib.sha256(ids.encode())
            yield packed(rows)
        if node is not None:
            yield packed([(*node, running.hexdigest())])

    dealt = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "part", "chunk")
    return dealt.mapInArrow(digested, "a long, b long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, heads: Heads | None = None, target: int = TARGET, band: int = BAND
) -> DataFrame:
    """One row per node of the trie; `heads` may have conversations begin with turns of others.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 as the contract of `op11` defines them.
    """
    turns = _turns(_numbered(conversations))
    profiles = materialise(_profiles(turns, heads))
    prefixes = _prefixes(turns, profiles, target, band)
    shards = prefixes.drop("size").groupBy("shard", "band")
    nodes = materialise(shards.applyInArrow(node_table, NODES))
    whole = _whole_counts(nodes)
    joined = nodes.drop("n", "ends", "pa", "pb").join(whole, ["a", "b"])
    longest = profiles.agg(F.max("size")).first()[0] or 0
    if longest >= band:
        joined = materialise(joined)
        more = _from_deeper_bands(prefixes, joined, band)
        # A ghost stands in the band after its own, so it meets no row here.
        joined = joined.join(more, ["shard", "band", "a", "b"], "left")
        joined = joined.fillna(0, ["more_saved", "more_leaves"])
    else:
        none = F.lit(0).cast("long")
        joined = joined.withColumns({"more_saved": none, "more_leaves": none})
    sums = joined.groupBy("shard", "band").applyInArrow(accumulate, SUMS)
    total = sums.groupBy("a", "b").agg(
        *[F.max(n).alias(n) for n in ("conv_id", "depth", "parent_conv_id", "n_convs")],
        *[F.sum(n).alias(n) for n in ("n_children", "n_leaves", "saved_tokens")],
    )
    return total.join(_end_lists(prefixes), ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
