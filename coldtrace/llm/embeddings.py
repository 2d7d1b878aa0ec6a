"""Near-duplicate vectors by NN-descent.

Every vector has a list of its nearest vectors found so far. Lists begin with what random
hyperplanes bring together and are refined by joins of neighbours with neighbours of neighbours: at
each vector, the ones listed by it or listing it are compared with each other. A list whose last
entry still reaches the threshold is saturated; the saturated vectors are dealt to leaders, and the
members of all leaders within reach of each other are compared. Recall is audited against brute force on a bounded
sample of queries; while it is too low, descent goes on with further hyperplanes and longer lists.

Equal vectors are one class. Vectors travel with the rows that need them, in groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldtrace.llm.common import dealt, grouped, salted_join
from coldtrace.llm.components import components
from coldtrace.session import materialise

THRESHOLD = 0.95
#: Entries of a list, hyperplane tables of the start, vectors compared at a time.
LIST = 12
TABLES = 6
BLOCK = 256
ROUNDS = 3
#: Queries of the audit, about, and the recall it asks for; lists are doubled so often at most.
AUDIT = 1000
RECALL = 0.99
DOUBLINGS = 3
#: Starts with hyperplanes of their own, after which a recall that is still too low is an error.
STARTS = 12


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max()
    return scaled / np.sqrt((scaled * scaled).sum())


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, unit): unit vectors of the usable rows in doubles, NULL for all others."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column(1):
                numbers = row.values if row.is_valid else None
                good = numbers is not None and len(numbers) and not numbers.null_count
                array = numbers.to_numpy(zero_copy_only=False).astype(np.float64) if good else np.zeros(1)
                good = good and np.isfinite(array).all() and array.any()
                out.append(_unit(array).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "unit"]
            )

    shaped = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return shaped.mapInArrow(scaled, "vec_id long, unit binary")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _edges(a: np.ndarray, b: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a), pa.array(b), pa.array(sims.astype(np.float64))], names=["a", "b", "sim"]
    )


EDGE = "a long, b long, sim double"


def _best_of(ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, most: int) -> pa.RecordBatch:
    """For each vector of a block, its `most` nearest there that lie above its floor."""
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -2)
    most = min(most, len(ids) - 1)
    near = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    values = np.take_along_axis(sims, near, axis=1)
    rows, columns = np.nonzero(values > floors[:, None])
    return _edges(ids[rows], ids[near[rows, columns]], values[rows, columns])


def first_lists(vectors: DataFrame, most: int, seed: int) -> DataFrame:
    """Edges among vectors that share the sides of random hyperplanes, in blocks of about BLOCK.

    A side pattern with many vectors is dealt over several blocks at random.
    """
    count = max(1, vectors.count())
    bits = max(1, int(np.ceil(np.log2(max(2.0, count / BLOCK)))))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(1).to_pylist()
            sizes = np.array([len(u) for u in units])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                matrix = np.frombuffer(b"".join(units[i] for i in at), np.float32).reshape(len(at), -1)
                planes = np.random.default_rng([seed, int(size)]).normal(
                    size=(matrix.shape[1], TABLES * bits)
                )
                sides = (matrix @ planes > 0).reshape(len(at), TABLES, bits)
                codes = sides @ (1 << np.arange(bits, dtype=np.int64))
                codes = (codes * TABLES + np.arange(TABLES)) * 65536 + int(size) // 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(at, TABLES))), pa.array(codes.ravel())],
                    names=["id", "code"],
                )

    codes = materialise(vectors.mapInArrow(coded, "id long, code long"))
    parts = codes.groupBy("code").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(seed), "id", "code"), F.col("parts"))
    placed = salted_join(codes, parts, ["code"], [F.col("id")]).withColumn("part", part)
    rows = placed.join(vectors, "id").select("code", "part", "id", "v")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["code", "part"]):
            if group.num_rows > 1:
                ids = group["id"].to_numpy()
                matrix = _matrix(group["v"], np.float32)
                yield _best_of(ids, matrix, np.full(len(ids), -1.0), most)

    return dealt(rows, ["code", "part"]).mapInArrow(compared, EDGE)


def _top(edges: DataFrame, most: int) -> DataFrame:
    """The `most` nearest entries of each list."""
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    order = W.partitionBy("a").orderBy(F.desc("sim"), "b")
    return once.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= most).drop("at")


def descend(lists: DataFrame, vectors: DataFrame, most: int) -> DataFrame:
    """One round: at each vector, those on its list and those listing it are compared."""
    floors = lists.groupBy("a").agg(
        F.when(F.count("*") >= most, F.min("sim")).otherwise(-1.0).alias("floor")
    )
    listed = lists.select(F.col("a").alias("center"), F.col("b").alias("id"))
    listing = lists.select(F.col("b").alias("center"), F.col("a").alias("id"))
    # A vector that very many list is the center of several blocks; its own list is in each.
    counts = listing.groupBy("center").agg(F.ceil(F.count("*") / (4 * most)).cast("int").alias("parts"))
    listing = salted_join(listing, counts, ["center"], [F.col("id")]).select(
        "center", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "id"
    )
    listed = listed.join(counts, "center", "left").select(
        "center",
        F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
        "id",
    )
    members = listed.unionByName(listing).distinct()
    carried = vectors.join(floors, vectors["id"] == floors["a"], "left").select(
        "id", "v", F.coalesce("floor", F.lit(-1.0)).alias("floor")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["center", "part"]):
            if group.num_rows > 1:
                ids = group["id"].to_numpy()
                matrix = _matrix(group["v"], np.float32)
                yield _best_of(ids, matrix, group["floor"].to_numpy(), most)

    rows = members.join(carried, "id").select("center", "part", "id", "v", "floor")
    found = dealt(rows, ["center", "part"]).mapInArrow(compared, EDGE)
    return _top(lists.unionByName(found), most)


def exact_links(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Pairs (a, b) whose cosine in doubles reaches the threshold."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                [np.frombuffer(x.as_buffer(), np.float64) for x in batch.column(k)] for k in (2, 3)
            )
            close = [len(x) == len(y) and x @ y >= THRESHOLD for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    rows = pairs.select("a", "b").distinct()
    for end in ("a", "b"):
        rows = rows.join(units.select(F.col("id").alias(end), F.col("unit").alias(f"u_{end}")), end)
    return rows.select("a", "b", "u_a", "u_b").mapInArrow(judged, "a long, b long")


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _leaders_lists(open_: DataFrame, links: DataFrame, units: DataFrame) -> DataFrame:
    """(leader, id): neighbourhoods of leaders of the saturated vectors `open_`.

    A leader comes first, in a drawn order, among its open neighbours. Its list takes in its
    neighbours' neighbours until nothing new comes near enough.
    """
    order = lambda c: F.xxhash64(F.lit(7), c)
    among = links.join(open_.select(F.col("id").alias("a")), "a", "left_semi").join(
        open_.select(F.col("id").alias("b")), "b", "left_semi"
    )
    beaten = among.groupBy("a").agg(F.min(order(F.col("b"))).alias("least")).filter(
        F.col("least") < order(F.col("a"))
    )
    leaders = open_.join(beaten.select(F.col("a").alias("id")), "id", "left_anti")
    lists = materialise(links.join(leaders.select(F.col("id").alias("a")), "a", "left_semi"))
    fresh = lists
    while not fresh.isEmpty():
        further = fresh.select("a", F.col("b").alias("m")).join(
            links.select(F.col("a").alias("m"), "b"), "m"
        )
        unknown = further.filter("a != b").select("a", "b").distinct().join(lists, ["a", "b"], "left_anti")
        fresh = materialise(exact_links(unknown, units))
        lists = lists.unionByName(fresh)
    itself = leaders.select(F.col("id").alias("leader"), "id")
    return lists.select(F.col("a").alias("leader"), F.col("b").alias("id")).unionByName(itself)


def _homes(around: DataFrame, units: DataFrame) -> DataFrame:
    """(leader, id, sim): each listed vector with the nearest of the leaders that list it."""
    rows = around.distinct()
    for end in ("leader", "id"):
        rows = rows.join(units.select(F.col("id").alias(end), F.col("unit").alias(f"u_{end}")), end)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                [np.frombuffer(x.as_buffer(), np.float64) for x in batch.column(k)] for k in (2, 3)
            )
            sims = np.array([x @ y for x, y in zip(left, right)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sims)], names=["leader", "id", "sim"]
            )

    met = rows.select("leader", "id", "u_leader", "u_id").mapInArrow(measured, "leader long, id long, sim double")
    nearest = met.groupBy("id").agg(F.max(F.struct("sim", "leader")).alias("home"))
    return nearest.select("home.leader", "id", "home.sim")


def _blocks(members: DataFrame, key: str) -> DataFrame:
    """Adds `part` and `parts`: the members of a key are dealt over blocks of about BLOCK."""
    counts = members.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    return members.join(counts, key).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))


def _met(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (l, m, i, j, id, is_left, is_right) in which block i of key l meets block j of key m, once.

    `members` are (key, id, part), `pairs` (l, m, parts_l, parts_m). Where a key meets itself, i <= j.
    """
    itself = F.col("l") == F.col("m")
    upto = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1)).alias("other")
    left = members.withColumnRenamed("key", "l").join(pairs, "l").select("l", "m", "id", "part", upto("parts_m"))
    right = members.withColumnRenamed("key", "m").join(pairs, "m").select("l", "m", "id", "part", upto("parts_l"))
    left = left.filter(~itself | (F.col("part") <= F.col("other"))).select(
        "l",
        "m",
        F.col("part").alias("i"),
        F.col("other").alias("j"),
        "id",
        F.lit(True).alias("is_left"),
        (itself & (F.col("part") == F.col("other"))).alias("is_right"),
    )
    right = right.filter(~itself | (F.col("other") < F.col("part"))).select(
        "l",
        "m",
        F.col("other").alias("i"),
        F.col("part").alias("j"),
        "id",
        F.lit(False).alias("is_left"),
        F.lit(True).alias("is_right"),
    )
    return left.unionByName(right)


def _sides(group: pa.Table) -> list[np.ndarray]:
    return [np.flatnonzero(group[c].to_numpy()) for c in ("is_left", "is_right")]


def _leader_pairs(homes: DataFrame, units: DataFrame) -> DataFrame:
    """(l, m), l <= m, of leaders so near that members of theirs may be linked.

    Members lie within the angle `radius` of their leader; beyond both radii and the angle of
    THRESHOLD nothing can be linked, by the triangle inequality. All leaders are compared, block
    against block.
    """
    radius = F.acos(F.least(F.greatest(F.min("sim"), F.lit(-1.0)), F.lit(1.0)))
    leaders = homes.groupBy("leader").agg(radius.alias("radius")).withColumnRenamed("leader", "id")
    leaders = leaders.join(units.select("id", F.octet_length("unit").alias("key")), "id")
    placed = materialise(_blocks(leaders, "key"))
    itself = placed.select(F.col("key").alias("l"), F.col("key").alias("m"), "parts").distinct()
    itself = itself.select("l", "m", F.col("parts").alias("parts_l"), F.col("parts").alias("parts_m"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["l", "i", "j"]):
            ids, radii = group["id"].to_numpy(), group["radius"].to_numpy()
            matrix = _matrix(group["unit"], np.float64)
            left, right = _sides(group)
            apart = np.arccos(np.clip(matrix[left] @ matrix[right].T, -1, 1))
            # The slack is above the error of an arc cosine near 1.
            reach = radii[left][:, None] + radii[right] + np.arccos(THRESHOLD) + 1e-6
            rows, columns = np.nonzero(apart <= reach)
            a, b = ids[left[rows]], ids[right[columns]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["l", "m"]
            )

    rows = _met(placed.select("key", "id", "part"), itself).join(placed.select("id", "radius"), "id")
    rows = rows.join(units, "id").select("l", "i", "j", "id", "is_left", "is_right", "radius", "unit")
    return dealt(rows, ["l", "i", "j"]).mapInArrow(compared, "l long, m long").distinct()


def _links_near(homes: DataFrame, units: DataFrame) -> DataFrame:
    """All links (a, b) among the vectors of `homes`: leaders' members against those of near leaders."""
    placed = materialise(_blocks(homes, "leader"))
    parts = placed.select("leader", "parts").distinct()
    pairs = _leader_pairs(homes, units)
    for end in ("l", "m"):
        pairs = pairs.join(
            parts.select(F.col("leader").alias(end), F.col("parts").alias(f"parts_{end}")), end
        )
    pairs = materialise(pairs)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["l", "m", "i", "j"]):
            ids = group["id"].to_numpy()
            matrix = _matrix(group["unit"], np.float64)
            left, right = _sides(group)
            rows, columns = np.nonzero(matrix[left] @ matrix[right].T >= THRESHOLD)
            a, b = ids[left[rows]], ids[right[columns]]
            for k in range(0, len(a), 100_000):
                keep = slice(k, k + 100_000)
                apart = a[keep] != b[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[keep][apart]), pa.array(b[keep][apart])], names=["a", "b"]
                )

    members = placed.select(F.col("leader").alias("key"), "id", "part")
    rows = _met(members, pairs).join(units, "id")
    rows = rows.select("l", "m", "i", "j", "id", "is_left", "is_right", "unit")
    return dealt(rows, ["l", "m", "i", "j"]).mapInArrow(compared, "a long, b long")


def enlarge(lists: DataFrame, links: DataFrame, units: DataFrame, most: int) -> DataFrame:
    """Links after all links among the saturated vectors have been added; both directions.

    Leaders are taken until their lists hold every saturated vector. A link of a saturated vector
    with one that is not stands on the latter's list.
    """
    reach = lists.groupBy("a").agg(F.count("*").alias("n"), F.min("sim").alias("last"))
    open_ = materialise(
        reach.filter((F.col("n") >= most) & (F.col("last") >= THRESHOLD - 1e-4)).select(F.col("a").alias("id"))
    )
    around = None
    while not open_.isEmpty():
        more = materialise(_leaders_lists(open_, links, units))
        around = more if around is None else around.unionByName(more)
        open_ = materialise(open_.join(more.select("id").distinct(), "id", "left_anti"))
    if around is None:
        return links
    homes = materialise(_homes(around, units))
    return materialise(_both(links.unionByName(_links_near(homes, units))))


def audit(links: DataFrame, units: DataFrame, queries: int = AUDIT) -> float:
    """Known share of a query's links, from about `queries` vectors compared with all others.

    The mean over the queries with links, or that over those with fewer than LIST alone if it is
    lower: each query counts once, so a crowd does not hide what is lost elsewhere.
    """
    n = units.count()
    draw = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1_000_000)) / 1_000_000
    asked = units if n <= queries else units.filter(draw < queries / n)
    rows = asked.select("id", "unit").collect()  # a bounded number of vectors
    if not rows:
        return 1.0
    spark = units.sparkSession
    shared = spark.sparkContext.broadcast([(r.id, bytes(r.unit)) for r in rows])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(u) for _, u in shared.value}:
            mine = [(i, u) for i, u in shared.value if len(u) == size]
            matrix = np.frombuffer(b"".join(u for _, u in mine), np.float64).reshape(len(mine), -1)
            by_size[size] = (np.array([i for i, _ in mine]), matrix)
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                lengths = np.array([len(u) for u in part.column(1).to_pylist()])
                for size, (ids, matrix) in by_size.items():
                    at = np.flatnonzero(lengths == size)
                    if len(at):
                        taken = part.take(pa.array(at))
                        sims = matrix @ _matrix(taken.column(1), np.float64).T
                        q, v = np.nonzero(sims >= THRESHOLD)
                        a, b = ids[q], taken.column(0).to_numpy()[v]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"]
                        )

    true = materialise(units.select("id", "unit").mapInArrow(compared, "a long, b long"))
    known = true.join(links.select("a", "b", F.lit(1).alias("known")), ["a", "b"], "left")
    share = (F.count("known") / F.count("*")).alias("share")
    asked = known.groupBy("a").agg(F.count("*").alias("n"), share)
    means = asked.agg(F.avg("share"), F.avg(F.when(F.col("n") < LIST, F.col("share")))).first()
    return min((m for m in means if m is not None), default=1.0)


def near_vectors(rows: DataFrame) -> tuple[DataFrame, float]:
    """((vec_id, n_links, component_id) of every row of `rows` (vec_id, embedding), audited recall).

    Vectors are linked from a cosine of THRESHOLD on; a recall below RECALL is an error. Unusable vectors (NULL, empty, zero, with NULL
    or non-finite components) and rows without an id have no links; vectors of different length are
    not compared. Rows that share an id share its links.
    """
    units = materialise(unit_vectors(rows))
    classes = materialise(
        units.filter("unit IS NOT NULL AND vec_id IS NOT NULL")
        .groupBy("unit")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    )

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.frombuffer(u.as_buffer(), np.float64).astype(np.float32).tobytes() for u in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "v"])

    exact = classes.select("id", "unit")
    vectors = materialise(exact.mapInArrow(narrow, "id long, v binary"))
    most, lists = LIST, None
    for attempt in range(STARTS):
        start = first_lists(vectors, most, attempt)
        lists = materialise(_top(start if lists is None else start.unionByName(lists), most))
        for _ in range(ROUNDS):
            lists = materialise(descend(lists, vectors, most))
        near = lists.filter(F.col("sim") >= THRESHOLD - 1e-4).select("a", "b")
        once = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = materialise(_both(exact_links(once, exact)))
        links = enlarge(lists, links, exact, most)
        recall = audit(links, exact)
        if recall >= RECALL:
            break
        if attempt < DOUBLINGS:
            most *= 2
    else:
        raise RuntimeError(f"audited recall {recall:.4f} is below {RECALL} after {STARTS} starts")
    found = components(links.filter("a < b"))
    sizes = classes.select("id", F.col("n").alias("copies"))
    linked = (
        links.join(sizes.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("near"))
    )
    judged = (
        classes.join(linked.withColumnRenamed("a", "id"), "id", "left")
        .join(found.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("unit"),
            (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    joined = salted_join(units, judged, ["unit"], [F.col("vec_id")])
    has_id = F.col("vec_id").isNotNull()
    return joined.select(
        "vec_id",
        F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(has_id, F.coalesce("component_id", "vec_id")).alias("component_id"),
    ), recall
