"""Keys that hold too many rows for one task, and joins that spread them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldtrace.session import materialise

HOT_ROWS = 2_000_000
#: Rows that one task gets of a hot key, about.
TASK_ROWS = 500_000
#: Column of a list of hot keys that tells how many rows each one has.
COUNT = "hot_rows"


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than `limit` rows and their row counts, or None when there is none.

    The count is combined on the map side and reads the key columns only. The list, at most
    (all rows / limit) keys, is a written table that Spark broadcasts while it is small.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias(COUNT)).filter(F.col(COUNT) > limit)
    listed = materialise(counted)
    return None if listed.isEmpty() else listed


def _same_key(keys: list[str]):
    """Null-safe equality on the keys, so that a NULL key counts as a key."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return condition


def split_hot(rows: DataFrame, hot: DataFrame | None, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys)."""
    if hot is None:
        return rows, None
    condition = _same_key(keys)
    left, right = rows.alias("l"), hot.alias("r")
    return left.join(right, condition, "left_anti"), left.join(right, condition, "left_semi")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    ways: int | None = None,
) -> DataFrame:
    """Equi-join whose hot keys are dealt over several tasks, `ways` or as many as they have rows for.

    Rows of a hot key get a salt from `spread_by`; the other side repeats its rows of that key once
    per salt. Other keys join as usual. Without hot keys this is a plain join.
    """
    if hot is None:
        return big.join(small, keys, how)
    hot_on = [c for c in hot.columns if c != COUNT]
    counted = F.ceil(F.col(COUNT) / TASK_ROWS).cast("int") if COUNT in hot.columns else F.lit(64)
    flagged = hot.select(*hot_on, (counted if ways is None else F.lit(ways)).alias("hot_ways"))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("hot_ways")), F.lit(0))
    copies = F.sequence(F.lit(0), F.coalesce("hot_ways", F.lit(1)) - 1)
    left = big.join(flagged, hot_on, "left").withColumn("salt", salt.cast("int")).drop("hot_ways")
    right = small.join(flagged, hot_on, "left").withColumn("salt", F.explode(copies)).drop("hot_ways")
    return left.join(right, [*keys, "salt"], how).drop("salt")


def slice_in_order(rows: DataFrame, order: list[str], slices: int | None = None) -> DataFrame:
    """Cut `rows` into contiguous pieces of near-equal size along `order`, numbered in `slice`.

    The cut points come from the whole order, not from a key, so one key may span many slices.
    Without a given number there are as many slices as the counted rows need; `rows` should be
    written already, as they are read for the count, the cut points and the cutting.
    The result is written once: every later step sees the same cuts, also after a lost executor.
    """
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = slices or max(least, -(-rows.count() // TASK_ROWS))
    ranged = rows.repartitionByRange(count, *order)
    return materialise(ranged.withColumn("slice", F.spark_partition_id()))


def with_neighbours(
    sliced: DataFrame, keys: list[str], order: list[str], fields: list[str]
) -> DataFrame:
    """Previous and next row of the same key, as structs `previous` and `following`.

    Inside a slice they are the window neighbours. For the first and last row of a key in a slice
    they come from the ends of the neighbouring slices: at most two rows per slice go on from one
    slice to the next, which bounds the broadcast.
    """
    record = F.struct(*order, *[f for f in fields if f not in order])
    within = W.partitionBy("slice", *keys).orderBy(*order)
    ends = sliced.groupBy("slice", *keys).agg(
        F.min(record).alias("head"), F.max(record).alias("tail")
    )
    across = W.partitionBy(*keys).orderBy("slice")
    edges = (
        ends.select(
            "slice",
            *keys,
            F.lag("tail").over(across).alias("slice_before"),
            F.lead("head").over(across).alias("slice_after"),
        )
        .filter(F.col("slice_before").isNotNull() | F.col("slice_after").isNotNull())
    )
    return (
        sliced.join(F.broadcast(edges), ["slice", *keys], "left")
        .withColumn("previous", F.coalesce(F.lag(record).over(within), F.col("slice_before")))
        .withColumn("following", F.coalesce(F.lead(record).over(within), F.col("slice_after")))
        .drop("slice_before", "slice_after")
    )
