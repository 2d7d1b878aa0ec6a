"""Validation reports over the sensor fact table.

Grouped reports use partial aggregation only. `as_of` stands for the clock and is always given, so
that a report can be repeated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TIME = "event_timestamp"


def _moment(value: Column | datetime | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def recent(rows: DataFrame, as_of, minutes: int) -> DataFrame:
    """Rows of the last `minutes` up to `as_of`; later ones do not exist yet at that time."""
    span = F.make_dt_interval(mins=F.lit(minutes))
    return rows.filter((F.col(TIME) >= _moment(as_of) - span) & (F.col(TIME) <= _moment(as_of)))


def within(rows: DataFrame, start, end, inclusive_end: bool = True) -> DataFrame:
    """Rows of an absolute window; the half-open form leaves out a partial last minute."""
    time = F.col(TIME)
    upper = time <= _moment(end) if inclusive_end else time < _moment(end)
    return rows.filter((time >= _moment(start)) & upper)


def total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("records"))


def per_device(rows: DataFrame) -> DataFrame:
    return rows.groupBy("device_id").agg(
        F.count("*").alias("cnt"), F.max(TIME).alias("latest")
    )


def per_minute(rows: DataFrame) -> DataFrame:
    """Records and distinct devices per minute."""
    return rows.groupBy(F.date_trunc("minute", TIME).alias("minute")).agg(
        F.count("*").alias("records"), F.countDistinct("device_id").alias("devices")
    )


def distinct_devices(rows: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(count(F.col("device_id")).alias("devices"))


def _lag_report(seconds: Column, count_name: str) -> list[Column]:
    return [
        F.avg(seconds).alias("avg_lag_sec"),
        F.max(seconds).alias("max_lag_sec"),
        F.count("*").alias(count_name),
    ]


def ingest_lag(rows: DataFrame) -> DataFrame:
    """Delay between an event and its storing, in whole seconds."""
    seconds = F.unix_seconds("create_time") - F.unix_seconds(TIME)
    return rows.agg(*_lag_report(seconds, "records"))


def staleness(rows: DataFrame, as_of, minutes: int = 1) -> DataFrame:
    """Age of the rows of the last minutes at `as_of`."""
    now = _moment(as_of)
    seconds = F.unix_seconds(now) - F.unix_seconds(TIME)
    return recent(rows, now, minutes).agg(*_lag_report(seconds, "records_last_1min"))


def workers_per_minute(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy(F.date_trunc("minute", "start_time").alias("minute")).agg(
        F.countDistinct("instance_id").alias("worker_count")
    )


def latest_rows(rows: DataFrame, count: int, seq: str = "event_id") -> DataFrame:
    """Newest rows; each task keeps its own top rows, so nothing is sorted as a whole."""
    return rows.orderBy(F.desc(TIME), F.desc(seq)).limit(count)


def busiest_devices(rows: DataFrame, count: int) -> DataFrame:
    """Devices with the most records, in order; of equal ones the smaller id comes first."""
    return per_device(rows).orderBy(F.desc("cnt"), "device_id").limit(count)


def largest_gap_minutes(times: DataFrame) -> DataFrame:
    """Longest pause between minutes with arrivals (`timestamp`), in minutes.

    Minutes are ordered inside their day; pauses across days come from one row per day.
    """
    minutes = times.select(F.date_trunc("minute", "timestamp").alias("minute")).filter("minute IS NOT NULL").distinct()
    minutes = minutes.withColumn("day", F.to_date("minute"))
    pause = lambda start, before: (F.unix_seconds(start) - F.unix_seconds(before)) / 60
    in_day = W.partitionBy("day").orderBy("minute")
    inside = minutes.select(pause(F.col("minute"), F.lag("minute").over(in_day)).alias("pause"))
    days = minutes.groupBy("day").agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    across = days.select(pause(F.col("first"), F.lag("last").over(W.orderBy("day"))).alias("pause"))
    return inside.unionByName(across).agg(F.max("pause").alias("gap_minutes"))


def current_per_device(rows: DataFrame, columns: list[str], seq: str = "event_id") -> DataFrame:
    """Newest row of each device, as an aggregate with map-side combine."""
    newest = F.max(F.struct(TIME, seq, *columns)).alias("newest")
    return rows.groupBy("device_id").agg(newest).select("device_id", "newest.*")


def count_check(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """Row count of a sink against the count it should hold."""
    want = expected.agg(F.count("*")).scalar()
    return (
        stored.agg(F.count("*").alias("stored_rows"))
        .withColumn("expected_rows", want)
        .withColumn("matches", F.col("stored_rows") == F.col("expected_rows"))
    )


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Classify the row keys of two stores; keys repeated in a store are counted once.

    One grouping of both sides' keys does the work of a full outer join with half its shuffles.
    """
    both = left.select(*keys, F.lit(True).alias("in_left")).unionByName(
        right.select(*keys, F.lit(False).alias("in_left"))
    )
    side = (
        F.when(F.col("any_left") & F.col("all_left"), "only_left")
        .when(F.col("any_left"), "both")
        .otherwise("only_right")
    )
    seen = both.groupBy(*keys).agg(
        F.max("in_left").alias("any_left"), F.min("in_left").alias("all_left")
    )
    return seen.select(*keys, side.alias("side"))


def bucket_digests(rows: DataFrame, keys: list[str], values: list[str], buckets: int) -> DataFrame:
    """Per hash bucket of the keys: rows, and sum and exclusive or of their hashes, in any order."""
    row = F.xxhash64(*keys, *values)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return rows.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("total"), F.bit_xor(row).alias("mixed")
    )


def reconcile_buckets(
    left: DataFrame, right: DataFrame, keys: list[str], values: list[str], buckets: int = 4096
) -> DataFrame:
    """Rows of two stores that differ: `only_left`, `only_right`, or `differs` in a value.

    Equal buckets are told by their digests, which are combined on the map side; only rows of unequal
    buckets are shuffled. Repeated keys are compared by the digest of all their rows.
    """
    sides = [bucket_digests(side, keys, values, buckets) for side in (left, right)]
    named = [s.select("bucket", F.struct("rows", "total", "mixed").alias(n)) for s, n in zip(sides, ("l", "r"))]
    unequal = named[0].join(named[1], "bucket", "full").filter(~F.col("l").eqNullSafe(F.col("r")))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    # At most `buckets` numbers.
    wanted = F.broadcast(unequal.select("bucket"))

    def of(side: DataFrame, name: str) -> DataFrame:
        rows = side.select(*keys, *values, bucket.alias("bucket")).join(wanted, "bucket", "left_semi")
        values_of = F.xxhash64(*values).cast("decimal(38,0)") if values else F.lit(0).cast("decimal(38,0)")
        return rows.select(*keys, F.lit(name).alias("store"), values_of.alias("values"))

    held = lambda name: F.col("store") == name
    grouped = of(left, "left").unionByName(of(right, "right")).groupBy(*keys).agg(
        *[F.count_if(held(n)).alias(f"{n}_rows") for n in ("left", "right")],
        *[F.sum(F.when(held(n), F.col("values"))).alias(n) for n in ("left", "right")],
    )
    same = (F.col("left_rows") == F.col("right_rows")) & F.col("left").eqNullSafe(F.col("right"))
    side = (
        F.when(F.col("right_rows") == 0, "only_left")
        .when(F.col("left_rows") == 0, "only_right")
        .otherwise("differs")
    )
    return grouped.filter(~same).select(*keys, side.alias("side"))


def reconcile_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Record and device counts of two stores side by side."""
    sides = left.select("device_id", F.lit("left").alias("store")).unionAll(
        right.select("device_id", F.lit("right").alias("store"))
    )
    return sides.groupBy("store").agg(
        F.count("*").alias("records"), F.countDistinct("device_id").alias("devices")
    )
