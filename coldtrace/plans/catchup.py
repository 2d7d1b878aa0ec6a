"""Backlog of a queue and the time to work it off.

What waits after a slot is what waited before it, plus what arrived, less what could be handled, and
never below nothing. In closed form: with the running sum S of arrivals less capacity, the backlog is
S less the lowest S so far (or nothing, if S never fell below it). Running sums and running minima of
a long series are taken inside ordered slices of time; a slice needs two numbers of the ones before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def slots(rows: DataFrame, key: Column, time: str, unit: str = "hour") -> DataFrame:
    """(part, slot, arrived) for every slot between the first and the last row, empty ones included."""
    counted = rows.groupBy(key.alias("part"), F.date_trunc(unit, time).alias("slot")).agg(
        F.count("*").alias("arrived")
    )
    ends = counted.agg(F.min("slot").alias("first"), F.max("slot").alias("last")).first()
    if ends.first is None:
        return counted
    every = F.sequence(F.lit(ends.first), F.lit(ends.last), F.expr(f"INTERVAL 1 {unit}"))
    grid = counted.select("part").distinct().withColumn("slot", F.explode(every))
    return grid.join(counted, ["part", "slot"], "left").fillna(0, ["arrived"])


def backlog(flow: DataFrame, slice_days: int = 7) -> DataFrame:
    """Adds `backlog`, what waits after each slot, to (part, slot, arrived, capacity)."""
    days = F.floor(F.datediff(F.col("slot"), F.lit("1970-01-01").cast("date")) / slice_days)
    net = F.col("arrived") - F.col("capacity")
    sliced = flow.withColumns({"slice": days.cast("int"), "net": net})
    inside = W.partitionBy("part", "slice").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sliced.withColumn("sum", F.sum("net").over(inside))
    sums = sums.withColumn("low", F.min("sum").over(inside))
    # One row per slice and part; the running values over them are short.
    ends = sums.groupBy("part", "slice").agg(F.sum("net").alias("total"), F.min("sum").alias("lowest"))
    before = W.partitionBy("part").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
    ends = ends.withColumn("reached", F.least(F.lit(0), F.min(F.col("base") + F.col("lowest")).over(before)))
    joined = sums.join(ends.select("part", "slice", "base", F.coalesce("reached", F.lit(0)).alias("reached")), ["part", "slice"])
    waiting = F.col("base") + F.col("sum") - F.least("reached", F.col("base") + F.col("low"))
    return joined.select(*flow.columns, waiting.cast("long").alias("backlog"))


def drained(series: DataFrame, end: Column, unit_seconds: int = 3600) -> DataFrame:
    """Per part the highest backlog, and the minutes from the outage's end until nothing waits.

    NULL minutes: the backlog is not worked off within the series.
    """
    empty = F.min(F.when((F.col("slot") >= end) & (F.col("backlog") == 0), F.col("slot")))
    found = series.groupBy("part").agg(F.max("backlog").alias("highest"), empty.alias("empty_at"))
    # A slot's backlog holds at its end.
    minutes = (F.unix_seconds("empty_at") + unit_seconds - F.unix_seconds(end)) / 60
    return found.select("part", "highest", minutes.cast("long").alias("minutes"))
