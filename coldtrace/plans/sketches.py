"""Distinct counts that can be put together: a sketch per minute, united for any window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a sketch as a power of two, and its relative standard error. A sketch of few keys lists
#: them, so that minutes stay small whatever the precision.
PRECISION = 14
ERROR = 1.04 / 2 ** (PRECISION / 2)


def per_minute(rows: DataFrame, time: str = "event_timestamp", key: str = "device_id") -> DataFrame:
    """(minute, records, devices): counts and a sketch of the keys of every minute, to be stored."""
    return rows.groupBy(F.date_trunc("minute", time).alias("minute")).agg(
        F.count("*").alias("records"), F.hll_sketch_agg(key, PRECISION).alias("devices")
    )


def per_window(minutes: DataFrame, window: str) -> DataFrame:
    """Records and about how many distinct keys in windows of any length, from stored minutes."""
    begin = F.window("minute", window)["start"]
    return minutes.groupBy(begin.alias("window_start")).agg(
        F.sum("records").alias("records"),
        F.hll_sketch_estimate(F.hll_union_agg("devices")).alias("about"),
    )


def within(about: Column, exact: Column, deviations: float = 6.0) -> Column:
    """Whether an estimate is within some standard errors of the exact count, or next to it.

    Of estimates that are as good as they can be one in 370 lies beyond three standard errors, one in
    500 million beyond six: a bound for all windows of a table at once.
    """
    return F.abs(about - exact) <= F.greatest(F.lit(1.0), deviations * ERROR * exact)
