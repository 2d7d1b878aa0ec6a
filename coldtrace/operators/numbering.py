"""Global row numbers without a single ordered task, and the device shares of workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 1_000_000


def number_rows(rows: DataFrame, key: str, block: int = BLOCK) -> DataFrame:
    """Adds `rn`, the rank of a unique integer `key` from 1, in two passes.

    Rows are numbered inside blocks of the key range; the blocks' counts, at most the key range
    divided by the block length, are summed up and added.
    """
    blocked = rows.withColumn("block", F.floor(F.col(key) / block))
    counts = blocked.groupBy("block").agg(F.count("*").alias("n"))
    before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("block").orderBy(key))
    return (
        blocked.withColumn("inside", inside)
        .join(offsets, "block")
        .withColumn("rn", F.col("offset") + F.col("inside"))
        .drop("block", "inside", "offset")
    )


def share_out(numbered: DataFrame, workers: int) -> DataFrame:
    """Adds `worker`: equal chunks of floor(n / workers) rows, the last worker takes the rest."""
    total = numbered.agg(F.count("*")).scalar()
    # Fewer rows than workers give chunks of zero: all rows go to the last worker.
    chunk = F.floor(total / workers)
    slot = F.when(chunk > 0, F.floor((F.col("rn") - 1) / chunk)).otherwise(workers - 1)
    return numbered.withColumn("worker", F.least(slot, F.lit(workers - 1)).cast("int"))


def fixed_range(device_id: Column, size: int = 1300) -> Column:
    """Worker of a device under fixed id ranges starting at 1."""
    return F.floor((device_id - 1) / size).cast("int")
