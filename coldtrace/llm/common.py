"""Word rules, table access and join helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from coldtrace.session import materialise

#: White space that separates words, as characters and as a pattern; everything else is a word.
WHITE = " \t\n\x0b\f\r"
WHITE_PATTERN = r"[\x20\x09-\x0D]"
#: A side of a join is broadcast only if it has at most so many rows, counted beforehand.
BROADCAST_ROWS = 50_000
#: Ways over which the rows of one key are dealt in salted joins.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; empty for NULL and for texts without a word."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WHITE_PATTERN + "+")).otherwise(
        F.array().cast("array<string>")
    )


def n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return (
        F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, WHITE_PATTERN + "+")))
        .otherwise(0)
        .cast("long")
    )


def uniform(key: Column, seed: str) -> Column:
    """Repeatable draw in [0, 1) from the digest of `seed` and a string key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Has Arrow batches end at `size` bytes: several copies of one exist in a worker at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` written once and counted: broadcast if it has at most `rows` rows, else left to Spark."""
    kept = materialise(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def extended(schema: StructType, **more: str) -> StructType:
    """A schema with further columns, given by name and type."""
    added = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in more.items()))
    return StructType([*schema.fields, *added.fields])


def salted_join(
    big: DataFrame, small: DataFrame, keys: list[str], spread_by: list[Column], how: str = "left"
) -> DataFrame:
    """Equi-join that deals the rows of every key of `big` over SALTS tasks.

    `small` must be far smaller than `big`; its rows are repeated once per salt.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("__salt", salt).join(copies, [*keys, "__salt"], how).drop("__salt")


def dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by `keys`, those of equal keys side by side."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys, from batches in which they stand side by side."""
    held: list[pa.RecordBatch] = []

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        edges = np.zeros(batch.num_rows - 1, bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            edges |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(edges) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and not (a == 0 and same(held[-1], held[-1].num_rows - 1, batch, 0)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
