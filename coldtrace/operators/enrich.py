"""Joins with the device and organization masters.

The masters carry no broadcast hint: Spark broadcasts them while they stay below
`spark.sql.autoBroadcastJoinThreshold` and shuffles, splitting skewed partitions, beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_devices(rows: DataFrame, devices: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """Left join with the device master; `drop_deleted` leaves soft-deleted devices out of it."""
    if drop_deleted:
        devices = devices.filter(~F.col("delete_flag"))
    return rows.join(devices, "device_id", "left")


def with_known_organization(rows: DataFrame, organizations: DataFrame) -> DataFrame:
    """Keep rows of an organization in the master, which also drops rows without any.

    A semi join keeps one output row per input row even when organization ids repeat.
    """
    return rows.join(organizations.select("organization_id"), "organization_id", "left_semi")


def enrich(
    rows: DataFrame, devices: DataFrame, organizations: DataFrame, drop_deleted: bool = False
) -> DataFrame:
    return with_known_organization(with_devices(rows, devices, drop_deleted), organizations)


def unknown_devices(rows: DataFrame, devices: DataFrame, organizations: DataFrame) -> DataFrame:
    """Count of rows the enrichment drops, per device and cause."""
    per_device = rows.groupBy("device_id").agg(F.count("*").alias("dropped_rows"))
    known = organizations.select("organization_id").distinct().withColumn("known", F.lit(True))
    return (
        per_device.join(devices.select("device_id", "organization_id"), "device_id", "left")
        .join(known, "organization_id", "left")
        .filter(F.col("known").isNull())
        .select(
            "device_id",
            F.when(F.col("organization_id").isNull(), "device")
            .otherwise("organization")
            .alias("missing"),
            "dropped_rows",
        )
    )


def silent_devices(rows: DataFrame, devices: DataFrame) -> DataFrame:
    """Expected devices without any row."""
    return devices.join(rows.select("device_id"), "device_id", "left_anti")
