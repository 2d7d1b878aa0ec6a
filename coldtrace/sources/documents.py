"""Stored documents: variants in Parquet, and reading of single fields from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtrace.functions import payload


def shredded(spark: SparkSession) -> None:
    """Variants are written with typed columns for the fields they have in common, and read by field."""
    spark.conf.set("spark.sql.variant.writeShredding.enabled", "true")
    spark.conf.set("spark.sql.variant.inferShreddingSchema", "true")
    spark.conf.set("spark.sql.variant.allowReadingShredded", "true")
    spark.conf.set("spark.sql.variant.pushVariantIntoScan", "true")


def write(rows: DataFrame, path: str, layout: list[str]) -> None:
    """Appends rows with variants, in folders by `layout`."""
    shredded(rows.sparkSession)
    rows.write.mode("append").partitionBy(*layout).parquet(path)


def read(
    spark: SparkSession, path: str, schema: T.StructType, document: str, sensors: Iterable[str]
) -> DataFrame:
    """The stored rows with some sensors of the document as columns; the scan reads those fields only."""
    shredded(spark)
    stored = spark.read.schema(schema).parquet(path)
    others = [name for name in schema.names if name != document]
    fields = [payload.variant_double(F.col(document), name).alias(name) for name in sensors]
    return stored.select(*others, *fields)
