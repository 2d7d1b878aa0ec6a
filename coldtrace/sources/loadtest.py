"""Files of load runs: statistics, failures, exceptions, device lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtrace.schemas import EXCEPTIONS, FAILURES, REQUEST_STATS

# Fixed value: the number in a file name is the time the run was saved.
FILE_TIME = r"_(\d+\.\d+)\.csv$"


def _read(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header line and doubled quotes, each row with its file and the saving time."""
    name = F.col("_metadata.file_path")
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return (
        reader.option("multiLine", True)
        .option("enforceSchema", True)
        .csv(path)
        .withColumn("file", name)
        .withColumn("saved_at", F.regexp_extract(name, FILE_TIME, 1).try_cast("double"))
    )


def request_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read(spark, path, REQUEST_STATS)


def failure_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read(spark, path, FAILURES)


def exception_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _read(spark, path, EXCEPTIONS)


def device_range(devices: DataFrame, offset: int, count: int) -> DataFrame:
    """Devices with offset <= id < offset + count."""
    return devices.filter(F.col("device_id").between(offset, offset + count - 1))


def device_list(spark: SparkSession, path: str, offset: int, count: int) -> DataFrame:
    """Names and ids of a device list file; its key column is not read."""
    rows = spark.read.option("header", True).csv(path)
    return device_range(
        rows.select("device_name", F.col("device_id").try_cast("int").alias("device_id")), offset, count
    )
