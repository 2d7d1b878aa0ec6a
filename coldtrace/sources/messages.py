"""Message sources: the broker, and the raw archive with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtrace.schemas import MESSAGE

# Topic and consumer settings.
TOPIC = "eh-telemetry"
CONSUMER = {
    "failOnDataLoss": "false",
    "kafka.session.timeout.ms": "30000",
    "kafka.heartbeat.interval.ms": "10000",
    "kafka.request.timeout.ms": "60000",
    "kafka.max.poll.interval.ms": "600000",
}


def broker_options(servers: str, topic: str = TOPIC, **extra: str) -> dict[str, str]:
    """Reader options; pass credentials and rate limits (`maxOffsetsPerTrigger`) in `extra`."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **CONSUMER, **extra}


def broker_stream(spark: SparkSession, servers: str, start: str = "latest", **extra: str) -> DataFrame:
    """Topic as a stream. `start` counts only while the checkpoint is new."""
    options = broker_options(servers, **extra)
    return spark.readStream.format("kafka").options(**options).option("startingOffsets", start).load()


def broker_batch(
    spark: SparkSession, servers: str, start: str = "earliest", end: str = "latest", **extra: str
) -> DataFrame:
    """Bounded read of the topic between explicit offsets."""
    if start == "latest":
        raise ValueError("a bounded read cannot start at the latest offset")
    options = broker_options(servers, **extra)
    reader = spark.read.format("kafka").options(**options)
    return reader.option("startingOffsets", start).option("endingOffsets", end).load()


def archive_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The raw archive (or any folder of message files) as a stream, a bounded number of files a trigger."""
    reader = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_files)
    return reader.option("recursiveFileLookup", "true").parquet(path)


def write_archive(
    messages: DataFrame, path: str, layout: tuple[str, ...] = ("source_partition", "date", "hour")
) -> None:
    """Append messages to the raw archive, by default laid out by partition, date and hour of arrival.

    A sparse topic is better off with fewer levels; `date` must be one of them. Folders with many
    messages are written by several tasks.
    """
    levels = {
        "source_partition": F.col("partition"),
        "date": F.to_date("timestamp"),
        "hour": F.hour("timestamp"),
    }
    rows = messages.select("*", *[levels[name].alias(name) for name in layout])
    rows.hint("rebalance", *layout).write.mode("append").partitionBy(*layout).parquet(path)


def read_archive(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Messages of an arrival window [start, end); the date filter prunes folders."""
    rows = spark.read.parquet(path)
    if start is not None:
        begin = F.lit(start).cast("timestamp")
        rows = rows.filter((F.col("date") >= F.to_date(begin)) & (F.col("timestamp") >= begin))
    if end is not None:
        finish = F.lit(end).cast("timestamp")
        rows = rows.filter((F.col("date") <= F.to_date(finish)) & (F.col("timestamp") < finish))
    return rows.select(*MESSAGE.names)


def read_avro_capture(spark: SparkSession, root: str, pattern: str = "*/*/*/*/*/*/*/*/*.avro") -> DataFrame:
    """Captured Avro files `{namespace}/{topic}/{partition}/{Y}/{M}/{D}/{H}/{M}/{S}.avro`.

    Needs the Avro connector on the class path. Narrow `pattern` to read a time range.
    """
    path = F.col("_metadata.file_path")
    partition = F.element_at(F.split(path, "/"), -8).cast("int")
    return (
        spark.read.format("avro")
        .load(f"{root.rstrip('/')}/{pattern}")
        .select(
            F.lit(None).cast("binary").alias("key"),
            F.col("Body").alias("value"),
            F.element_at(F.split(path, "/"), -9).alias("topic"),
            partition.alias("partition"),
            F.col("Offset").cast("long").alias("offset"),
            F.col("EnqueuedTimeUtc").cast("timestamp").alias("timestamp"),
        )
    )
