"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed rule or state join is split even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without call sites in error messages a query of many columns is built with far fewer calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "coldtrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_state_store(spark: SparkSession) -> None:
    """Streaming state in RocksDB, of which a batch writes the changes only."""
    store = "spark.sql.streaming.stateStore"
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set(f"{store}.providerClass", provider)
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")


#: Whether the shuffle files of a query go when it ends. Otherwise they stay until the driver collects
#: its garbage, which a run of few large batches hardly ever does.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Whether held columns are compressed, for which every value of a wide text is hashed.
COMPRESS_HELD = "spark.sql.inMemoryColumnarStorage.compressed"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of a session for the time being."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def adaptive_as_in(owner: SparkSession, batch: DataFrame) -> Iterator[None]:
    """Adaptive execution for the bounded work on a micro-batch, where `owner` has it.

    A stream switches it off in its own session, since its state must stay in the partitions it is in.
    The frames made of a batch have no such state; without it each of their shuffles ends in as many
    tasks and files as there are shuffle partitions, however few rows there are.
    """
    name = "spark.sql.adaptive.enabled"
    with settings(batch.sparkSession, {name: owner.conf.get(name)}):
        yield


def release_shuffles(spark: SparkSession) -> None:
    """Has Spark remove the files of shuffles that nothing refers to any more, as those of past batches."""
    gc.collect()
    spark._jvm.System.gc()


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application for intermediate tables, under `spark.checkpoint.dir`.

    It can be removed once the application has ended. A local run without the setting gets a folder
    of its own. On a cluster a local folder would be lost with its machine, so the setting is
    required there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.mkdtemp(prefix="coldtrace-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/coldtrace-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, **options) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    `options` are those of the writer.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
