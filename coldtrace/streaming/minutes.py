"""Minute windows of a stream, given out once, and the rows that came too late for them.

Rows pass a deduplication on their identity and a windowed count, both under one watermark. A window
is written when the watermark has passed its end, and never changed. The same query carries the rows
as they arrived and those that the deduplication let pass: what arrived and did not pass is late, or
was here before, and is kept in a table of its own. No row is in both and none is in neither.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coldtrace.session import adaptive_as_in, use_state_store
from coldtrace.streaming.tables import epoch_of, read_if_exists

TIME = "event_timestamp"
MINUTE, LEFT_OUT = "minute", "left_out"


@dataclass
class MinuteStream:
    """`identity` names a row; `lateness` is how far behind the newest event it may come."""

    spark: SparkSession
    root: str
    lateness: str = "10 minutes"
    identity: tuple[str, ...] = ("event_id",)

    def _told_apart(self, rows: DataFrame) -> DataFrame:
        """Finished windows, and rows with +1 for their arrival and -1 for being counted."""
        narrow = rows.select(*self.identity, "device_id", TIME)

        def counted() -> DataFrame:
            # Made anew for each use: an exchange that two of them shared would hide the watermark.
            return narrow.withWatermark(TIME, self.lateness).dropDuplicatesWithinWatermark(list(self.identity))

        per_device = counted().groupBy(F.window(TIME, "1 minute"), "device_id").agg(F.count("*").alias("records"))
        minutes = per_device.groupBy("window").agg(
            F.sum("records").alias("records"), F.count("*").alias("devices")
        )
        none, count = F.lit(None), F.lit(0).cast("long")
        kinds = {f.name: f.dataType for f in narrow.schema}
        windows = minutes.select(
            F.lit(MINUTE).alias("kind"),
            F.col("window.start").alias("minute"),
            "records",
            "devices",
            *[none.cast(kind).alias(name) for name, kind in kinds.items()],
            count.alias("weight"),
        )

        def weighed(frame: DataFrame, weight: int) -> DataFrame:
            return frame.select(
                F.lit(LEFT_OUT).alias("kind"),
                none.cast("timestamp").alias("minute"),
                count.alias("records"),
                count.alias("devices"),
                # An expression: the union below has no use for the watermark of this column.
                *[F.coalesce(F.col(name), none.cast(kind)).alias(name) for name, kind in kinds.items()],
                F.lit(weight).cast("long").alias("weight"),
            )

        return windows.unionByName(weighed(narrow, 1)).unionByName(weighed(counted(), -1))

    def _write(self, told: DataFrame, batch: int, epoch: int) -> None:
        """One pass: rows whose arrivals outnumber their passes stay, windows meet nothing."""
        keys = [c for c in told.columns if c not in ("records", "devices", "weight")]
        settled = told.groupBy(*keys).agg(
            F.max("records").alias("records"), F.max("devices").alias("devices"), F.sum("weight").alias("times")
        )
        settled = settled.filter((F.col("kind") == MINUTE) | (F.col("times") > 0))
        target = f"{self.root.rstrip('/')}/tables/epoch={epoch}/batch_id={batch}"
        with adaptive_as_in(self.spark, told):
            settled.write.mode("overwrite").partitionBy("kind").parquet(target)

    def _read(self, kind: str) -> DataFrame | None:
        found = read_if_exists(self.spark, f"{self.root.rstrip('/')}/tables")
        return None if found is None else found.filter(F.col("kind") == kind)

    def series(self) -> DataFrame:
        """Records and distinct devices of every finished minute."""
        return self._read(MINUTE).select("minute", "records", "devices")

    def left_out(self) -> DataFrame:
        """Rows behind the watermark and repeated rows, and how often each one was left out."""
        return self._read(LEFT_OUT).select(*self.identity, "device_id", TIME, "times")

    def start(self, rows: DataFrame, checkpoint: str, interval: str | None = "10 seconds") -> StreamingQuery:
        use_state_store(self.spark)
        epoch = epoch_of(self.spark, f"{self.root.rstrip('/')}/epochs", checkpoint)
        writer = self._told_apart(rows).writeStream.foreachBatch(
            lambda frame, batch: self._write(frame, batch, epoch)
        )
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
