"""Progress of streaming queries as a table, and its measures for the verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, batch_id long, at timestamp, input_rows long, "
    "input_rows_per_second double, processed_rows_per_second double, batch_ms long, backlog long"
)


def _backlog(sources) -> int | None:
    """Rows or files the sources report as not read yet."""
    names = ("maxOffsetsBehindLatest", "numFilesOutstanding")
    values = [s.metrics.get(name) for s in sources for name in names]
    found = [int(float(v)) for v in values if v is not None]
    return sum(found) if found else None


def progress_row(progress) -> tuple:
    return (
        str(progress.id),
        str(progress.runId),
        progress.batchId,
        progress.timestamp,
        progress.numInputRows,
        progress.inputRowsPerSecond,
        progress.processedRowsPerSecond,
        progress.durationMs.get("triggerExecution"),
        _backlog(progress.sources),
    )


def _frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    text = PROGRESS.replace("at timestamp", "at string")
    return spark.createDataFrame(rows, text).withColumn("at", F.try_to_timestamp("at"))


def recent_progress(query: StreamingQuery) -> DataFrame:
    """The progress reports the query still holds."""
    rows = [progress_row(p) for p in query.recentProgress]
    return _frame(SparkSession.active(), rows)


class ProgressTable(StreamingQueryListener):
    """Appends every progress report to a table."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = _frame(self._spark, [progress_row(event.progress)])
        rows.write.mode("append").parquet(self._path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def measures(progress: DataFrame) -> DataFrame:
    """Measures of a run in the (`metric`, `value`) form the verdicts take."""
    summed = progress.agg(
        (F.max("batch_ms") / 1000).alias("batch_seconds"),
        F.max("backlog").cast("double").alias("consumer_lag"),
        (F.sum("input_rows") / (F.sum("batch_ms") / 1000)).alias("rows_per_second"),
    )
    return summed.unpivot([], summed.columns, "metric", "value")


def catch_up_minutes(backlog_rows: float, arrival_per_s: float, handled_per_s: float) -> float | None:
    """Time to work off a backlog while new rows keep coming; None if it never shrinks."""
    spare = handled_per_s - arrival_per_s
    return backlog_rows / spare / 60 if spare > 0 else None
