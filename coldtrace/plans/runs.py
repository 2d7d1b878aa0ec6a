"""Reports over runs: steady rate, phases, sent against stored, change between runs, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RAMP_UP = "ramp-up"
STEADY = "steady"
END = "end"


def steady_rate(series: DataFrame, start: Column, end: Column, devices: Column, interval_s: Column) -> DataFrame:
    """Mean rate of a minute series (`minute`, `records`) in [start, end) against devices / interval."""
    seconds = F.unix_seconds(end) - F.unix_seconds(start)
    chosen = series.filter((F.col("minute") >= start) & (F.col("minute") < end))
    rate, expected = F.col("rate"), F.col("expected_rate")
    return (
        chosen.agg(F.sum("records").alias("records"))
        .withColumn("rate", F.col("records") / seconds)
        .withColumn("expected_rate", devices / interval_s)
        .withColumn("deviation_pct", (rate - expected) / expected * 100)
    )


def phases(series: DataFrame, target_per_minute: float, minutes: int = 5, share: float = 0.95) -> DataFrame:
    """Label the minutes of each run as ramp-up, steady or end.

    Steady runs from the first to the last minute whose mean over the last `minutes` reaches
    `share` of the target. The moving sum is a grouping (every minute adds to the ones after it),
    so a long run needs no ordered pass in one task.
    """
    slots = F.explode(F.sequence(F.lit(0), F.lit(minutes - 1)))
    moved = (
        series.withColumn("slot", slots)
        .withColumn("minute", F.col("minute") + F.make_dt_interval(mins=F.col("slot")))
        .groupBy("run", "minute")
        .agg(
            F.sum("records").alias("moving_sum"),
            F.max(F.when(F.col("slot") == 0, F.col("records"))).alias("records"),
        )
        .filter(F.col("records").isNotNull())
    )
    reached = F.col("moving_sum") >= share * target_per_minute * minutes
    bounds = moved.groupBy("run").agg(
        F.min(F.when(reached, F.col("minute"))).alias("steady_from"),
        F.max(F.when(reached, F.col("minute"))).alias("steady_to"),
    )
    label = (
        F.when(F.col("steady_from").isNull() | (F.col("minute") < F.col("steady_from")), RAMP_UP)
        .when(F.col("minute") <= F.col("steady_to"), STEADY)
        .otherwise(END)
    )
    return moved.join(bounds, "run").select("run", "minute", "records", label.alias("phase"))


def phase_summary(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("run", "phase").agg(
        F.count("*").alias("minutes"),
        F.sum("records").alias("records"),
        F.min("records").alias("min_records"),
        F.max("records").alias("max_records"),
        F.min("minute").alias("first_minute"),
        F.max("minute").alias("last_minute"),
    )


def sent_against_stored(sent: DataFrame, stored: DataFrame, by: list[str]) -> DataFrame:
    """Difference of two counts per group, absolute and in percent of what was sent."""
    a = sent.groupBy(*by).agg(F.count("*").alias("sent"))
    b = stored.groupBy(*by).agg(F.count("*").alias("stored"))
    difference = F.col("stored") - F.col("sent")
    return (
        a.join(b, by, "full")
        .na.fill(0, ["sent", "stored"])
        .withColumn("difference", difference)
        .withColumn(
            "difference_pct", F.when(F.col("sent") != 0, difference / F.col("sent") * 100)
        )
    )


def run_change(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Each metric of a run, its value in the run before, and the change in percent."""
    long = runs.unpivot(["run"], metrics, "metric", "value")
    before = F.lag("value").over(W.partitionBy("metric").orderBy("run"))
    return long.withColumn("previous", before).withColumn(
        "change_pct",
        F.when(F.col("previous") != 0, (F.col("value") - F.col("previous")) / F.col("previous") * 100),
    )


def ratio_of_sums(rows: DataFrame, by: list[str], numerator: Column, denominator: Column) -> DataFrame:
    """Throttled against incoming, or outgoing against incoming, as a ratio of group totals."""
    return rows.groupBy(*by).agg(
        F.sum(numerator).alias("numerator"), F.sum(denominator).alias("denominator")
    ).withColumn(
        "ratio",
        F.when(F.col("denominator") != 0, F.col("numerator") / F.col("denominator")),
    )


def run_summary(samples: DataFrame) -> DataFrame:
    """Connected devices and errors per run from periodic samples."""
    return samples.groupBy("run").agg(
        F.avg("connected").alias("avg_connected"),
        F.max("connected").alias("max_connected"),
        F.sum("errors").alias("errors"),
    )
