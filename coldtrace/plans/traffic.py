"""Request statistics, failures, exceptions, and arrivals per poll of a load run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The percentile columns of the statistics.
PERCENTILES = {
    "p50": 0.50,
    "p66": 0.66,
    "p75": 0.75,
    "p80": 0.80,
    "p90": 0.90,
    "p95": 0.95,
    "p98": 0.98,
    "p99": 0.99,
    "p99_9": 0.999,
    "p99_99": 0.9999,
    "p100": 1.0,
}


def rounded_time(ms: Column) -> Column:
    """Response time at two significant digits (half to even), whole ms below 100."""
    return (
        F.when(ms < 100, F.bround(ms, 0))
        .when(ms < 1000, F.bround(ms, -1))
        .when(ms < 10000, F.bround(ms, -2))
        .otherwise(F.bround(ms, -3))
    )


#: Decimal places to which times and lengths are summed.
PLACES = 6


def decimal_sum(column: Column, places: int = PLACES) -> Column:
    """Sum of values rounded to `places` decimals: the same whatever the order of the rows."""
    return F.sum(column.cast(f"decimal(28,{places})"))


def histogram(requests: DataFrame, places: int = PLACES) -> DataFrame:
    """Requests folded to one row per (type, name, rounded time): small however many there were."""
    return (
        requests.withColumn("rounded", rounded_time(F.col("response_time")))
        .groupBy("type", "name", "rounded")
        .agg(
            F.count("*").alias("n"),
            F.count("exception").alias("failed"),
            decimal_sum(F.col("response_time"), places).alias("total_time"),
            decimal_sum(F.col("response_length"), places).alias("total_length"),
            F.min("response_time").alias("min_time"),
            F.max("response_time").alias("max_time"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
        )
    )


def request_stats(requests: DataFrame, with_total: bool = False) -> DataFrame:
    """Statistics per (type, name), and a total row `Aggregated` if asked for.

    Percentiles are read off the histogram: the largest rounded time with at most floor(n * p)
    requests below it. Rates divide by the time from the first to the last request of the run.
    """
    folded = histogram(requests)
    if with_total:
        groups = folded.withColumn(
            "group",
            F.explode(
                F.array(
                    F.struct(F.col("type"), F.col("name")),
                    F.struct(F.lit("").alias("type"), F.lit("Aggregated").alias("name")),
                )
            ),
        ).drop("type", "name").select("group.type", "group.name", "*").drop("group")
        folded = groups.groupBy("type", "name", "rounded").agg(
            *[F.sum(c).alias(c) for c in ("n", "failed", "total_time", "total_length")],
            F.min("min_time").alias("min_time"),
            F.max("max_time").alias("max_time"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    group = W.partitionBy("type", "name")
    ordered = group.orderBy("rounded")
    up_to = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        folded.withColumn("upto", F.sum("n").over(up_to))
        .withColumn("below", F.col("upto") - F.col("n"))
        .withColumn("requests", F.sum("n").over(group))
    )
    share = {name: F.floor(F.col("requests") * F.lit(p)) for name, p in PERCENTILES.items()}
    stats = placed.groupBy("type", "name").agg(
        F.sum("n").alias("request_count"),
        F.sum("failed").alias("failure_count"),
        F.min(F.when(F.col("upto") > (F.col("requests") - 1) / 2, F.col("rounded"))).alias(
            "median_response_time"
        ),
        F.sum("total_time").cast("double").alias("total_time"),
        F.min("min_time").alias("min_response_time"),
        F.max("max_time").alias("max_response_time"),
        F.sum("total_length").cast("double").alias("total_length"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        *[
            F.max(F.when(F.col("below") <= limit, F.col("rounded"))).alias(name)
            for name, limit in share.items()
        ],
    )
    # The run is as long as from its first to its last request.
    run = requests.agg(F.min("at").alias("first"), F.max("at").alias("last"))
    span = run.select(F.unix_micros("last") - F.unix_micros("first")).scalar()
    seconds = span / 1_000_000
    return stats.withColumn("run_seconds", seconds).select(
        "type",
        "name",
        "request_count",
        "failure_count",
        "median_response_time",
        (F.col("total_time") / F.col("request_count")).alias("average_response_time"),
        "min_response_time",
        "max_response_time",
        (F.col("total_length") / F.col("request_count")).alias("average_content_size"),
        (F.col("request_count") / F.col("run_seconds")).alias("requests_per_s"),
        (F.col("failure_count") / F.col("run_seconds")).alias("failures_per_s"),
        (F.col("failure_count") / F.col("request_count")).alias("failure_rate"),
        *PERCENTILES,
    )


def approximate_percentiles(requests: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The percentiles of the unrounded times as a mergeable sketch."""
    points = F.array(*[F.lit(p) for p in PERCENTILES.values()])
    sketch = F.percentile_approx("response_time", points, accuracy).alias("sketch")
    return requests.groupBy("type", "name").agg(sketch).select(
        "type", "name", *[F.col("sketch")[i].alias(name) for i, name in enumerate(PERCENTILES)]
    )


def failures(requests: DataFrame) -> DataFrame:
    return (
        requests.filter(F.col("exception").isNotNull())
        .groupBy(F.col("type").alias("method"), "name", F.col("exception").alias("error"))
        .agg(F.count("*").alias("occurrences"))
    )


def exceptions(raised: DataFrame) -> DataFrame:
    """Exceptions by message and traceback with the nodes they occurred on, nodes in order."""
    per_node = raised.groupBy("message", "traceback", "node").agg(F.count("*").alias("n"))
    return per_node.groupBy("message", "traceback").agg(
        F.sum("n").alias("count"),
        F.concat_ws(", ", F.array_sort(F.collect_set("node"))).alias("nodes"),
    )


def new_arrivals(polls: DataFrame) -> DataFrame:
    """New messages per poll: growth of every partition's last sequence number, never negative.

    Polls are ordered inside their day; a day's first poll looks back at one row per day.
    """
    dated = polls.withColumn("day", F.to_date(F.col("poll_time").try_cast("timestamp")))
    last = dated.groupBy("partition", "day").agg(F.max_by("last_sequence", "poll_time").alias("last"))
    over_days = W.partitionBy("partition").orderBy("day")
    before = last.select("partition", "day", F.lag("last").over(over_days).alias("day_before"))
    inside = W.partitionBy("partition", "day").orderBy("poll_time")
    own = dated.withColumns(
        {"place": F.row_number().over(inside), "poll_before": F.lag("last_sequence").over(inside)}
    )
    joined = own.alias("o").join(
        before.alias("b"),
        F.col("o.partition").eqNullSafe(F.col("b.partition")) & F.col("o.day").eqNullSafe(F.col("b.day")),
    )
    previous = F.when(F.col("place") == 1, F.col("day_before")).otherwise(F.col("poll_before"))
    grown = F.coalesce(F.greatest(F.lit(0), F.col("last_sequence") - previous), F.lit(0))
    grown = F.when(previous.isNotNull() & F.col("last_sequence").isNotNull(), grown).otherwise(0)
    return joined.select("poll_time", grown.alias("grown")).groupBy("poll_time").agg(
        F.sum("grown").alias("new_messages")
    )
