"""Verdicts of measured values against limits, and their roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PASS = "pass"
CAUTION = "caution"
FAIL = "fail"

# Check, category, metric, comparison, limit to pass, limit before it fails.
CHECKS = [
    (6, "sending", "failure_rate", "<=", 0.0, 0.01),
    (7, "sending", "send_median_ms", "<", 5000.0, 10000.0),
    (8, "sending", "send_p95_ms", "<", 5000.0, 10000.0),
    (9, "sending", "rate_deviation_pct", "<=", 1.0, 5.0),
    (10, "sending", "devices_started", ">=", 1.0, 1.0),
    (12, "broker", "poll_failure_rate", "<=", 0.0, 0.0),
    (14, "sending", "failure_rows", "<=", 0.0, 0.0),
    (15, "broker", "new_messages", ">", 0.0, 0.0),
    (16, "broker", "consumer_lag", "<=", 10000.0, 100000.0),
    (17, "broker", "throttled_ratio", "<=", 0.0, 0.0),
    (18, "broker", "in_out_deviation_pct", "<=", 1.0, 5.0),
    (20, "archive", "archive_gap_minutes", "<=", 5.0, 10.0),
    (21, "archive", "archive_delay_minutes", "<=", 10.0, 30.0),
    (22, "lakehouse", "stored_rows", ">", 0.0, 0.0),
    (23, "lakehouse", "freshness_sec", "<=", 60.0, 600.0),
    (24, "lakehouse", "avg_lag_sec", "<", 5.0, 10.0),
    (25, "lakehouse", "records_per_minute", ">=", 7200.0, 3600.0),
    (26, "lakehouse", "device_coverage", ">=", 1.0, 1.0),
    (27, "oltp", "stored_rows_oltp", ">", 0.0, 0.0),
    (28, "oltp", "avg_lag_sec_oltp", "<", 5.0, 10.0),
    (32, "pipeline", "batch_seconds", "<", 10.0, 60.0),
    (33, "pipeline", "error_rate", "<=", 0.01, 0.01),
]
CHECK_SCHEMA = (
    "check_id int, category string, metric string, comparison string, pass_limit double, "
    "fail_limit double"
)


def checks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHECKS, CHECK_SCHEMA)


def _holds(limit: str):
    value, bound = F.col("value"), F.col(limit)
    return (
        F.when(F.col("comparison") == "<", value < bound)
        .when(F.col("comparison") == "<=", value <= bound)
        .when(F.col("comparison") == ">", value > bound)
        .when(F.col("comparison") == ">=", value >= bound)
    )


def judge(measured: DataFrame, check_list: DataFrame) -> DataFrame:
    """Measured metrics (`metric`, `value`) judged; a check without a value is a caution."""
    verdict = (
        F.when(F.col("value").isNull(), CAUTION)
        .when(_holds("pass_limit"), PASS)
        .when(_holds("fail_limit"), CAUTION)
        .otherwise(FAIL)
    )
    return check_list.join(measured, "metric", "left").select(
        "check_id", "category", "metric", "value", verdict.alias("verdict")
    )


def roll_up(judged: DataFrame) -> DataFrame:
    """Verdicts per category, with a total row computed from the rows themselves."""
    counts = [
        F.count_if(F.col("verdict") == verdict).alias(verdict) for verdict in (PASS, FAIL, CAUTION)
    ]
    return judged.rollup("category").agg(*counts).select(
        F.coalesce("category", F.lit("total")).alias("category"), PASS, FAIL, CAUTION
    )
