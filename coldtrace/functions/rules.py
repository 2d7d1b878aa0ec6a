"""Alert judgement as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coldtrace.schemas import SENSORS

# Update patterns of the alert state.
RECOVERY = "recovery"
ALERT_FIRED = "alert_fired"
ABNORMAL_START = "abnormal_start"

# Accepted comparison operators.
COMPARISONS = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


def sensor_value(item_column: str) -> Column:
    """The sensor column a measurement item id stands for, NULL for any other id."""
    cases = " ".join(f"WHEN {number} THEN {name}" for number, name in enumerate(SENSORS, start=1))
    return F.expr(f"CASE {item_column} {cases} END")


def threshold_exceeded(value: Column, item_id: Column, operator: Column, threshold: Column) -> Column:
    """One comparison of the chosen value.

    An unknown operator or item id gives false, a missing value or threshold gives NULL.
    """
    outcome = F.lit(False)
    for symbol, compare in COMPARISONS.items():
        outcome = F.when(operator == symbol, compare(value, threshold)).otherwise(outcome)
    known_item = F.coalesce(item_id.between(1, len(SENSORS)), F.lit(False))
    return F.when(known_item, outcome).otherwise(F.lit(False))


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Difference in whole seconds, each side floored first."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def long_enough(event: Column, start: Column, judgment_minutes: Column) -> Column:
    return elapsed_seconds(event, start) >= judgment_minutes.cast("long") * 60


def alert_triggered(
    exceeded: Column, event: Column, start: Column, judgment_minutes: Column, fired_time: Column
) -> Column:
    """Exceeded now, abnormal for long enough, and not fired yet."""
    return exceeded & start.isNotNull() & long_enough(event, start, judgment_minutes) & fired_time.isNull()


def update_pattern(exceeded: Column, triggered: Column) -> Column:
    return (
        F.when(~F.coalesce(exceeded, F.lit(False)), RECOVERY)
        .when(triggered, ALERT_FIRED)
        .otherwise(ABNORMAL_START)
    )


def should_enqueue_email(triggered: Column, email_flag: Column) -> Column:
    return F.coalesce(triggered & email_flag, F.lit(False))


def history_id(device: Column, alert: Column, occurrence: Column) -> Column:
    """Key of a firing, computed from what identifies it, so a repeated batch gives the same key."""
    return F.xxhash64(device, alert, occurrence)


def history_uuid(device: Column, alert: Column, occurrence: Column) -> Column:
    digest = F.md5(F.concat_ws("|", device, alert, F.unix_micros(occurrence)))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
