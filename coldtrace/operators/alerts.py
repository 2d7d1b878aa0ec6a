"""Rule and state joins, and the latest row of each alert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.functions import rules as R
from coldtrace.operators.hot import spread_join
from coldtrace.schemas import SENSORS

RULE_COLUMNS = (
    "device_id",
    "alert_id",
    "alert_name",
    "alert_conditions_measurement_item_id",
    "alert_conditions_operator",
    "alert_conditions_threshold",
    "judgment_time",
    "alert_level_id",
    "alert_email_flag",
)


def active_rules(settings: DataFrame) -> DataFrame:
    """Rules that are not soft-deleted and name a measurement item."""
    return settings.filter(
        ~F.col("delete_flag") & F.col("alert_conditions_measurement_item_id").isNotNull()
    ).select(*RULE_COLUMNS)


def rejected_rules(settings: DataFrame) -> DataFrame:
    """Live rules without a measurement item, kept apart for correction."""
    return settings.filter(
        ~F.col("delete_flag") & F.col("alert_conditions_measurement_item_id").isNull()
    )


def evaluate(
    rows: DataFrame, rules: DataFrame, seq: str = "event_id", hot: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """One row per event and rule of its device, judged against the threshold.

    With `how='left'` a device without a rule keeps its row. The 22 sensor columns are reduced to
    the chosen value here, so that later shuffles carry one double.
    """
    item = F.col("alert_conditions_measurement_item_id")
    joined = spread_join(rows, rules, ["device_id"], [seq], how, hot)
    judged = joined.withColumn("current_sensor_value", R.sensor_value("alert_conditions_measurement_item_id")).drop(*SENSORS)
    exceeded = R.threshold_exceeded(
        F.col("current_sensor_value"),
        item,
        F.col("alert_conditions_operator"),
        F.col("alert_conditions_threshold"),
    )
    # Unpacked from a one-element array, so that filters on the outcome stay above and the choice
    # among the sensors is made once per row.
    return judged.select("*", F.inline(F.array(F.struct(exceeded.alias("threshold_exceeded")))))


def with_state(
    judged: DataFrame, state: DataFrame, seq: str = "event_id", hot: DataFrame | None = None
) -> DataFrame:
    """Attach the stored state of (device, alert) and decide whether the alert is triggered."""
    stored = state.select(
        "device_id", "alert_id", "abnormal_start_time", "last_event_time", "alert_fired_time",
        "alert_history_id",
    )
    joined = spread_join(judged, stored, ["device_id", "alert_id"], [seq], "left", hot)
    return joined.withColumn(
        "alert_triggered",
        F.coalesce(
            R.alert_triggered(
                F.col("threshold_exceeded"),
                F.col("event_timestamp"),
                F.col("abnormal_start_time"),
                F.col("judgment_time"),
                F.col("alert_fired_time"),
            ),
            F.lit(False),
        ),
    )


def latest_per_alert(judged: DataFrame, seq: str = "event_id") -> DataFrame:
    """The newest row of each (device, alert); of equal times an exceeded row goes first, then `seq`.

    An aggregate, not a window: each map task keeps one candidate per key, so a key with a very
    large share of the rows costs one task no more than any other.
    """
    rest = [c for c in judged.columns if c not in ("device_id", "alert_id", "event_timestamp", seq)]
    newest = F.max(
        F.struct(
            "event_timestamp",
            F.coalesce(F.col("threshold_exceeded"), F.lit(False)).alias("exceeded_first"),
            F.col(seq),
            *[F.col(c) for c in rest],
        )
    )
    return (
        judged.filter(F.col("alert_id").isNotNull())
        .groupBy("device_id", "alert_id")
        .agg(newest.alias("newest"))
        .select("device_id", "alert_id", "newest.*")
        .drop("exceeded_first")
    )
