"""Declared schemas of messages, masters, state and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# The sensor columns in wire order. Position k (from 1) is measurement item id k.
SENSORS: tuple[str, ...] = (
    "external_temp",
    "set_temp_freezer_1",
    "internal_sensor_temp_freezer_1",
    "internal_temp_freezer_1",
    "df_temp_freezer_1",
    "condensing_temp_freezer_1",
    "adjusted_internal_temp_freezer_1",
    "set_temp_freezer_2",
    "internal_sensor_temp_freezer_2",
    "internal_temp_freezer_2",
    "df_temp_freezer_2",
    "condensing_temp_freezer_2",
    "adjusted_internal_temp_freezer_2",
    "compressor_freezer_1",
    "compressor_freezer_2",
    "fan_motor_1",
    "fan_motor_2",
    "fan_motor_3",
    "fan_motor_4",
    "fan_motor_5",
    "defrost_heater_output_1",
    "defrost_heater_output_2",
)

# Status codes of a firing.
STATUS_FIRING = 1
STATUS_RECOVERED = 2

SENSOR_FIELDS = [T.StructField(name, T.DoubleType()) for name in SENSORS]

MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

ALERT_STATE = T.StructType(
    [
        T.StructField("device_id", T.IntegerType()),
        T.StructField("alert_id", T.IntegerType()),
        T.StructField("abnormal_start_time", T.TimestampType()),
        T.StructField("last_event_time", T.TimestampType()),
        T.StructField("last_sensor_value", T.DoubleType()),
        T.StructField("alert_fired_time", T.TimestampType()),
        T.StructField("alert_history_id", T.LongType()),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("update_time", T.TimestampType()),
    ]
)

ALERT_HISTORY = T.StructType(
    [
        T.StructField("alert_history_id", T.LongType()),
        T.StructField("alert_history_uuid", T.StringType()),
        T.StructField("alert_id", T.IntegerType()),
        T.StructField("alert_occurrence_datetime", T.TimestampType()),
        T.StructField("alert_recovery_datetime", T.TimestampType()),
        T.StructField("alert_status_id", T.IntegerType()),
        T.StructField("alert_value", T.DoubleType()),
        T.StructField("create_date", T.TimestampType()),
        T.StructField("creator", T.IntegerType()),
        T.StructField("update_date", T.TimestampType()),
        T.StructField("modifier", T.IntegerType()),
        T.StructField("delete_flag", T.BooleanType()),
    ]
)

DEVICE_STATUS = T.StructType(
    [
        T.StructField("device_id", T.IntegerType()),
        T.StructField("latest_status", T.StringType()),
        T.StructField("latest_event_timestamp", T.TimestampType()),
        T.StructField("alert_count", T.LongType()),
        T.StructField("last_alert_timestamp", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

_PERCENTILE_FIELDS = [
    T.StructField(f"p{label}", T.DoubleType())
    for label in ("50", "66", "75", "80", "90", "95", "98", "99", "99_9", "99_99", "100")
]

REQUEST_STATS = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("request_count", T.LongType()),
        T.StructField("failure_count", T.LongType()),
        T.StructField("median_response_time", T.DoubleType()),
        T.StructField("average_response_time", T.DoubleType()),
        T.StructField("min_response_time", T.DoubleType()),
        T.StructField("max_response_time", T.DoubleType()),
        T.StructField("average_content_size", T.DoubleType()),
        T.StructField("requests_per_s", T.DoubleType()),
        T.StructField("failures_per_s", T.DoubleType()),
        *_PERCENTILE_FIELDS,
    ]
)

FAILURES = T.StructType(
    [
        T.StructField("method", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("occurrences", T.LongType()),
    ]
)

EXCEPTIONS = T.StructType(
    [
        T.StructField("count", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("traceback", T.StringType()),
        T.StructField("nodes", T.StringType()),
    ]
)
