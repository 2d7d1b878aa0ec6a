"""Raw messages to sensor rows, rejected rows, and the stage funnel.

All of these are narrow projections and filters: one pass over the messages, no shuffle. They take
streaming and bounded frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.functions import payload
from coldtrace.schemas import SENSORS

LINEAGE = ("topic", "partition", "offset", "kafka_timestamp")


def select_message(raw: DataFrame) -> DataFrame:
    return raw.select(
        "value",
        "topic",
        F.col("key").cast("string").alias("message_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        "partition",
        "offset",
    )


def decode(
    raw: DataFrame,
    precedence: Sequence[str] = ("json", "key", "topic"),
    binary: bool = True,
    time_unit: str = "ms",
) -> DataFrame:
    """Every message with its device id, canonical JSON and parsed fields, nothing dropped yet.

    One pass over a text yields the declared fields and the device id, a second one the variant
    (`document`) that goes to storage. With `binary=False` (a JSON-only topic) the plan holds no
    Python step.
    """
    text, device = F.col("text"), F.col("extracted_device_id")
    json_id, json_time = F.col("parsed.device_id"), F.col("parsed.event_timestamp")
    rows = select_message(raw).withColumn("text", F.col("value").cast("string"))
    if binary:
        told = payload.envelope_device(F.col("topic"), F.col("message_key"))
        rows = rows.withColumn("record", payload.decode_binary(F.col("value"), told))
        framed = F.col("record").isNotNull()
        parsed = F.when(~framed, payload.parse_json_payload(text))
        variant = F.when(~framed, payload.to_variant(text))
    else:
        parsed, variant = payload.parse_json_payload(text), payload.to_variant(text)
    rows = rows.withColumns({"parsed": parsed, "variant": variant}).withColumn(
        "extracted_device_id",
        payload.device_id(F.col("topic"), F.col("message_key"), json_id, precedence),
    )
    json_text = F.when(
        device.isNotNull(), payload.with_device_id(text, F.col("parsed"), F.col("variant"), device)
    )
    if binary:
        record_time = payload.epoch_to_timestamp(F.col("record.event_time"), time_unit)
        record_json = F.to_json(
            F.struct(
                device.alias("device_id"),
                payload.iso_text(record_time).alias("event_timestamp"),
                *[F.expr(f"record.{name} AS {name}") for name in SENSORS],
            )
        )
        raw_json = F.when(framed & device.isNotNull(), record_json).otherwise(json_text)
        sensors = [
            F.expr(f"CASE WHEN record IS NOT NULL THEN record.{name} ELSE parsed.{name} END AS {name}")
            for name in SENSORS
        ]
        event_text = F.when(framed, payload.iso_text(record_time)).otherwise(json_time)
        event = F.when(framed, record_time).otherwise(payload.event_time(json_time))
    else:
        raw_json = json_text
        sensors = [F.expr(f"parsed.{name} AS {name}") for name in SENSORS]
        event_text, event = json_time, payload.event_time(json_time)
    rows = rows.withColumn("raw_json", raw_json)
    unchanged = F.col("variant").isNotNull() & (F.col("raw_json") == text)
    fields = F.struct(
        device.alias("device_id"),
        "raw_json",
        F.when(unchanged, F.col("variant")).otherwise(payload.to_variant(F.col("raw_json"))).alias("document"),
        event_text.alias("event_text"),
        event.alias("event_timestamp"),
        *sensors,
    )
    # Unpacking the fields from a one-element array keeps later filters above this point. Pushed
    # below, each of them would decode the payload once more.
    return rows.select(*LINEAGE, "message_key", "value", F.inline(F.array(fields)))


def _stages() -> list[tuple[str, object]]:
    """Acceptance tests in order; a message is kept when it passes all of them."""
    return [
        ("device_id", F.col("device_id").isNotNull()),
        ("json_text", F.coalesce(F.col("raw_json").rlike(payload.JSON_OBJECT), F.lit(False))),
        ("payload", F.col("event_text").isNotNull()),
        ("event_time", F.col("event_timestamp").isNotNull()),
    ]


def _passed_up_to(count: int):
    passed = F.lit(True)
    for _, test in _stages()[:count]:
        passed = passed & test
    return passed


def accepted(decoded: DataFrame) -> DataFrame:
    """Sensor rows of the accepted messages."""
    return decoded.filter(_passed_up_to(len(_stages()))).select(
        "device_id", "event_timestamp", *SENSORS, "raw_json", "document", *LINEAGE
    )


def parse(raw: DataFrame, **options) -> DataFrame:
    return accepted(decode(raw, **options))


def first_failed():
    """Reason a message is rejected for: the first test it failed, NULL for an accepted one."""
    reason = F.lit(None).cast("string")
    for name, test in reversed(_stages()):
        reason = F.when(~test, f"no_{name}").otherwise(reason)
    return reason


REJECTED = (*LINEAGE, "message_key", "value", "device_id", "reason")


def quarantine(decoded: DataFrame) -> DataFrame:
    """Rejected messages with the first test each one failed."""
    return decoded.withColumn("reason", first_failed()).filter(F.col("reason").isNotNull()).select(*REJECTED)


def told_apart(decoded: DataFrame, texts: bool = False) -> DataFrame:
    """Every message with its `reason`, and of each what its kind is stored with, for frames that are held.

    An accepted one has its document (and with `texts` its canonical text), a rejected one its key and
    payload. `accepted_of` and `rejected_of` take the two apart.
    """
    rows = decoded.withColumn("reason", first_failed())
    kept = F.col("reason").isNull()
    text = [F.when(kept, F.col("raw_json")).alias("raw_json")] if texts else []
    return rows.select(
        "device_id",
        "event_timestamp",
        *SENSORS,
        *text,
        F.when(kept, F.col("document")).alias("document"),
        *LINEAGE,
        *[F.when(~kept, F.col(name)).alias(name) for name in ("message_key", "value")],
        "reason",
    )


def accepted_of(told: DataFrame) -> DataFrame:
    return told.filter(F.col("reason").isNull()).drop("message_key", "value", "reason")


def rejected_of(told: DataFrame) -> DataFrame:
    return told.filter(F.col("reason").isNotNull()).select(*REJECTED)


def stage_names() -> list[str]:
    return ["raw", *[name for name, _ in _stages()]]


def stage_counts() -> list:
    """Rows left after each stage, as aggregates by the stages' names."""
    return [F.count_if(_passed_up_to(i)).alias(name) for i, name in enumerate(stage_names())]


def stage_counts_of_told() -> list:
    """The same of messages told apart."""
    names = stage_names()
    failed = [F.col("reason").isin([f"no_{name}" for name in names[1 : i + 1]]) for i in range(len(names))]
    return [F.count_if(F.col("reason").isNull() | ~test).alias(name) for name, test in zip(names, failed)]


def funnel(decoded: DataFrame) -> DataFrame:
    """Rows left after each stage, counted in a single pass and laid out one row per stage."""
    layout = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("rows"))
            for i, name in enumerate(stage_names())
        ]
    )
    return decoded.agg(*stage_counts()).select(F.inline(layout))


def payload_sample(decoded: DataFrame, rows: int = 3) -> DataFrame:
    """The first accepted payload texts, by place in the topic, for inspection."""
    accepted_texts = decoded.filter(_passed_up_to(2)).select("topic", "partition", "offset", "message_key", "raw_json")
    return accepted_texts.orderBy("topic", "partition", "offset").limit(rows)
