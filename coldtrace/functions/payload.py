"""Decoding of message payloads: device id, JSON, fixed-layout binary, event time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtrace.schemas import SENSOR_FIELDS, SENSORS

# Little-endian INT32 device, INT64 time, 22 FLOAT64 sensors; 188 bytes a record.
BINARY_RECORD = np.dtype(
    [("device_id", "<i4"), ("event_time", "<i8"), *[(name, "<f8") for name in SENSORS]]
)
BINARY_SIZE = 188
# Shape of an accepted JSON text, and the device number inside a topic name.
JSON_OBJECT = r"^\{.*\}"
TOPIC_NUMBER = r"(\d+)/messages"

JSON_PAYLOAD = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("event_timestamp", T.StringType()),
        *SENSOR_FIELDS,
    ]
)
BINARY_STRUCT = T.StructType(
    [
        T.StructField("device_id", T.IntegerType()),
        T.StructField("event_time", T.LongType()),
        *SENSOR_FIELDS,
    ]
)


def json_path(value: Column, path: str) -> Column:
    """Text at a path of a JSON payload given in bytes, NULL where there is none."""
    return F.get_json_object(value.cast("string"), path)


def device_id(
    topic: Column, key: Column, json_id: Column, precedence: Sequence[str] = ("json", "key", "topic")
) -> Column:
    """Device id from the JSON field, the message key or the topic, first usable one wins."""
    candidates = {"json": json_id, "key": key, "topic": F.regexp_extract(topic, TOPIC_NUMBER, 1)}
    return F.coalesce(*[candidates[name].try_cast("int") for name in precedence])


def envelope_device(topic: Column, key: Column) -> Column:
    """Device id as the message key or the topic tells it, whatever the payload."""
    return device_id(topic, key, F.lit(None).cast("string"), ("key", "topic"))


def is_binary_record(value: Column, device: Column | None = None) -> Column:
    """A payload of the record length that does not open like a JSON object.

    The numbers of one device in 256 open with the byte of `{`. Such a payload is a record when its
    first four bytes are the number of `device`, which the envelope tells, and the highest byte of its
    time is one that no text has. Without `device` it counts as text.
    """
    sized, opens = F.length(value) == BINARY_SIZE, F.substring(value, 1, 1) == F.lit(b"{")
    if device is None:
        return sized & ~opens
    digits = F.hex(F.substring(value, 1, 4))
    number = F.conv(F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)]), 16, 10)
    no_text = F.substring(value, 12, 1).isin(b"\x00", b"\xff")
    same = F.coalesce(no_text & (number.cast("long") == device), F.lit(False))
    return F.when(sized & opens, same).otherwise(sized)


@F.arrow_udf(BINARY_STRUCT)
def _decode_records(values: pa.Array) -> pa.Array:
    usable = pc.fill_null(pc.equal(pc.binary_length(values), BINARY_SIZE), False)
    picked = values.filter(usable).cast(pa.binary())
    records = np.empty(0, BINARY_RECORD)
    if len(picked):
        # The kept records lie one after the other in the value buffer.
        _, offsets, body = picked.buffers()
        start = np.frombuffer(offsets, "<i4", count=1, offset=4 * picked.offset)[0]
        records = np.frombuffer(body, BINARY_RECORD, count=len(picked), offset=start)
    columns = [pa.array(np.ascontiguousarray(records[name])) for name in BINARY_RECORD.names]
    decoded = pa.StructArray.from_arrays(columns, names=list(BINARY_RECORD.names))
    mask = usable.to_numpy(zero_copy_only=False)
    position = pa.array(np.cumsum(mask) - 1, mask=~mask)
    return decoded.take(position)


def decode_binary(value: Column, device: Column | None = None) -> Column:
    """Struct of a binary record, NULL for any other payload (decoded one Arrow batch at a time)."""
    return _decode_records(F.when(is_binary_record(value, device), value))


def epoch_to_timestamp(number: Column, unit: str = "ms") -> Column:
    """Epoch number to timestamp; the wire format does not state its unit."""
    functions = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}
    return functions[unit](number)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_json_payload(text: Column) -> Column:
    """Declared fields of a JSON text, the device id as it is written there."""
    return F.from_json(text, JSON_PAYLOAD)


def with_device_id(text: Column, parsed: Column, variant: Column, device: Column) -> Column:
    """Canonical JSON text: it carries the judged device id, once, in front, and is valid JSON.

    `parsed` holds the declared fields and `variant` the whole text, NULL where it is no valid JSON.
    A valid text with the right id stays as it is. Any other object is written anew from its fields:
    of repeated ones the last one stays, NaN and infinities, which the fields accept, come in quotes.
    If fields inside of it repeat, the declared ones are all that can be told. Texts that do not have
    the accepted shape, among them those of several lines, stay.
    """
    right = variant.isNotNull() & (parsed["device_id"] == device.cast("string"))
    fields = F.from_json(text, "map<string,variant>")
    names = F.map_keys(fields)
    later = lambda entry, at: F.array_position(F.slice(names, at + 2, F.size(names)), entry["key"])
    others = F.filter(
        F.map_entries(fields), lambda entry, at: (entry["key"] != "device_id") & (later(entry, at) == 0)
    )
    own = F.array(F.struct(F.lit("device_id").alias("key"), device.cast("variant").alias("value")))
    anew = F.to_json(F.map_from_entries(F.concat(own, others)))
    declared = F.when(
        parsed["event_timestamp"].isNotNull(),
        F.to_json(F.struct(device.alias("device_id"), *[parsed[f].alias(f) for f in JSON_PAYLOAD.names[1:]])),
    )
    shaped = text.rlike(JSON_OBJECT)
    return F.when(right | ~shaped, text).otherwise(F.coalesce(anew, declared, text))


def event_time(text: Column) -> Column:
    """ISO-8601 text to timestamp, NULL instead of an error for other text."""
    return F.try_to_timestamp(text)


def to_variant(text: Column) -> Column:
    return F.try_parse_json(text)


def variant_double(payload: Column, name: str) -> Column:
    """One sensor read back from the retained payload."""
    return F.try_variant_get(payload, f"$.{name}", "double")
