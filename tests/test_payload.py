from __future__ import annotations

import json
import math
import struct
from datetime import datetime

import pytest
from conftest import at
from pyspark.sql import functions as F

from coldtrace.functions import frames, payload
from coldtrace.operators import parse
from coldtrace.schemas import MESSAGE, SENSORS

TOPIC = "devices/loadtest-device-00042/messages/events/"
TIME = "2024-01-01T00:00:00.000Z"


def messages(spark, rows):
    """Rows of (key, value, topic), numbered by offset."""
    full = [
        (k and k.encode(), v.encode() if isinstance(v, str) else v, t, 0, i, datetime(2024, 1, 1))
        for i, (k, v, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, MESSAGE)


def record(device=7, millis=1704067200000, values=None):
    return struct.pack("<iq22d", device, millis, *(values or [float(i) for i in range(22)]))


def decoded(spark, rows, **options):
    return parse.decode(messages(spark, rows), **options).orderBy("offset").collect()


def test_device_id_precedence(spark):
    rows = [
        ("5", json.dumps({"device_id": 3}), TOPIC),
        ("5", "{}", TOPIC),
        ("x", "{}", TOPIC),
        (None, "{}", "devices/other/messages/events/"),
        ("5", json.dumps({"device_id": "9"}), TOPIC),
        ("5", json.dumps({"device_id": 1.5}), TOPIC),
        ("5", json.dumps({"device_id": 3_000_000_000}), TOPIC),
        ("5", "{bad}", TOPIC),
    ]
    assert [r.device_id for r in decoded(spark, rows)] == [3, 5, 42, None, 9, 5, 5, 5]
    topic_first = decoded(spark, rows[:1], precedence=("topic", "key", "json"))
    assert topic_first[0].device_id == 42


def test_missing_device_id_is_put_into_the_text(spark):
    rows = [("5", "{}", TOPIC), ("5", '{ "fan_motor_1": 2}', TOPIC), ("5", '{"device_id": 6}', TOPIC)]
    texts = [json.loads(r.raw_json) for r in decoded(spark, rows)]
    assert texts == [{"device_id": 5}, {"device_id": 5, "fan_motor_1": 2}, {"device_id": 6}]


@pytest.mark.parametrize("binary", [True, False])
def test_accepted_and_rejected(spark, binary):
    good = json.dumps({"device_id": 1, "event_timestamp": TIME, "external_temp": 2.5, "_padding": "xx"})
    rows = [
        ("1", good, TOPIC),
        ("1", good + " trailing", TOPIC),
        ("1", good.replace("{", "{\n", 1).replace("}", "\n}"), TOPIC),
        ("1", "{bad}", TOPIC),
        ("1", "text", TOPIC),
        ("1", json.dumps({"device_id": 1}), TOPIC),
        ("1", json.dumps({"device_id": 1, "event_timestamp": "soon"}), TOPIC),
        (None, json.dumps({"event_timestamp": TIME}), "t"),
        (None, None, TOPIC),
    ]
    whole = parse.decode(messages(spark, rows), binary=binary)
    kept = parse.accepted(whole).orderBy("offset").collect()
    assert [r.offset for r in kept] == [0, 1]
    assert kept[0].event_timestamp == at("2024-01-01") and kept[0].external_temp == 2.5
    assert kept[0].fan_motor_5 is None
    reasons = {r.offset: r.reason for r in parse.quarantine(whole).collect()}
    assert reasons == {
        2: "no_json_text",
        3: "no_payload",
        4: "no_json_text",
        5: "no_payload",
        6: "no_event_time",
        7: "no_device_id",
        8: "no_json_text",
    }
    funnel = [r.rows for r in parse.funnel(whole).orderBy("step").collect()]
    assert funnel == [9, 8, 5, 3, 2]


def test_text_and_nan_values(spark):
    body = f'{{"device_id":1,"event_timestamp":"{TIME}","fan_motor_1":"NaN","fan_motor_2":"warm"}}'
    row = decoded(spark, [("1", body, TOPIC)])[0]
    assert math.isnan(row.fan_motor_1)
    assert row.fan_motor_2 is None


def test_binary_records(spark):
    assert struct.calcsize("<iq22d") == payload.BINARY_SIZE == payload.BINARY_RECORD.itemsize
    special = [math.nan, math.inf, -0.0, 5e-324, *[float(i) for i in range(18)]]
    opens_like_json = record(device=0x7B)
    rows = [
        ("7", record(), TOPIC),
        ("7", record()[:-1], TOPIC),
        ("7", record() + b"x", TOPIC),
        ("8", record(values=special), TOPIC),
        ("7", opens_like_json, TOPIC),
        (None, None, TOPIC),
    ]
    out = decoded(spark, rows)
    assert [r.event_timestamp for r in out] == [at("2024-01-01"), None, None, at("2024-01-01"), None, None]
    assert [out[0][name] for name in SENSORS] == [float(i) for i in range(22)]
    assert math.isnan(out[3].external_temp)
    assert [out[3][name] for name in SENSORS[1:4]] == [math.inf, 0.0, 5e-324]
    text = json.loads(out[0].raw_json)
    assert text["device_id"] == 7 and text["fan_motor_5"] == 19.0
    seconds = decoded(spark, [("7", record(millis=1704067200), TOPIC)], time_unit="s")
    assert seconds[0].event_timestamp == at("2024-01-01")


def test_records_of_devices_whose_number_opens_like_json(spark):
    """Told from a text by the device of the message key, or of the topic without a key."""
    number = 0x017B
    text = json.dumps({"device_id": 1, "event_timestamp": TIME, "_padding": ""})
    text = text.replace('""', f'"{"x" * (payload.BINARY_SIZE - len(text))}"')
    opening = str(int.from_bytes(text.encode()[:4], "little"))
    rows = [
        (str(number), record(device=number), TOPIC),
        (None, record(device=number), "devices/loadtest-device-00379/messages/events/"),
        (str(number), record(device=number, millis=-1000), TOPIC),
        ("7", record(device=number), "devices/loadtest-device-00379/messages/events/"),
        (None, record(device=number), "devices/other/messages/events/"),
        (opening, text, TOPIC),
    ]
    out = decoded(spark, rows)
    known = [at("2024-01-01"), at("2024-01-01"), at("1969-12-31 23:59:59"), None, None, at("2024-01-01")]
    assert [r.event_timestamp for r in out] == known
    assert [out[0][name] for name in SENSORS] == [float(i) for i in range(22)]
    assert [r.device_id for r in out] == [number, number, number, 7, None, 1]


def test_such_records_pass_every_stage(spark):
    number = 0x017B
    out = parse.decode(messages(spark, [(str(number), record(device=number), TOPIC), ("1", "{bad}", TOPIC)]))
    assert [r.offset for r in parse.accepted(out).collect()] == [0]
    assert [r.offset for r in parse.quarantine(out).collect()] == [1]
    assert [r.rows for r in parse.funnel(out).orderBy("step").collect()] == [2, 2, 2, 1, 1]
    stored = parse.accepted(out).select(
        *[payload.variant_double(F.col("document"), name).alias(name) for name in SENSORS]
    )
    assert [list(r) for r in stored.collect()] == [[float(i) for i in range(22)]]


def test_no_binary_record_in_a_batch(spark):
    values = messages(spark, [("1", "{}", TOPIC)] * 3).select(payload.decode_binary(F.col("value")).alias("r"))
    assert [r.r for r in values.collect()] == [None] * 3


def test_payload_is_decoded_once(spark):
    plan = parse.parse(messages(spark, [("1", "{}", TOPIC)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("from_json(") == 1


def test_frames(spark):
    import base64

    body = base64.b64encode(bytes([0x7E, 0x83, 0x00, 0, 0, 0, 0x2C, 0x01])).decode()
    bad = base64.b64encode(bytes([0x7E, 0x03, 0x10, 0, 0, 0, 0xFF, 0xFF])).decode()
    short = base64.b64encode(bytes([0x7E])).decode()
    rows = spark.createDataFrame([(0, body), (1, bad), (2, short)], "i int, p string").orderBy("i")
    p = F.col("p")
    out = rows.select(frames.message_type(p), frames.message_id(p), frames.status(p)).collect()
    assert [tuple(r) for r in out] == [(3, 300, "OK"), (3, 65535, "NG"), (None, None, "NG")]
