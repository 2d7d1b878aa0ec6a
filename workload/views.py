"""The engine's input tables derived from the test tables.

Each view is a narrow projection of `events`, `customer`, `nation` or `supplier`. `workload.oracle`
states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtrace.functions.payload import BINARY_RECORD, iso_text
from coldtrace.plans import catchup
from coldtrace.schemas import SENSORS
from coldtrace.sources.generator import device_name

# Declared, so that opening a table takes no look at its files.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
}
STATE_START = "2024-01-15 00:00:00"
STATE_FIRED = "2024-01-15 12:00:00"
BATCH_TIME = "2024-02-01 00:00:00"
AS_OF = "2024-01-25 12:00:00"
POLL_PARTITIONS = 16
OUTAGE_FROM, OUTAGE_TO = "2024-01-10 00:00:00", "2024-01-10 12:00:00"


@F.arrow_udf(T.BinaryType())
def _pack(device: pa.Array, micros: pa.Array, *sensors: pa.Array) -> pa.Array:
    records = np.zeros(len(device), dtype=BINARY_RECORD)
    records["device_id"] = device.to_numpy(zero_copy_only=False)
    records["event_time"] = micros.to_numpy(zero_copy_only=False)
    for name, column in zip(SENSORS, sensors):
        records[name] = column.to_numpy(zero_copy_only=False)
    # All records lie in one buffer, one after the other.
    offsets = np.arange(len(records) + 1, dtype=np.int32) * BINARY_RECORD.itemsize
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(records), [None, pa.py_buffer(offsets), pa.py_buffer(records)]
    )


def week_of(time: str):
    """Weeks since the first day of the tables."""
    return F.floor(F.datediff(F.col(time), F.lit("2024-01-01").cast("date")) / 7).cast("int")


def plain_times(frame: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables store them."""
    return frame.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in frame.schema
        ]
    )


class Views:
    """Lazy views over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").withColumn("ts", F.col("ts").cast("timestamp"))

    @cached_property
    def telemetry(self) -> DataFrame:
        return self.telemetry_of(self.events)

    def telemetry_of(self, events: DataFrame) -> DataFrame:
        sensors = [
            f"CASE WHEN event_id % 11 = {k % 11} THEN NULL ELSE value + {k * 0.5}D END AS {name}"
            for k, name in enumerate(SENSORS, start=1)
        ]
        return events.selectExpr(
            "event_id", "CAST(user_id AS INT) AS device_id", "ts AS event_timestamp", *sensors
        )

    @cached_property
    def device_master(self) -> DataFrame:
        return self.table("customer").filter(F.col("c_custkey") % 17 != 3).select(
            F.col("c_custkey").cast("int").alias("device_id"),
            F.col("c_name").alias("device_name"),
            F.col("c_nationkey").cast("int").alias("organization_id"),
        )

    @cached_property
    def organization_master(self) -> DataFrame:
        return self.table("nation").filter(F.col("n_regionkey") != 4).select(
            F.col("n_nationkey").cast("int").alias("organization_id"),
            F.col("n_name").alias("organization_name"),
        )

    @cached_property
    def alert_setting(self) -> DataFrame:
        key, r = F.col("c_custkey"), F.col("r")
        turn = (key + r) % 7
        operator = F.lit("<>")
        for number, symbol in enumerate([">", ">=", "<", "<=", "==", "!="]):
            operator = F.when(turn == number, symbol).otherwise(operator)
        return (
            self.table("customer")
            .filter(key % 3 != 0)
            .select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("r"))
            .select(
                key.cast("int").alias("device_id"),
                (key * 10 + r).cast("int").alias("alert_id"),
                F.concat(F.lit("rule-"), (key * 10 + r).cast("string")).alias("alert_name"),
                (1 + (key * 7 + r * 5) % 22).cast("int").alias("alert_conditions_measurement_item_id"),
                operator.alias("alert_conditions_operator"),
                (20 + 10 * ((key + r) % 5)).cast("double").alias("alert_conditions_threshold"),
                (600 * r).cast("int").alias("judgment_time"),
                (1 + key % 3).cast("int").alias("alert_level_id"),
                (key % 2 == 0).alias("alert_email_flag"),
                (key % 13 == 5).alias("delete_flag"),
            )
        )

    @cached_property
    def mail_setting(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.col("s_nationkey").cast("int").alias("organization_id"),
            F.concat(F.lit("u"), key.cast("string"), F.lit("@example.test")).alias("email_address"),
            (key % 2 == 0).alias("is_active"),
        )

    @cached_property
    def measurement_item(self) -> DataFrame:
        number = F.col("id").cast("int")
        return self.spark.range(1, 22).select(
            number.alias("measurement_item_id"),
            F.concat(F.lit("item-"), number.cast("string")).alias("measurement_item_name"),
        )

    @cached_property
    def state0(self) -> DataFrame:
        alert = F.col("alert_id")
        start, fired = F.lit(STATE_START).cast("timestamp"), F.lit(STATE_FIRED).cast("timestamp")
        return self.alert_setting.filter(alert % 4 != 3).select(
            "device_id",
            "alert_id",
            F.when(alert % 4 != 0, start).alias("abnormal_start_time"),
            F.lit(None).cast("timestamp").alias("last_event_time"),
            F.lit(None).cast("double").alias("last_sensor_value"),
            F.when(alert % 4 == 2, fired).alias("alert_fired_time"),
            F.when(alert % 4 == 2, alert + 1000).cast("long").alias("alert_history_id"),
            start.alias("create_time"),
            start.alias("update_time"),
        )

    @cached_property
    def raw_messages(self) -> DataFrame:
        """Broker messages of the telemetry: every kind of broken payload, and binary records."""
        return self.messages_of(self.events)

    def messages_of(self, events: DataFrame) -> DataFrame:
        """Those of some events. A filter on messages stands above their making, one on events below."""
        event, device = F.col("event_id"), F.col("device_id")
        no_device = (event % 83 == 0) & (event % 89 != 0) & (event % 97 != 0)
        time_text = F.when(event % 79 == 0, "not-a-time").otherwise(iso_text(F.col("event_timestamp")))
        text = F.to_json(
            F.struct(
                F.when(~no_device, device).alias("device_id"),
                time_text.alias("event_timestamp"),
                *SENSORS,
            )
        )
        broken = (event % 97 == 0) | (event % 89 == 0) | (event % 83 == 0) | (event % 79 == 0)
        # Not deterministic as far as the optimizer knows, so that the payload is made once.
        packed = _pack.asNondeterministic()(
            device,
            F.unix_micros("event_timestamp"),
            *[F.expr(f"coalesce({name}, 0.0D)") for name in SENSORS],
        )
        value = (
            F.when(event % 97 == 0, F.lit("{bad}").cast("binary"))
            .when(event % 89 == 0, F.lit("plain text").cast("binary"))
            .when((event % 73 == 0) & ~broken, packed)
            .otherwise(text.cast("binary"))
        )
        topic = F.concat(F.lit("devices/"), device_name(device), F.lit("/messages/events/"))
        return self.telemetry_of(events).select(
            F.when(~no_device, device.cast("string").cast("binary")).alias("key"),
            value.alias("value"),
            F.when(no_device, "devices/unknown/messages/events/").otherwise(topic).alias("topic"),
            (device % POLL_PARTITIONS).cast("int").alias("partition"),
            event.alias("offset"),
            (
                F.col("event_timestamp")
                + F.make_dt_interval(secs=(event % 40).cast("decimal(18,6)"))
            ).alias("timestamp"),
        )

    @cached_property
    def odd_messages(self) -> DataFrame:
        """JSON messages whose device id is right, null, a text, missing, or beside a NaN; nested, an
        object, an array, beside a text that looks like NaN, or twice; and fields that repeat."""
        device = F.col("device_id").cast("string")
        kind = F.col("event_id") % 12
        right = F.concat(F.lit('"device_id":'), device, F.lit(","))
        field = (
            F.when(kind == 1, '"device_id":null,')
            .when(kind == 2, '"device_id" : "a\\"b,}",')
            .when(kind == 3, "")
            .when(kind == 5, '"meta":{"device_id":3},')
            .when(kind == 6, '"device_id":{"a":1},')
            .when(kind == 7, '"device_id":[1,2],')
            .when(kind == 8, F.concat(right, F.lit('"note":"t: NaN, x",')))
            .when(kind == 9, F.concat(right, F.lit('"device_id":"x",')))
            .when(kind == 10, F.concat(right, F.lit('"meta":{"x":1,"x":2},')))
            .when(kind == 11, F.concat(right, F.lit('"external_temp":-1.5,')))
            .otherwise(right)
        )
        temperature = F.when(kind == 4, "NaN").otherwise(F.coalesce(F.col("external_temp").cast("string"), F.lit("null")))
        text = F.concat(
            F.lit("{"), field, F.lit('"event_timestamp":"'), iso_text(F.col("event_timestamp")),
            F.lit('","external_temp":'), temperature, F.lit("}"),
        )
        return self.telemetry.select(
            device.cast("binary").alias("key"),
            text.cast("binary").alias("value"),
            F.lit("devices/unknown/messages/events/").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("event_timestamp").alias("timestamp"),
        )

    @cached_property
    def stored(self) -> DataFrame:
        """Telemetry with the time it was stored: the message's arrival."""
        arrival = F.make_dt_interval(secs=(F.col("event_id") % 40).cast("decimal(18,6)"))
        return self.telemetry.withColumn("create_time", F.col("event_timestamp") + arrival)

    @cached_property
    def mirror(self) -> DataFrame:
        """The second store: some rows missing, some that the first one does not have."""
        event = F.col("event_id")
        return self.telemetry.filter(event % 101 != 0).select(
            F.when(event % 103 == 0, event + 1_000_000_000).otherwise(event).alias("event_id"),
            "device_id",
        )

    @cached_property
    def readings(self) -> DataFrame:
        """One sensor of the first store."""
        return self.telemetry.select("event_id", "device_id", "external_temp")

    @cached_property
    def altered(self) -> DataFrame:
        """The second store with that sensor, which differs in some of its rows."""
        event = F.col("event_id")
        changed = F.when(event % 107 == 0, F.lit(-1.0)).otherwise(F.col("external_temp"))
        return self.readings.filter(event % 101 != 0).select(
            F.when(event % 103 == 0, event + 1_000_000_000).otherwise(event).alias("event_id"),
            "device_id",
            changed.alias("external_temp"),
        )

    @cached_property
    def hourly_flow(self) -> DataFrame:
        """Arrivals per partition and hour, and what can be handled: twice the average rounded up,
        nothing on the morning of the tenth."""
        part = (F.col("user_id") % POLL_PARTITIONS).cast("int")
        flow = catchup.slots(self.events, part, "ts")
        means = flow.groupBy("part").agg(F.ceil(2 * F.avg("arrived")).alias("able"))
        outage = (F.col("slot") >= OUTAGE_FROM) & (F.col("slot") < OUTAGE_TO)
        return flow.join(means, "part").select(
            "part", "slot", "arrived", F.when(outage, 0).otherwise(F.col("able")).cast("long").alias("capacity")
        )

    @cached_property
    def requests(self) -> DataFrame:
        return self.events.select(
            F.col("event_type").alias("type"),
            F.concat(F.lit("name-"), F.col("user_id") % 3).alias("name"),
            F.floor(F.col("value") * 10).cast("double").alias("response_time"),
            F.length("props").cast("double").alias("response_length"),
            F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), "error").alias(
                "exception"
            ),
            F.col("ts").alias("at"),
        )

    @cached_property
    def raised(self) -> DataFrame:
        """Exceptions with the node they were raised on."""
        return self.events.filter(F.col("event_type") == "error").select(
            F.concat(F.lit("message-"), F.col("event_id") % 5).alias("message"),
            F.concat(F.lit("line-"), F.col("event_id") % 3).alias("traceback"),
            F.concat(F.lit("node-"), F.col("user_id") % 4).alias("node"),
        )

    @cached_property
    def polls(self) -> DataFrame:
        """Last sequence number per partition at the end of each hour; partition 3 is reset once a day."""
        hour = F.date_trunc("hour", "ts")
        last = self.events.groupBy(
            (F.col("user_id") % POLL_PARTITIONS).cast("int").alias("partition"), hour.alias("poll_time")
        ).agg(F.max("event_id").alias("last_sequence"))
        reset = (F.col("partition") == 3) & (F.hour("poll_time") == 0)
        return last.withColumn(
            "last_sequence", F.when(reset, F.lit(0)).otherwise(F.col("last_sequence")).cast("long")
        )

    @cached_property
    def minutes(self) -> DataFrame:
        """Records per run (week) and minute slot of it, a slot being six hours of the tables."""
        week = week_of("ts")
        slot = F.floor(
            (F.unix_seconds("ts") - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))) / 21600
        ).cast("int")
        minute = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=F.col("slot"))
        return (
            self.events.select(week.alias("run"), slot.alias("slot"), "event_type")
            .groupBy("run", "slot")
            .agg(F.count("*").alias("records"))
            .select("run", minute.alias("minute"), "records")
        )

    @cached_property
    def runs(self) -> DataFrame:
        """A few figures per run (week)."""
        week = week_of("ts")
        return self.events.groupBy(week.alias("run")).agg(
            F.count("*").cast("double").alias("sent"),
            F.countDistinct("user_id").cast("double").alias("devices"),
            F.count_if(F.col("event_type") == "error").cast("double").alias("errors"),
        )

    @cached_property
    def frames(self) -> DataFrame:
        """Message frames in base64: byte 1 type with its top bit set for responses, byte 2 status,
        bytes 6 and 7 the message id."""
        event = F.col("event_id")

        def two(column):
            return F.lpad(F.hex(column), 2, "0")

        ident = event % 300
        kind = event % 5
        response = F.col("event_type").isin("view", "purchase")
        digits = F.concat(
            F.lit("7E"),
            two(kind + F.when(response, 128).otherwise(0)),
            F.when(event % 6 == 0, "01").otherwise("00"),
            F.lit("000000"),
            two(ident % 256),
            two(F.floor(ident / 256)),
        )
        return self.events.select(
            "event_id",
            F.base64(F.unhex(digits)).alias("payload"),
            response.alias("is_response"),
            F.col("ts").alias("at"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Requests and their responses `value / 3` seconds later; every seventh is missing.

        Clicks, views and purchases are requests, all other events stray responses. Message ids repeat often, so that requests overtake each other.
        """
        value, event = F.col("value"), F.col("event_id")
        key = [
            F.concat(F.lit("c"), F.col("user_id") % 20).alias("client"),
            (event % 3).cast("int").alias("msg_type"),
            (event % 4).cast("int").alias("msg_id"),
        ]
        # Squeeze the month into half a day, so that neighbours come within the wait.
        start = F.lit("2024-01-01").cast("timestamp")
        micros = F.floor((F.unix_micros("ts") - F.unix_micros(start)) / 60)
        at = F.timestamp_micros(F.unix_micros(start) + micros)
        later = F.timestamp_micros(F.unix_micros(start) + micros + F.floor(value * 1_000_000 / 3))
        click = F.col("event_type").isin("click", "view", "purchase")
        requests = self.events.filter(click).select(
            *key, at.alias("at"), F.lit(False).alias("is_response"), event.alias("seq")
        )
        responses = self.events.filter(click & (event % 7 != 0)).select(
            *key, later.alias("at"), F.lit(True).alias("is_response"), event.alias("seq")
        )
        stray = self.events.filter(~click).select(
            *key, at.alias("at"), F.lit(True).alias("is_response"), event.alias("seq")
        )
        return requests.unionAll(responses).unionAll(stray)
