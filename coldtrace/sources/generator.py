"""Generated devices and telemetry, repeatable for a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtrace.functions.draws import Draws
from coldtrace.functions.payload import iso_text
from coldtrace.schemas import SENSORS

# Device names, message size, and the range of every sensor. A `base` makes the
# draw an offset from the set temperature of that freezer.
NAME_PREFIX = "loadtest-device-"
MESSAGE_BYTES = 1024
PADDING_FRAME = ',"_padding":""'
HEATER_ON = 0.05
RANGES = {
    "external_temp": (-10.0, 40.0, None),
    "set_temp_freezer_1": (-22.0, -18.0, None),
    "internal_sensor_temp_freezer_1": (-0.5, 0.5, "set_temp_freezer_1"),
    "internal_temp_freezer_1": (-0.8, 0.8, "set_temp_freezer_1"),
    "df_temp_freezer_1": (3.0, 6.0, "set_temp_freezer_1"),
    "condensing_temp_freezer_1": (30.0, 45.0, None),
    "adjusted_internal_temp_freezer_1": (-0.5, 0.5, "set_temp_freezer_1"),
    "set_temp_freezer_2": (-27.0, -23.0, None),
    "internal_sensor_temp_freezer_2": (-0.5, 0.5, "set_temp_freezer_2"),
    "internal_temp_freezer_2": (-0.8, 0.8, "set_temp_freezer_2"),
    "df_temp_freezer_2": (3.0, 6.0, "set_temp_freezer_2"),
    "condensing_temp_freezer_2": (33.0, 48.0, None),
    "adjusted_internal_temp_freezer_2": (-0.5, 0.5, "set_temp_freezer_2"),
    "compressor_freezer_1": (2500.0, 3200.0, None),
    "compressor_freezer_2": (2700.0, 3400.0, None),
    "fan_motor_1": (1100.0, 1300.0, None),
    "fan_motor_2": (1100.0, 1300.0, None),
    "fan_motor_3": (1100.0, 1300.0, None),
    "fan_motor_4": (1100.0, 1300.0, None),
    "fan_motor_5": (1100.0, 1300.0, None),
    "defrost_heater_output_1": (50.0, 150.0, None),
    "defrost_heater_output_2": (50.0, 150.0, None),
}


def device_name(number: Column, width: int = 5) -> Column:
    """Prefix and zero-padded number; a longer number keeps all its digits."""
    text = number.cast("string")
    return F.concat(F.lit(NAME_PREFIX), F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0")))


def devices(
    spark: SparkSession, first: int, last: int, template: DataFrame, now: Column | None = None
) -> DataFrame:
    """Devices `first`..`last` with the columns of a one-row template."""
    now = F.current_timestamp() if now is None else now
    base = template.select(F.struct("*")).scalar()
    return (
        spark.range(first, last + 1)
        .withColumn("base", base)
        .select(
            F.col("id").cast("int").alias("device_id"),
            F.uuid().alias("device_uuid"),
            device_name(F.col("id")).alias("device_name"),
            "base.*",
            F.lit(None).cast("string").alias("mac_address"),
            now.alias("create_date"),
            now.alias("update_date"),
            F.lit(False).alias("delete_flag"),
        )
    )


def with_new_structure(generated: DataFrame) -> DataFrame:
    """Devices in the later table structure: inventory id, and four columns still empty."""
    return (
        generated.withColumnRenamed("device_stock_id", "device_inventory_id")
        .withColumn("sim_id", F.lit(None).cast("string"))
        .withColumn("software_version", F.lit(None).cast("string"))
        .withColumn("device_location", F.lit(None).cast("string"))
        .withColumn("certificate_expiration_date", F.lit(None).cast("timestamp"))
    )


def with_prefix(rows: DataFrame, prefix: str = NAME_PREFIX) -> DataFrame:
    return rows.filter(F.col("device_name").startswith(prefix))


def without_prefix(rows: DataFrame, prefix: str = NAME_PREFIX) -> DataFrame:
    """The dimension after clean-up of the devices with the prefix."""
    return rows.filter(~F.coalesce(F.col("device_name").startswith(prefix), F.lit(False)))


def _readings(draws: Draws) -> dict[str, Column]:
    """Every sensor rounded to 0.1; actual temperatures follow the set temperature drawn before."""
    drawn: dict[str, Column] = {}
    for index, name in enumerate(SENSORS):
        low, high, base = RANGES[name]
        value = draws.uniform(index, low, high)
        if base is not None:
            value = drawn[base] + value
        if name.startswith("defrost_heater"):
            on = draws.unit(len(SENSORS) + index) < HEATER_ON
            value = F.when(on, value).otherwise(0.0)
        drawn[name] = F.round(value, 1)
    return drawn


def telemetry(
    fleet: DataFrame,
    start: Column,
    ticks: int,
    interval_seconds: int = 300,
    spread_seconds: int = 60,
    seed: int = 7,
) -> DataFrame:
    """Readings of every device: `ticks` events, first one spread over `spread_seconds`."""
    # A small file of devices becomes a lot of draws: it is dealt over all tasks first.
    tasks = int(fleet.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = fleet.select("device_id").repartition(tasks).withColumn(
        "tick", F.explode(F.sequence(F.lit(0), F.lit(ticks - 1)))
    )
    draws = Draws(seed, F.col("device_id"), F.col("tick"))
    first = Draws(seed, F.col("device_id"), F.lit("start"))
    seconds = F.floor(first.unit(0) * spread_seconds) + F.col("tick") * interval_seconds
    rows = sent.withColumn("event_timestamp", F.timestamp_seconds(F.unix_seconds(start) + seconds))
    rows = draws.attach(rows, 2 * len(SENSORS))
    drawn = _readings(draws)
    return rows.select("device_id", "tick", "event_timestamp", *[drawn[n].alias(n) for n in SENSORS])


def as_json(rows: DataFrame, size: int = MESSAGE_BYTES) -> Column:
    """Message text of a reading, padded to `size` bytes."""
    text = F.to_json(
        F.struct("device_id", iso_text(F.col("event_timestamp")).alias("event_timestamp"), *SENSORS)
    )
    room = F.lit(size - len(PADDING_FRAME)) - F.octet_length(text)
    padding = F.rpad(F.lit(""), room, F.lit("x"))
    body = F.substr(text, F.lit(1), F.length(text) - 1)
    padded = F.concat(body, F.lit(',"_padding":"'), padding, F.lit('"}'))
    return F.when(room > 0, padded).otherwise(text)


def as_messages(rows: DataFrame, partitions: int = 16) -> DataFrame:
    """Readings as broker messages."""
    device = F.col("device_id")
    topic = F.concat(F.lit("devices/"), device_name(device), F.lit("/messages/events/"))
    return rows.select(
        device.cast("string").cast("binary").alias("key"),
        as_json(rows).cast("binary").alias("value"),
        topic.alias("topic"),
        F.pmod(device, F.lit(partitions)).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
    )


def rate_messages(spark: SparkSession, device_count: int, rows_per_second: int, seed: int = 7) -> DataFrame:
    """An endless stream of generated messages, one device after the other."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    draws = Draws(seed, F.col("value"))
    ticks = draws.attach(ticks, 2 * len(SENSORS))
    drawn = _readings(draws)
    readings = ticks.select(
        (F.col("value") % device_count).cast("int").alias("device_id"),
        F.col("timestamp").alias("event_timestamp"),
        F.col("value").alias("offset"),
        *[drawn[n].alias(n) for n in SENSORS],
    )
    device = F.col("device_id")
    return readings.select(
        device.cast("string").cast("binary").alias("key"),
        as_json(readings).cast("binary").alias("value"),
        F.concat(F.lit("devices/"), device_name(device), F.lit("/messages/events/")).alias("topic"),
        F.pmod(device, F.lit(16)).alias("partition"),
        "offset",
        F.col("event_timestamp").alias("timestamp"),
    )
