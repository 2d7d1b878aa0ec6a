from __future__ import annotations

import itertools
import math

import pytest
from conftest import at
from pyspark.sql import functions as F

from coldtrace.functions import rules as R
from coldtrace.schemas import SENSORS

VALUES = [1.0, 2.0, 3.0, None, math.nan]
OPERATORS = [">", ">=", "<", "<=", "==", "!=", "<>", None]


def expected(operator, value, item):
    if item is None or not 1 <= item <= 22 or operator not in R.COMPARISONS:
        return False
    if value is None:
        return None
    # NaN is above every number.
    number = math.inf if math.isnan(value) else value
    return {
        ">": number > 2, ">=": number >= 2, "<": number < 2, "<=": number <= 2,
        "==": number == 2, "!=": number != 2,
    }[operator]


def test_threshold_table(spark):
    cases = list(itertools.product(OPERATORS, VALUES, [1, 22, 0, 23, None]))
    frame = spark.createDataFrame(cases, "op string, value double, item int").withColumn(
        "exceeded",
        R.threshold_exceeded(F.col("value"), F.col("item"), F.col("op"), F.lit(2.0)),
    )
    for row in frame.collect():
        assert row.exceeded is expected(row.op, row.value, row.item), row


def test_sensor_value(spark):
    values = {name: float(k) for k, name in enumerate(SENSORS, start=1)}
    items = [None, 0, *range(1, 23), 23]
    frame = spark.createDataFrame([(i, *values.values()) for i in items], ["item", *values])
    frame = frame.withColumn("item", F.col("item").cast("int"))
    got = [r[0] for r in frame.select(R.sensor_value("item")).collect()]
    assert got == [None, None, *[float(k) for k in range(1, 23)], None]


@pytest.mark.parametrize(
    "start, event, minutes, fired, triggered",
    [
        ("2024-01-01 00:00:00", "2024-01-01 00:01:00", 1, None, True),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 1, None, False),
        # 59.1 seconds that cross a whole second count as 60.
        ("2024-01-01 00:00:00.900000", "2024-01-01 00:01:00", 1, None, True),
        ("2024-01-01 00:00:00", "2024-01-01 00:01:00", 1, "2024-01-01 00:00:30", False),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:00", 0, None, True),
        (None, "2024-01-01 00:01:00", 0, None, False),
    ],
)
def test_triggered(spark, start, event, minutes, fired, triggered):
    schema = "exceeded boolean, event timestamp, start timestamp, minutes int, fired timestamp"
    moments = [None if t is None else at(t) for t in (event, start, fired)]
    rows = [(x, moments[0], moments[1], minutes, moments[2]) for x in (True, False, None)]
    frame = spark.createDataFrame(rows, schema)
    got = frame.select(
        R.alert_triggered(*[F.col(c) for c in ("exceeded", "event", "start", "minutes", "fired")])
    ).collect()
    assert got[0][0] is triggered
    assert got[1][0] is False
    assert got[2][0] in (None, False)


def test_update_pattern_and_mail(spark):
    flags = [True, False, None]
    frame = spark.createDataFrame(list(itertools.product(flags, flags)), "a boolean, b boolean")
    for row in frame.select(
        "a", "b", R.update_pattern(F.col("a"), F.col("b")).alias("p"),
        R.should_enqueue_email(F.col("a"), F.col("b")).alias("m"),
    ).collect():
        assert row.p == (R.RECOVERY if not row.a else R.ALERT_FIRED if row.b else R.ABNORMAL_START)
        assert row.m is (row.a is True and row.b is True)


def test_history_keys_are_repeatable(spark):
    frame = spark.range(3).select(
        R.history_id(F.lit(1), F.col("id").cast("int"), F.lit(at("2024-01-01"))).alias("i"),
        R.history_uuid(F.lit(1), F.col("id").cast("int"), F.lit(at("2024-01-01"))).alias("u"),
    )
    first, again = frame.collect(), frame.collect()
    assert first == again and len({r.i for r in first}) == 3
    assert all([len(p) for p in r.u.split("-")] == [8, 4, 4, 4, 12] for r in first)
