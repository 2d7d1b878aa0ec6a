"""Streams whose state is Spark's: episodes, correlation, minute windows, redelivery."""

from __future__ import annotations

import glob
import os
import random
import re
from collections import Counter
from datetime import timedelta

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_streaming import clock, land, make_masters, run_stream

from coldtrace.operators import alerts, correlate, replay
from coldtrace.schemas import SENSORS
from coldtrace.streaming.correlation import CorrelationStream
from coldtrace.streaming.episodes import Episode, EpisodeStream, _output
from coldtrace.streaming.minutes import MinuteStream
from coldtrace.streaming.pipeline import Pipeline, SinkError
from coldtrace.streaming.tables import DatedTable, KeyedTable

BEGIN = at("2024-01-01")
SENSOR_TYPES = ", ".join(f"{name} double" for name in SENSORS)
READING = f"event_id long, device_id int, event_timestamp timestamp, {SENSOR_TYPES}"
MESSAGE = "client string, msg_type int, msg_id int, at timestamp, is_response boolean, seq long"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def readings(spark, rows):
    """Rows of (event id, device, minute, first sensor)."""
    empty = [None] * (len(SENSORS) - 1)
    made = [(n, device, BEGIN + timedelta(minutes=minute), value, *empty) for n, device, minute, value in rows]
    return spark.createDataFrame(made, READING)


def land_once(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def closing(spark, minute=10**6):
    return readings(spark, [(-1, 1, minute, None)])


def episode_stream(spark, root, **options):
    stream = EpisodeStream(spark, f"{root}/tables", make_masters(spark).alert_settings, **options)

    def run(path="landing", checkpoint="checkpoint"):
        rows = stream_of(spark, f"{root}/{path}", READING)
        stream.start(rows, f"{root}/{checkpoint}", interval=None).awaitTermination()

    return stream, run


def test_episodes_over_restarts_in_any_order_of_arrival(spark, root):
    draw = random.Random(2)
    rows = [(n, 1, n // 2, draw.choice([9.0, 9.0, 9.0, 1.0, None])) for n in range(240)]
    arrival = sorted(rows, key=lambda r: r[2] + draw.uniform(0, 8))
    stream, run = episode_stream(spark, root, lateness="10 minutes")
    for part in (arrival[:70], arrival[70:170], arrival[170:]):
        land_once(readings(spark, part), f"{root}/landing")
        run()
    before = stream.history().count()
    land_once(closing(spark), f"{root}/landing")
    run()
    rules = alerts.active_rules(make_masters(spark).alert_settings())
    expected = replay.replay(alerts.evaluate(readings(spark, rows), rules, how="inner"))
    assert rows_of(stream.history()) == rows_of(expected)
    assert 0 < before <= expected.count()


def test_rows_behind_the_watermark_change_nothing(spark, root):
    stream, run = episode_stream(spark, root, lateness="1 minute")
    land_once(readings(spark, [(0, 1, 0, 9.0), (1, 1, 30, 9.0)]), f"{root}/landing")
    run()
    land_once(readings(spark, [(2, 1, 10, 1.0), (3, 1, 40, 1.0)]), f"{root}/landing")
    run()
    land_once(closing(spark), f"{root}/landing")
    run()
    (found,) = stream.history().collect()
    assert found.abnormal_start_time == BEGIN and found.recovered_event_time == BEGIN + timedelta(minutes=40)


def test_silent_devices_are_told_and_given_up(spark, root):
    stream, run = episode_stream(spark, root, silence=timedelta(hours=1))
    land_once(readings(spark, [(0, 1, 0, 1.0), (1, 1, 5, 1.0)]), f"{root}/landing")
    land_once(closing(spark, 300), f"{root}/landing")
    run()
    assert [(r.alert_id, r.last_event_time, r.abnormal_start_time) for r in stream.silent().collect()] == [
        (10, BEGIN + timedelta(minutes=5), None)
    ]
    state = spark.read.format("statestore").option("stateVarName", "episode").load(f"{root}/checkpoint")
    assert state.count() == 0
    # A silent device in an episode is told with its start, and its state stays for the recovery.
    land_once(readings(spark, [(2, 1, 310, 9.0), (3, 1, 320, 9.0)]), f"{root}/landing")
    land_once(closing(spark, 600), f"{root}/landing")
    run()
    silent = {r.last_event_time: r.abnormal_start_time for r in stream.silent().collect()}
    assert silent[BEGIN + timedelta(minutes=320)] == BEGIN + timedelta(minutes=310)
    land_once(readings(spark, [(4, 1, 610, 1.0)]), f"{root}/landing")
    land_once(closing(spark), f"{root}/landing")
    run()
    (found,) = stream.history().collect()
    assert found.recovered_event_time == BEGIN + timedelta(minutes=610)


def test_a_new_checkpoint_goes_on_with_the_state(spark, root):
    stream, run = episode_stream(spark, root, silence=None)
    land_once(readings(spark, [(0, 1, 0, 9.0), (1, 1, 9, 9.0), (2, 1, 60, 9.0)]), f"{root}/landing")
    run()
    assert stream.history().filter("recovered_event_time IS NULL").count() == 1
    land_once(readings(spark, [(3, 1, 70, 1.0)]), f"{root}/later")
    land_once(closing(spark), f"{root}/later")
    run("later", "checkpoint-2")
    (found,) = stream.history().collect()
    assert (found.abnormal_start_time, found.fired_event_time, found.recovered_event_time) == tuple(
        BEGIN + timedelta(minutes=m) for m in (0, 9, 70)
    )


def test_a_fired_episode_stays_fired_when_its_rule_gets_longer():
    episode = Episode()
    event = lambda minute, normal, minutes: {
        "at": minute * 60_000_000, "normal": normal, "value": 1.0, "minutes": minutes,
    }
    steps = [(0, False, 5), (5, False, 5), (6, False, 50), (7, True, 50), (8, True, 5)]
    assert [f and f[0] for f in (episode.judge(event(*s)) for s in steps)] == [None, "fired", None, "recovered", None]


# -- correlation ---------------------------------------------------------------------------------


def test_correlation_over_restarts(spark, root):
    draw = random.Random(5)
    rows = [
        (f"c{draw.randrange(3)}", 0, draw.randrange(2), BEGIN + timedelta(seconds=n * 2 + draw.random()), draw.random() < 0.5, n)
        for n in range(150)
    ]
    rows += [(None, 0, 0, BEGIN, False, 900), (None, 0, 0, BEGIN + timedelta(seconds=3), True, 901)]
    expected = correlate.correlate(spark.createDataFrame(rows, MESSAGE))
    stream = CorrelationStream(spark, f"{root}/tables", lateness="20 seconds")
    late = ("c0", 0, 0, BEGIN, True, 999)
    end = ("end", 0, 0, BEGIN + timedelta(days=1), False, 0)
    order = sorted(rows, key=lambda r: r[3] + timedelta(seconds=draw.uniform(0, 10)))
    for part in (order[:80], [*order[80:], late], [end]):
        land_once(spark.createDataFrame(part, MESSAGE), f"{root}/landing")
        sides = [stream_of(spark, f"{root}/landing", MESSAGE) for _ in range(2)]
        stream.start(*sides, f"{root}/checkpoint", interval=None).awaitTermination()
    found = stream.results.read(spark).drop("epoch", "batch_id")
    assert rows_of(found) == rows_of(expected)
    assert {r.result for r in found.collect()} == {"Success", "Failure", "Timeout"}


def test_correlation_forms_no_pairs(spark, root):
    """30,000 messages of one key inside the wait: 450 million pairs for a join on the range of time."""
    rows = spark.range(30_000).select(
        F.lit("c0").alias("client"), F.lit(0).alias("msg_type"), F.lit(0).alias("msg_id"),
        F.timestamp_micros(F.unix_micros(F.lit(BEGIN)) + F.col("id") * 400).alias("at"),
        (F.xxhash64("id") % 2 == 0).alias("is_response"), "id",
    ).withColumnRenamed("id", "seq")
    end = spark.createDataFrame([("end", 0, 0, BEGIN + timedelta(days=1), False, 0)], MESSAGE)
    for part in (rows, end):
        land_once(part, f"{root}/landing")
    stream = CorrelationStream(spark, f"{root}/tables")
    sides = [stream_of(spark, f"{root}/landing", MESSAGE) for _ in range(2)]
    query = stream.start(*sides, f"{root}/checkpoint", interval=None)
    query.awaitTermination()
    assert rows_of(stream.results.read(spark).drop("epoch", "batch_id")) == rows_of(correlate.correlate(rows))
    joins = [o for p in query.recentProgress for o in p["stateOperators"] if "Join" in o["operatorName"]]
    assert not joins


# -- minutes -------------------------------------------------------------------------------------


def test_minutes_are_written_once_and_late_rows_apart(spark, root):
    schema = "event_id long, device_id int, event_timestamp timestamp"
    parts = [
        [(1, 1, "00:00:10"), (2, 2, "00:30:00"), (3, 2, "00:30:05"), (3, 2, "00:30:05")],
        [(4, 3, "00:29:20"), (5, 1, "00:45:00"), (2, 2, "00:30:00")],
        [(6, 3, "00:00:20"), (7, 1, "00:40:00"), (8, 9, "01:30:00")],
        [(9, 9, "05:00:00")],
    ]
    stream = MinuteStream(spark, f"{root}/tables", lateness="10 minutes")
    for part in parts:
        rows = [(n, d, at(f"2024-01-01 {t}")) for n, d, t in part]
        land_once(spark.createDataFrame(rows, schema), f"{root}/landing")
        rows = stream_of(spark, f"{root}/landing", schema)
        stream.start(rows, f"{root}/checkpoint", interval=None).awaitTermination()
    found = Counter((f"{r.minute:%H:%M}", r.records, r.devices) for r in stream.series().collect())
    assert found == Counter(
        [("00:00", 1, 1), ("00:30", 2, 1), ("00:29", 1, 1), ("00:45", 1, 1), ("00:40", 1, 1), ("01:30", 1, 1)]
    )
    assert {(r.event_id, r.times) for r in stream.left_out().collect()} == {(3, 1), (2, 1), (6, 1)}


# -- redelivery and counts -----------------------------------------------------------------------


def test_redelivered_messages_are_stored_once(spark, root):
    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark), clock=clock)
    land(spark, f"{root}/landing", [(1, 0, 9.0), (2, 0, 9.0)], first=0)
    run_stream(pipeline, root)
    # Again after a restart, and beside it a new message at another place.
    land(spark, f"{root}/landing", [(1, 0, 9.0), (2, 0, 9.0), (2, 3, 9.0)], first=0)
    run_stream(pipeline, root)
    assert pipeline.silver.read(spark).count() == 3
    as_they_come = Pipeline(spark, f"{root}/all", make_masters(spark), redelivery=None)
    raw = spark.readStream.schema(spark.read.parquet(f"{root}/landing").schema).parquet(f"{root}/landing")
    assert as_they_come.once(raw) is raw


def test_counts_are_taken_while_sinks_write(spark, root):
    def broken(rows, batch):
        raise OSError("store is down")

    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark), clock=clock, strict=False, extra_sinks={"outside": broken})
    land(spark, f"{root}/landing", [(1, 0, 9.0), (2, 0, 9.0), (4, 0, 9.0)])
    raw = spark.read.parquet(f"{root}/landing")
    bad = raw.limit(1).withColumns({"value": F.lit(b"{bad}"), "offset": F.lit(99).cast("long")})
    report = {r.sink: r for r in pipeline.run_once(raw.unionByName(bad)).collect()}
    assert report["quarantine"].metrics == {"raw": 4, "device_id": 4, "json_text": 4, "payload": 3, "event_time": 3}
    assert report["silver"].metrics == {"rows": 2} and report["alert_evaluation"].metrics == {"rows": 2}
    assert report["outside"].metrics is None
    assert [tuple(r) for r in pipeline.funnel().orderBy("step").collect()] == [
        (0, "raw", 4), (1, "device_id", 4), (2, "json_text", 4), (3, "payload", 3), (4, "event_time", 3),
    ]
    with pytest.raises(SinkError):
        Pipeline(spark, f"{root}/strict", make_masters(spark), clock=clock, extra_sinks={"outside": broken}).run_once(raw)


# -- tables --------------------------------------------------------------------------------------


def test_only_buckets_that_are_asked_for_are_read(spark, root):
    table = KeyedTable(f"{root}/t", StructType.fromDDL("k int, v int"), ("k",), fold_every=2, buckets=16)
    rows = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v"))
    table.begin(spark, 0, 0, seed=rows)
    table.write(spark.createDataFrame([(3, 1), (500, 1)], "k int, v int"), 0, 0)
    wanted = spark.createDataFrame([(3,), (4,), (500,)], "k int")
    found = table.before(spark, 0, 1, wanted)
    assert rows_of(found) == [(3, 1), (4, 0), (500, 1)]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
    buckets = {r.b for r in wanted.select(table._bucket().alias("b")).collect()}
    assert len(buckets) < 16
    # Files of other buckets may hold anything.
    for file in glob.glob(f"{root}/t/epoch=0/generation=0/full/bucket=*/*.parquet"):
        if int(re.search(r"bucket=(\d+)", file)[1]) not in buckets:
            with open(file, "wb") as broken:
                broken.write(b"no table")
    assert rows_of(table.before(spark, 0, 1, wanted)) == [(3, 1), (4, 0), (500, 1)]
    table.write(spark.createDataFrame([(3, 2)], "k int, v int"), 0, 1)
    assert rows_of(table.before(spark, 0, 1, wanted)) == [(3, 1), (4, 0), (500, 1)]


def test_finished_dates_are_rewritten_and_read_once(spark, root):
    table = DatedTable(f"{root}/silver", "event_date")

    def rows(*values):
        made = [(v, at(f"2024-01-0{v % 3 + 1}").date()) for v in values]
        return spark.createDataFrame(made, "v int, event_date date")

    def held():
        return sorted(r.v for r in table.read(spark).collect())

    assert table.read(spark) is None
    table.compact(spark, at("2024-02-01").date())
    for batch in range(4):
        table.write(rows(*range(batch * 10, batch * 10 + 10)), 0, batch)
    table.compact(spark, at("2024-01-03").date())
    assert held() == list(range(40))
    packed = spark.read.parquet(f"{root}/silver_packed/run=0")
    assert packed.select("event_date").distinct().count() == 2 and len(packed.inputFiles()) == 2
    # Rows that come later, also in a new epoch, and a run that finds nothing new.
    table.write(rows(100, 101, 102), 0, 4)
    table.write(rows(200), 1, 0)
    assert held() == [*range(40), 100, 101, 102, 200]
    table.compact(spark, at("2024-01-03").date())
    table.compact(spark, at("2024-01-03").date())
    assert held() == [*range(40), 100, 101, 102, 200]
    assert not os.path.exists(f"{root}/silver_packed/run=2")


def test_a_key_without_a_finding_hands_over_no_frame():
    assert list(_output((1, 10), [])) == []
    frame, = _output((1, 10), [("fired", 1, 2, 0.5), ("silent", None, 3, None)])
    assert frame["kind"].tolist() == ["fired", "silent"] and frame["start"].tolist() == [1, None]
    assert frame["value"].isna().tolist() == [False, True]
