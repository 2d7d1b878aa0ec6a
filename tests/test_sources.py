from __future__ import annotations

import json

import pytest
from conftest import at
from pyspark.sql import functions as F

from coldtrace.functions.draws import Draws
from coldtrace.operators import enrich, parse
from coldtrace.schemas import SENSORS
from coldtrace.sources import generator, loadtest, masters, messages


def test_broker_options():
    options = messages.broker_options("host:9093", maxOffsetsPerTrigger="7000")
    assert options["subscribe"] == "eh-telemetry" and options["failOnDataLoss"] == "false"
    assert options["kafka.session.timeout.ms"] == "30000" and options["maxOffsetsPerTrigger"] == "7000"
    with pytest.raises(ValueError):
        messages.broker_batch(None, "host:9093", start="latest")


def test_database_options():
    db = masters.Database("jdbc:mysql://host/db", {"user": "u"})
    assert db.reader_options(dbtable="t") == {"url": "jdbc:mysql://host/db", "user": "u", "dbtable": "t"}


def test_empty_state(spark):
    state = masters.empty_state(spark)
    assert state.count() == 0 and state.columns[-2:] == ["is_abnormal", "alert_fired"]


def fleet(spark, n=20):
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias("device_id"))


def test_a_small_file_of_devices_is_drawn_for_by_all_tasks(spark):
    rows = generator.telemetry(fleet(spark, 200).coalesce(1), F.lit(at("2024-01-01")), ticks=4)
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) <= 2 * 200


def test_generated_values_keep_their_ranges(spark):
    rows = generator.telemetry(fleet(spark, 200), F.lit(at("2024-01-01")), ticks=10).cache()
    assert rows.count() == 2000
    for name in SENSORS:
        low, high, base = generator.RANGES[name]
        shown = rows.select((F.col(name) - (F.col(base) if base else 0.0)).alias("x"))
        if name.startswith("defrost"):
            on = shown.filter("x <> 0").count()
            assert 50 <= on <= 150
            shown = shown.filter("x <> 0")
        least, most = shown.agg(F.min("x"), F.max("x")).first()
        assert low - 0.051 <= least and most <= high + 0.051, name
    gaps = rows.groupBy("device_id").agg((F.max("event_timestamp") - F.min("event_timestamp")).alias("g"))
    assert gaps.select("g").distinct().count() == 1
    starts = rows.filter("tick = 0").agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    assert at("2024-01-01") <= starts[0] and starts[1] < at("2024-01-01 00:01:00")


def test_generation_does_not_depend_on_partitions(spark):
    one = generator.telemetry(fleet(spark).coalesce(1), F.lit(at("2024-01-01")), ticks=3)
    many = generator.telemetry(fleet(spark).repartition(7), F.lit(at("2024-01-01")), ticks=3)
    assert one.exceptAll(many).count() == 0
    other = generator.telemetry(fleet(spark), F.lit(at("2024-01-01")), ticks=3, seed=8)
    assert one.join(other, ["device_id", "tick", "external_temp"]).count() < 20


def test_draws_are_uniform(spark):
    unit = Draws(1, F.col("id")).unit(5)
    row = spark.range(4000).select(unit.alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(row[0] - 0.5) < 0.02 and 0 <= row[1] and row[2] < 1


def test_messages_are_padded_and_parse_back(spark):
    rows = generator.telemetry(fleet(spark), F.lit(at("2024-01-01")), ticks=2)
    made = generator.as_messages(rows)
    values = [bytes(r.value) for r in made.collect()]
    assert {len(v) for v in values} == {1024} and set(json.loads(values[0])["_padding"]) == {"x"}
    parsed = parse.parse(made).select("device_id", "event_timestamp", *SENSORS)
    assert parsed.exceptAll(rows.drop("tick")).count() == 0 and parsed.count() == 40


def test_rate_stream(spark):
    stream = generator.rate_messages(spark, 5, 10)
    assert stream.isStreaming and set(stream.columns) == {"key", "value", "topic", "partition", "offset", "timestamp"}


def test_devices(spark):
    template = spark.createDataFrame([("m", 4)], "device_model string, organization_id int")
    rows = generator.devices(spark, 3, 200, template, F.lit(at("2024-01-01"))).collect()
    assert len(rows) == 198 and rows[0].device_name == "loadtest-device-00003"
    assert {r.organization_id for r in rows} == {4} and len({r.device_uuid for r in rows}) == 198


def test_archive(spark, tmp_path):
    made = generator.as_messages(generator.telemetry(fleet(spark), F.lit(at("2024-01-01 23:59:00")), ticks=2))
    path = str(tmp_path / "bronze")
    messages.write_archive(made, path)
    window = messages.read_archive(spark, path, "2024-01-02", "2024-01-02 00:05:00")
    assert 0 < window.count() < made.count()
    assert "PartitionFilters: [isnotnull(date" in window._jdf.queryExecution().executedPlan().toString()
    assert messages.read_archive(spark, path).count() == made.count()
    assert messages.archive_stream(spark, path).isStreaming


def test_load_files(spark, tmp_path):
    (tmp_path / "requests_1776012094.25.csv").write_text(
        "Type,Name,Request Count,Failure Count,Median Response Time,Average Response Time,"
        "Min Response Time,Max Response Time,Average Content Size,Requests/s,Failures/s,"
        "50%,66%,75%,80%,90%,95%,98%,99%,99.9%,99.99%,100%\n"
        "MQTT,send_telemetry,434305,0,0,0.00066,0,64,1026.0,144.75,0.0,0,0,0,0,0,0,0,0,0,1,64\n"
        ",Aggregated,434650,0,0,0.82,0,3363,1026.1,144.87,0.0,0,0,0,0,0,0,0,0,1,1100,3400\n"
    )
    (tmp_path / "failures_1776102084.5.csv").write_text(
        'Method,Name,Error,Occurrences\nMQTT,disconnect,"""Exception(\'rc=16\')""",45031\n'
    )
    (tmp_path / "exceptions_1.5.csv").write_text('Count,Message,Traceback,Nodes\n2,m,"line 1\nline 2",n1\n')
    stats = {r.name: r for r in loadtest.request_files(spark, str(tmp_path / "requests_*.csv")).collect()}
    assert stats["send_telemetry"].request_count == 434305 and stats["Aggregated"].type is None
    assert stats["Aggregated"].p99_99 == 1100 and stats["Aggregated"].saved_at == 1776012094.25
    failure = loadtest.failure_files(spark, str(tmp_path / "failures_*.csv")).first()
    assert failure.error == "\"Exception('rc=16')\"" and failure.occurrences == 45031
    raised = loadtest.exception_files(spark, str(tmp_path / "exceptions_*.csv")).collect()
    assert len(raised) == 1 and raised[0].traceback == "line 1\nline 2"


def test_device_list(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text("device_name,device_id,primary_key\na,1,k\nb,5,k\nc,9,k\nd,x,k\n")
    rows = loadtest.device_list(spark, str(path), 1, 8)
    assert sorted((r.device_name, r.device_id) for r in rows.collect()) == [("a", 1), ("b", 5)]
    assert rows.columns == ["device_name", "device_id"]


def test_enrichment(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (None,)], "device_id int")
    devices = spark.createDataFrame(
        [(1, 1, False), (2, 9, False), (3, 1, True)], "device_id int, organization_id int, delete_flag boolean"
    )
    organizations = spark.createDataFrame([(1,), (1,)], "organization_id int")
    assert enrich.enrich(rows, devices, organizations).count() == 2
    assert enrich.enrich(rows, devices, organizations, drop_deleted=True).count() == 1
