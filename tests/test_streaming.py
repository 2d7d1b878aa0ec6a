from __future__ import annotations

import json
import time
from datetime import UTC, datetime, timedelta

import pytest
from conftest import at, rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtrace.operators import parse
from coldtrace.schemas import DEVICE_STATUS, MESSAGE
from coldtrace.session import DROP_SHUFFLES, adaptive_as_in
from coldtrace.sources import messages
from coldtrace.streaming import monitor
from coldtrace.streaming.pipeline import Masters, Pipeline, SinkError
from coldtrace.streaming.tables import KeyedTable, current_history, epoch_of
from workload.queries import _land, land_in_order

BEGIN = at("2024-01-01")


def make_masters(spark):
    devices = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "device_id int, organization_id int")
    organizations = spark.createDataFrame([(1,), (1,)], "organization_id int")
    settings = spark.createDataFrame(
        [
            (1, 10, "rule-10", 1, ">", 5.0, 5, 1, True, False),
            (1, 11, "rule-11", 2, "<", 0.0, 0, 1, False, False),
            (2, 20, "rule-20", 1, ">", 5.0, 5, 1, True, True),
        ],
        "device_id int, alert_id int, alert_name string, alert_conditions_measurement_item_id int, "
        "alert_conditions_operator string, alert_conditions_threshold double, judgment_time int, "
        "alert_level_id int, alert_email_flag boolean, delete_flag boolean",
    )
    mail = spark.createDataFrame([(1, "a@example.test", True)], "organization_id int, email_address string, is_active boolean")
    items = spark.createDataFrame([(1, "temp")], "measurement_item_id int, measurement_item_name string")
    return Masters(lambda: devices, lambda: organizations, lambda: settings, lambda: mail, lambda: items)


def land(spark, path, readings, first=0):
    """One more file of (device, minute, external_temp) messages."""
    rows = []
    for n, (device, minute, value) in enumerate(readings, start=first):
        time = (BEGIN + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        body = json.dumps({"device_id": device, "event_timestamp": time, "external_temp": value})
        rows.append((str(device).encode(), body.encode(), "t", 0, n, BEGIN))
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(path)


def clock():
    return datetime(2024, 2, 1, tzinfo=UTC)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def run_stream(pipeline, root, checkpoint="checkpoint"):
    stream = messages.archive_stream(pipeline.spark, f"{root}/landing", max_files=1)
    query = pipeline.start(stream, f"{root}/{checkpoint}", interval=None)
    query.awaitTermination()
    return query


@pytest.mark.parametrize("mode", ["batch", "replay"])
def test_firing_over_batches_restart_and_new_checkpoint(spark, root, mode):
    def pipeline():
        return Pipeline(spark, f"{root}/tables", make_masters(spark), mode=mode, clock=clock, fold_every=2)

    land(spark, f"{root}/landing", [(1, 0, 9.0), (2, 0, 9.0), (3, 0, 9.0), (4, 0, 9.0)])
    run_stream(pipeline(), root)
    land(spark, f"{root}/landing", [(1, 6, 9.0)], first=10)
    run_stream(pipeline(), root)
    land(spark, f"{root}/landing", [(1, 7, 9.0), (2, 7, 9.0)], first=20)
    first = pipeline()
    run_stream(first, root)

    silver = first.silver.read(spark)
    assert sorted((r.device_id, r.external_temp) for r in silver.collect()) == [
        (1, 9.0), (1, 9.0), (1, 9.0), (2, 9.0), (2, 9.0),
    ]
    assert silver.select(F.try_variant_get("sensor_data_json", "$.external_temp", "double")).distinct().count() == 1
    history = current_history(first.history.read(spark)).collect()
    assert [(r.alert_id, r.alert_status_id, r.alert_occurrence_datetime) for r in history] == [(10, 1, BEGIN)]
    assert first.mail.read(spark).count() == 1
    assert [r.alert_count for r in first.status.current(spark, 0).collect()] == [1]

    # A new checkpoint begins a new epoch: batch ids start again, the state goes on.
    land(spark, f"{root}/landing", [(1, 9, 1.0)], first=30)
    second = pipeline()
    run_stream(second, root, checkpoint="checkpoint-2")
    assert epoch_of(spark, second.epochs, f"{root}/checkpoint-2") == 1
    history = current_history(second.history.read(spark)).collect()
    assert [(r.alert_id, r.alert_status_id, r.alert_recovery_datetime) for r in history] == [
        (10, 2, BEGIN + timedelta(minutes=9))
    ]
    state = {r.alert_id: r for r in second.state.current(spark, 1).collect()}
    assert state[10].abnormal_start_time is None and state[10].alert_history_id is None
    assert second.late.read(spark).count() > 0


@pytest.mark.parametrize("mode", ["batch", "replay"])
def test_a_repeated_batch_changes_nothing(spark, root, mode):
    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark), mode=mode, clock=clock)
    land(spark, f"{root}/a", [(1, 0, 9.0)])
    land(spark, f"{root}/b", [(1, 6, 9.0), (2, 6, 9.0)], first=5)
    raw = [spark.read.schema(MESSAGE).parquet(f"{root}/{name}") for name in "ab"]
    pipeline.run_once(raw[0], batch=0)

    def contents():
        tables = [pipeline.silver, pipeline.history, pipeline.mail, pipeline.evaluations]
        keyed = [pipeline.state.current(spark, 0), pipeline.status.current(spark, 0)]
        frames = [t.read(spark) for t in tables] + keyed
        return [rows_of(f.select([c for c in f.columns if c != "sensor_data_json"])) for f in frames]

    pipeline.run_once(raw[1], batch=1)
    once = contents()
    pipeline.run_once(raw[1], batch=1)
    assert contents() == once
    assert len(once[1]) == 1


def test_batch_and_replay_agree_on_one_event_per_key_and_batch(spark, root):
    steps = [(0, 9.0), (3, 9.0), (6, 9.0), (8, 1.0), (9, 9.0), (20, 9.0)]
    found = []
    for mode in ("batch", "replay"):
        pipeline = Pipeline(spark, f"{root}/{mode}", make_masters(spark), mode=mode, clock=clock, fold_every=3)
        for batch, (minute, value) in enumerate(steps):
            land(spark, f"{root}/{mode}-in/{batch}", [(1, minute, value)], first=batch)
            pipeline.run_once(spark.read.schema(MESSAGE).parquet(f"{root}/{mode}-in/{batch}"), batch)
        history = current_history(pipeline.history.read(spark))
        found.append((rows_of(history), rows_of(pipeline.state.current(spark, 0))))
    assert found[0] == found[1]
    assert len(found[0][0]) == 2


def test_failed_sink_is_isolated_recorded_and_raised(spark, root):
    def broken(rows, batch):
        raise OSError("store is down")

    land(spark, f"{root}/landing", [(1, 0, 9.0)])
    raw = spark.read.schema(MESSAGE).parquet(f"{root}/landing")
    lenient = Pipeline(
        spark, f"{root}/tables", make_masters(spark), strict=False, clock=clock, extra_sinks={"outside": broken}
    )
    report = {r.sink: r for r in lenient.run_once(raw).collect()}
    assert not report["outside"].ok and "store is down" in report["outside"].error
    assert all(r.ok for name, r in report.items() if name != "outside")
    assert lenient.silver.read(spark).count() == 1
    assert report["alert_history"].code == "SILVER_ERR_004"
    lenient.strict = True
    with pytest.raises(SinkError):
        lenient.run_once(raw)
    with pytest.raises(StreamingQueryException):
        run_stream(lenient, root)


def test_a_batch_writes_one_file_a_date_and_leaves_the_session_as_it_was(spark, root):
    readings = [(1 + n % 2, 720 * n, 4.0) for n in range(12)]
    pipeline = Pipeline(spark, root, make_masters(spark), clock=clock)
    seen = []
    pipeline.extra_sinks["look"] = lambda rows, batch: seen.append(
        rows.sparkSession.conf.get("spark.sql.adaptive.enabled")
    )
    for first in (0, 12):
        land(spark, f"{root}/landing", readings, first)
    run_stream(pipeline, root)
    files = pipeline.silver.read(spark).withColumn("file", F.input_file_name()).groupBy("event_date", "batch_id").agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("rows")
    )
    assert sorted((r.files, r.rows) for r in files.collect()) == [(1, 2)] * 12
    assert seen == [spark.conf.get("spark.sql.adaptive.enabled")] * 2


def test_adaptive_execution_of_a_batch(spark):
    batch = spark.newSession().range(1)
    conf = batch.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    with pytest.raises(ValueError), adaptive_as_in(spark, batch):
        assert conf.get("spark.sql.adaptive.enabled") == spark.conf.get("spark.sql.adaptive.enabled")
        raise ValueError
    assert conf.get("spark.sql.adaptive.enabled") == "false"


def test_empty_batch(spark, root):
    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark))
    pipeline.process(pipeline.transform(spark.createDataFrame([], MESSAGE)), 0)
    assert pipeline.silver.read(spark) is None


def test_keyed_table_folds_and_ignores_its_own_batch(spark, root):
    table = KeyedTable(f"{root}/status", DEVICE_STATUS, ("device_id",), fold_every=3)

    def change(device, count):
        return spark.createDataFrame([(device, "ALERT", BEGIN, count, BEGIN, BEGIN)], DEVICE_STATUS)

    for batch in range(8):
        table.begin(spark, 0, batch)
        before = {r.device_id: r.alert_count for r in table.before(spark, 0, batch).collect()}
        assert before.get(0) == (None if batch == 0 else batch)
        table.write(change(0, batch + 1), 0, batch)
        again = {r.device_id: r.alert_count for r in table.before(spark, 0, batch).collect()}
        assert again == before
    assert [r.alert_count for r in table.current(spark, 0).collect()] == [8]
    table.write(change(5, 1).unionAll(change(6, 2)), 0, 7)
    wanted = spark.createDataFrame([(6,), (7,)], "device_id int")
    assert [r.device_id for r in table.before(spark, 0, 8, wanted).collect()] == [6]
    with pytest.raises(RuntimeError):
        KeyedTable(f"{root}/none", DEVICE_STATUS, ("device_id",)).before(spark, 0, 0)


def test_progress_table(spark, root):
    listener = monitor.ProgressTable(spark, f"{root}/progress")
    land(spark, f"{root}/landing", [(1, 0, 9.0)])
    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark), clock=clock)
    spark.streams.addListener(listener)
    try:
        query = run_stream(pipeline, root)
    finally:
        spark.streams.removeListener(listener)
    rows = monitor.recent_progress(query)
    assert rows.agg(F.sum("input_rows")).first()[0] == 1
    assert {r.metric for r in monitor.measures(rows).collect()} == {"batch_seconds", "consumer_lag", "rows_per_second"}


def test_a_missing_generation_is_an_error(spark, root):
    table = KeyedTable(f"{root}/t", T.StructType.fromDDL("k int, v int"), ("k",), fold_every=2)
    with pytest.raises(RuntimeError):
        table.begin(spark, 0, 2)


def test_replay_does_not_take_unknown_outcomes_as_normal(spark, root):
    with pytest.raises(ValueError):
        Pipeline(spark, root, make_masters(spark), mode="replay", null_policy="reset")


def test_files_of_a_date_follow_its_own_rows(spark, root, monkeypatch):
    monkeypatch.setattr("coldtrace.streaming.pipeline.FILE_ROWS", 4)
    land(spark, f"{root}/landing", [(1, 720 * n, 4.0) for n in range(12)])
    pipeline = Pipeline(spark, f"{root}/tables", make_masters(spark), clock=clock)
    pipeline.run_once(spark.read.schema(MESSAGE).parquet(f"{root}/landing"))
    files = pipeline.silver.read(spark).withColumn("file", F.input_file_name()).groupBy("event_date").agg(
        F.countDistinct("file").alias("files"), F.count("*").alias("rows")
    )
    # Six dates of two rows each, none of which fills a file.
    assert [(r.files, r.rows) for r in files.collect()] == [(1, 2)] * 6


def test_a_held_message_has_what_it_is_stored_with(spark, root):
    land(spark, f"{root}/landing", [(1, 0, 9.0), (2, 0, 9.0)])
    raw = spark.read.schema(MESSAGE).parquet(f"{root}/landing")
    odd = [b"{bad}", b"text", None, b'{"device_id":1,"event_timestamp":"no"}', b'{"event_timestamp":"2024-01-01"}\n']
    rows = [(None if n else b"7", value, "t", 0, 50 + n, BEGIN) for n, value in enumerate(odd)]
    decoded = parse.decode(raw.unionByName(spark.createDataFrame(rows, MESSAGE)))
    plain = lambda frame: rows_of(frame.withColumn("document", F.col("document").cast("string")))
    told = parse.told_apart(decoded, texts=True)
    assert plain(parse.accepted_of(told)) == plain(parse.accepted(decoded))
    assert rows_of(parse.rejected_of(told)) == rows_of(parse.quarantine(decoded))
    assert told.agg(*parse.stage_counts_of_told()).first() == decoded.agg(*parse.stage_counts()).first()
    kinds = told.groupBy(F.col("reason").isNull().alias("kept")).agg(F.count("value"), F.count("raw_json"), F.count("document"))
    assert sorted(tuple(r) for r in kinds.collect()) == [(False, 4, 0, 0), (True, 0, 2, 2)]
    assert "raw_json" not in parse.told_apart(decoded).columns


def test_landing_leaves_no_shuffle_behind(spark, root):
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disks.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    _land(spark.range(100), f"{root}/landing", make=lambda rows: rows.withColumn("twice", F.col("id") * 2))
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffles() <= before
    landed = spark.read.parquet(f"{root}/landing")
    assert sorted(tuple(r) for r in landed.collect()) == [(n, 2 * n) for n in range(100)]
    assert spark.conf.get(DROP_SHUFFLES, "false") == "false"


def test_what_is_made_of_parts_is_landed_in_order(spark, root):
    rows = spark.range(100).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    stream = land_in_order(rows, "id", f"{root}/landing", 3, make=lambda part: part.withColumn("twice", F.col("id") * 2))
    assert stream.isStreaming and stream.columns == ["id", "twice"]
    landed = spark.read.parquet(f"{root}/landing").withColumn("file", F.input_file_name())
    assert landed.select("file").distinct().count() == 12
    assert sorted((r.id or 0, r.twice or 0) for r in landed.collect()) == [(n, 2 * n) for n in range(100)]


def test_mails_of_few_firings_are_written_by_many_tasks(spark, root, monkeypatch):
    masters = make_masters(spark)
    names = [(1 + n % 2, f"{n}@example.test", n % 5 > 0) for n in range(100)]
    mail = spark.createDataFrame(names, "organization_id int, email_address string, is_active boolean")
    masters.mail_settings = lambda: mail
    # An episode fires in its own batch when it is judged event by event.
    land(spark, f"{root}/landing", [(1, minute, value) for start in range(0, 60, 10) for minute, value in ((start, 9.0), (start + 6, 9.0), (start + 8, 1.0))])
    raw = spark.read.schema(MESSAGE).parquet(f"{root}/landing")

    def queue(name):
        pipeline = Pipeline(spark, f"{root}/{name}", masters, mode="replay", clock=clock)
        report = {r.sink: r for r in pipeline.run_once(raw).collect()}
        rows = pipeline.mail.read(spark)
        assert report["email_queue"].metrics == {"rows": rows.count()}
        return rows_of(rows), rows.select(F.input_file_name()).distinct().count()

    plain, files = queue("plain")
    assert len(plain) == 6 * 40 and files == 1
    monkeypatch.setattr("coldtrace.streaming.pipeline.FILE_ROWS", 4)
    monkeypatch.setattr("coldtrace.operators.changes.MAIL_ROWS", 50)
    spread, files = queue("spread")
    assert spread == plain and files > 1
