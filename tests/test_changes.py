"""State, history, mail and status changes of a batch judged as a whole."""

from __future__ import annotations

import json
from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from coldtrace.operators import alerts, changes
from coldtrace.schemas import ALERT_STATE

NOW = at("2024-02-01")
BEGIN = at("2024-01-01")
EVENT = (
    "device_id int, organization_id int, event_id long, event_timestamp timestamp, alert_id int, "
    "alert_name string, alert_conditions_measurement_item_id int, alert_conditions_operator string, "
    "alert_conditions_threshold double, judgment_time int, alert_level_id int, alert_email_flag boolean, "
    "threshold_exceeded boolean, current_sensor_value double"
)


def minutes(n):
    return BEGIN + timedelta(minutes=n)


def judged(spark, events):
    """Events as (device, minute, exceeded); alert id is device * 10, judgment time 5 minutes."""
    rows = [
        (d, 1, n, minutes(m), d * 10, f"rule-{d}", 1, ">", 5.0, 5, 2, d % 2 == 1, x, float(n))
        for n, (d, m, x) in enumerate(events)
    ]
    return spark.createDataFrame(rows, EVENT)


def stored(spark, rows):
    """State as (device, start minute, last event minute, fired minute, history id)."""

    def time(n):
        return None if n is None else minutes(n)

    full = [(d, d * 10, time(s), time(e), 1.0, time(f), h, BEGIN, BEGIN) for d, s, e, f, h in rows]
    return spark.createDataFrame(full, ALERT_STATE)


def run(spark, events, state, **options):
    state = stored(spark, state)
    with_state = alerts.with_state(judged(spark, events), state)
    return changes.BatchChanges(with_state, state, F.lit(NOW), **options)


def state_of(result, device):
    return result.state.filter(F.col("device_id") == device).first()


def test_first_abnormal_event_starts(spark):
    row = state_of(run(spark, [(1, 3, True)], []), 1)
    assert (row.abnormal_start_time, row.last_event_time) == (minutes(3), minutes(3))
    assert row.alert_fired_time is None and row.alert_history_id is None and row.create_time == NOW


def test_abnormal_goes_on_and_keeps_its_start(spark):
    row = state_of(run(spark, [(1, 3, True)], [(1, 0, 0, None, None)]), 1)
    assert row.abnormal_start_time == minutes(0) and row.last_event_time == minutes(3)
    assert row.create_time == BEGIN and row.update_time == NOW


def test_fires_once_at_the_first_triggered_event(spark):
    result = run(spark, [(1, 4, True), (1, 6, True), (1, 7, True)], [(1, 0, 0, None, None)])
    fired = result.firings.collect()
    assert len(fired) == 1 and fired[0].event_timestamp == minutes(6) and fired[0].alert_value == 1.0
    row = state_of(result, 1)
    assert row.alert_fired_time == NOW and row.alert_history_id == fired[0].alert_history_id
    history = result.history.collect()
    assert len(history) == 1 and history[0].alert_status_id == 1
    assert history[0].alert_occurrence_datetime == minutes(0)


def test_a_fired_alert_does_not_fire_again(spark):
    result = run(spark, [(1, 20, True)], [(1, 0, 6, 6, 77)])
    assert result.firings.count() == 0
    row = state_of(result, 1)
    assert row.alert_history_id == 77 and row.alert_fired_time == minutes(6)


def test_recovery_closes_the_history(spark):
    events = [(1, 7, True), (1, 8, False), (1, 9, True), (1, 10, False), (1, 11, False)]
    result = run(spark, events, [(1, 0, 6, 6, 77)])
    row = state_of(result, 1)
    assert (row.abnormal_start_time, row.alert_fired_time, row.alert_history_id) == (None, None, None)
    closing = result.history.collect()
    assert len(closing) == 1 and closing[0].alert_history_id == 77
    assert closing[0].alert_recovery_datetime == minutes(10) and closing[0].alert_status_id == 2


def test_a_normal_row_before_the_last_abnormal_one_is_no_recovery(spark):
    result = run(spark, [(1, 7, False), (1, 8, True)], [(1, 0, 6, 6, 77)])
    assert result.history.count() == 0 and state_of(result, 1).alert_history_id == 77


def test_fired_and_recovered_in_one_batch(spark):
    result = run(spark, [(1, 6, True), (1, 9, False)], [(1, 0, 0, None, None)])
    rows = {r.alert_status_id: r for r in result.history.collect()}
    assert set(rows) == {1, 2}
    assert rows[1].alert_history_id == rows[2].alert_history_id
    assert rows[2].alert_recovery_datetime == minutes(9)


def test_equal_times_put_the_abnormal_row_last(spark):
    for events in ([(1, 3, True), (1, 3, False)], [(1, 3, False), (1, 3, True)]):
        assert state_of(run(spark, events, []), 1).abnormal_start_time == minutes(3)


def test_missing_value_is_no_evidence_or_normal(spark):
    state = [(1, 0, 0, None, None)]
    assert run(spark, [(1, 3, None)], state).state.count() == 0
    assert state_of(run(spark, [(1, 3, None)], state, null_policy="reset"), 1).abnormal_start_time is None
    with pytest.raises(ValueError):
        run(spark, [], [], null_policy="other")


def test_late_rows_are_counted_and_ignored(spark):
    result = run(spark, [(1, 5, False)], [(1, 0, 6, 6, 77)])
    assert result.state.count() == 0 and result.history.count() == 0
    assert result.late_rows.count() == 1


def test_merged_state_keeps_untouched_keys(spark):
    result = run(spark, [(1, 3, True)], [(1, 0, 0, None, None), (2, 1, 1, None, None)])
    state = stored(spark, [(1, 0, 0, None, None), (2, 1, 1, None, None)])
    merged = {r.device_id: r for r in changes.merged_state(state, result.state).collect()}
    assert merged[1].last_event_time == minutes(3) and merged[2].last_event_time == minutes(1)


def test_mail(spark):
    result = run(spark, [(1, 6, True), (2, 6, True)], [(1, 0, 0, None, None), (2, 0, 0, None, None)])
    people = spark.createDataFrame(
        [(1, "a@example.test", True), (1, "b@example.test", True), (1, "c@example.test", False), (2, "d@example.test", True)],
        "organization_id int, email_address string, is_active boolean",
    )
    items = spark.createDataFrame([(2, "other")], "measurement_item_id int, measurement_item_name string")
    rows = changes.mail_rows(result.firings, people, items, F.lit(NOW)).collect()
    assert sorted((r.device_id, r.recipient_email) for r in rows) == [(1, "a@example.test"), (1, "b@example.test")]
    row = rows[0]
    assert row.subject == "[アラート] rule-1 - デバイスID: 1"
    assert row.body == (
        "アラートが発生しました。\n\nデバイスID: 1\nアラート名: rule-1\n測定項目: \n"
        "検出日時: 2024-01-01 00:06:00\n"
    )
    detail = json.loads(row.alert_detail_json)
    assert detail["operator"] == ">" and detail["threshold"] == 5.0 and detail["device_id"] == 1
    assert (row.status, row.retry_count, row.error_message) == ("PENDING", 0, None)


def test_mail_texts_are_written_once_per_firing(spark):
    result = run(spark, [(1, 6, True)], [(1, 0, 0, None, None)])
    people = spark.createDataFrame(
        [(1, "a@example.test", True)], "organization_id int, email_address string, is_active boolean"
    )
    items = spark.createDataFrame([(2, "other")], "measurement_item_id int, measurement_item_name string")
    rows = changes.mail_rows(result.firings, people, items, F.lit(NOW))
    # Under the join with recipients, and unpacked there, or each of its rows would write them anew.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Join Inner") < plan.find("Generate inline") < plan.find("StructsToJson")


def test_status_adds_to_the_stored_count(spark):
    result = run(spark, [(1, 6, True), (2, 7, True)], [(1, 0, 0, None, None), (2, 0, 0, None, None)])
    status = spark.createDataFrame([(1, 4)], "device_id int, alert_count long")
    rows = {r.device_id: r for r in changes.status_rows(result.firings, status, F.lit(NOW)).collect()}
    assert rows[1].alert_count == 5 and rows[2].alert_count == 1
    assert rows[2].latest_event_timestamp == minutes(7) and rows[2].latest_status == "ALERT"
