"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import math

import pytest
from conftest import SF_DIR

import __spark_entry__ as registered
from coldtrace.plans import traffic, validation
from coldtrace.plans.traffic import PERCENTILES
from workload.views import Views

QUERIES = registered.queries()
ORACLES = registered.oracle_sql()
STREAMS = "q_stream_ q_sink_ q_monitor q_restart q_start_over q_state_stream q_minute_windows q_late_rows"
STREAMED = {n for n in QUERIES if n.startswith(tuple(STREAMS.split()))}


def _sorted_rows(table):
    names = sorted(table.column_names)
    rows = list(zip(*[table.column(name).to_pylist() for name in names]))
    return names, sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(set(ORACLES) - STREAMED))
def test_equals_sql(spark, duck, name):
    assert _sorted_rows(QUERIES[name](spark, SF_DIR).toArrow()) == _sorted_rows(
        duck.sql(ORACLES[name]).to_arrow_table()
    )


@pytest.mark.parametrize("name", sorted(STREAMED & set(ORACLES)))
def test_streamed_equals_sql(spark, duck, name):
    assert _sorted_rows(QUERIES[name](spark, SF_DIR).toArrow()) == _sorted_rows(
        duck.sql(ORACLES[name]).to_arrow_table()
    )


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_payload_sample_shows_three(spark):
    assert QUERIES["q_payload_sample"](spark, SF_DIR).count() == 3


def test_approximate_counts_are_near(spark):
    exact = QUERIES["q_per_device"](spark, SF_DIR).count()
    about = validation.distinct_devices(Views(spark, SF_DIR).telemetry, approximate=True).first()[0]
    assert abs(about - exact) <= max(1, 0.05 * exact)


def test_sketched_percentiles_are_exact_for_small_groups(spark):
    """With fewer rows than the sketch's accuracy: the smallest time with at least n * p rows up to it."""
    times = {}
    for r in Views(spark, SF_DIR).requests.collect():
        times.setdefault((r.type, r.name), []).append(r.response_time)
    rows = traffic.approximate_percentiles(Views(spark, SF_DIR).requests).collect()
    assert len(rows) == len(times)
    for row in rows:
        ordered = sorted(times[row.type, row.name])
        for name, p in PERCENTILES.items():
            assert row[name] == ordered[math.ceil(len(ordered) * p) - 1], name


def test_entry(spark):
    assert registered.entry(spark).columns == [
        "device_id",
        "alert_id",
        "abnormal_start_time",
        "fired_event_time",
        "alert_value",
        "recovered_event_time",
    ]
