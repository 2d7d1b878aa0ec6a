from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import at, rows_of
from pyspark.sql import functions as F

from coldtrace.plans import runs, traffic, validation, verdicts
from coldtrace.streaming.monitor import catch_up_minutes

# Published records per minute of two load runs.
RUN_2_BEGIN, RUN_2 = "2026-04-12 16:45:00", [
    279, 681, 1138, 1434, 1953, 2299, 2704, 3084, 3487, 3929, 4342, 4607, 5102, 5527, 5911, 6209,
    6766, 7031, 7487, 7869, 8322, 8760, 9016, 9553, 9906, 10256, 10681, 11128, 11495, 11782, 12381,
    12689, 13104, 13440, 13828, 13559, 13760, 13595, 13795, 13564, 13633, 13781, 13602, 13624, 13712,
    13693, 13614, 13652, 13726, 13662, 309,
]
RUN_5_BEGIN, RUN_5 = "2026-04-14 02:52:00", [
    9, 360, 608, 570, 617, 620, 969, 1176, 1194, 1215, 1250, 1537, 1781, 1796, 1807, 1815, 2201, 2359,
    2360, 2424, 2437, 2771, 2936, 2977, 3019, 3082, 3372, 3512, 3577, 3610, 3701, 3940, 4130, 4138, 4264,
    4004, 3958, 4112, 4170, 4284, 4000, 3936, 4146, 4123, 4253, 4061, 3935, 4115, 4093, 4281, 4084, 3941,
    4106, 4088, 4241, 4129, 3971, 4116, 3994, 4245, 80,
]


def series(spark, begin, counts, run):
    rows = [(run, at(begin) + timedelta(minutes=i), n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "run int, minute timestamp, records long")


@pytest.mark.parametrize(
    "begin, counts, start, end, devices, interval, records, rate, total",
    [
        (RUN_2_BEGIN, RUN_2, "2026-04-12 17:20", "2026-04-12 17:30", 20500, 90, 136625, 227.7, 453461),
        (RUN_5_BEGIN, RUN_5, "2026-04-14 03:27", "2026-04-14 03:52", 20500, 300, 102386, 68.3, 180600),
        (RUN_5_BEGIN, RUN_5, "2026-04-14 03:30", "2026-04-14 03:40", 20500, 300, 41023, 68.4, 180600),
    ],
)
def test_steady_rate(spark, begin, counts, start, end, devices, interval, records, rate, total):
    minutes = series(spark, begin, counts, 1)
    assert minutes.agg(F.sum("records")).first()[0] == total
    row = runs.steady_rate(
        minutes, F.lit(at(start)), F.lit(at(end)), F.lit(devices), F.lit(interval)
    ).first()
    assert row.records == records and round(row.rate, 1) == rate
    assert abs(row.deviation_pct) < 0.2


def test_phases(spark):
    both = series(spark, RUN_2_BEGIN, RUN_2, 2).unionAll(series(spark, RUN_5_BEGIN, RUN_5, 5))
    two = runs.phases(both.filter("run = 2"), 20500 / 90 * 60, minutes=1, share=0.98)
    summary = {r.phase: r for r in runs.phase_summary(two).collect()}
    assert summary["end"].minutes == 1 and summary["end"].records == 309
    assert summary["steady"].last_minute == at("2026-04-12 17:34")
    assert summary["ramp-up"].first_minute == at("2026-04-12 16:45")
    assert sum(r.records for r in summary.values()) == 453461
    never = runs.phases(both.filter("run = 5"), 1e9)
    assert rows_of(never.select("phase").distinct()) == [("ramp-up",)]


def test_sent_and_stored(spark):
    sent = spark.range(453461).selectExpr("0 AS run")
    stored = spark.range(453373).selectExpr("0 AS run")
    row = runs.sent_against_stored(sent, stored, ["run"]).first()
    assert row.difference == -88 and round(row.difference_pct, 2) == -0.02


def test_run_change(spark):
    rows = spark.createDataFrame([(2, 221.38, 726.0), (5, 24.42, 56.0)], "run int, avg double, max double")
    change = {r.metric: round(r.change_pct) for r in runs.run_change(rows, ["avg", "max"]).collect() if r.run == 5}
    assert change == {"avg": -89, "max": -92}


def test_ratio(spark):
    rows = spark.createDataFrame([(1, 192490, 136670)], "run int, a long, b long")
    assert round(runs.ratio_of_sums(rows, ["run"], F.col("a"), F.col("b")).first().ratio, 2) == 1.41


def test_closed_and_half_open_window(spark):
    rows = spark.createDataFrame([(at("2024-01-01 00:10"),)], "event_timestamp timestamp")
    bounds = ("2024-01-01 00:00:00", "2024-01-01 00:10:00")
    assert validation.within(rows, *bounds).count() == 1
    assert validation.within(rows, *bounds, inclusive_end=False).count() == 0


def tool_percentile(times, p):
    """Walks the rounded times from the top until at most floor(n * p) lie below."""
    below = len(times)
    for value in sorted(set(times), reverse=True):
        below -= times.count(value)
        if below <= int(len(times) * p):
            return value


def test_percentiles_of_rounded_times(spark):
    raw = [0.4, 0.5, 1.5, 99.6, 104.9, 105.0, 115.0, 3363.0, 945.0, 12345.0, 64.5]
    begin = at("2024-01-01")
    rows = [("t", "n", x, 1026.0, None, begin + timedelta(seconds=i)) for i, x in enumerate(raw)]
    frame = spark.createDataFrame(
        rows, "type string, name string, response_time double, response_length double, exception string, at timestamp"
    )
    rounded = [float(round(x) if x < 100 else round(x, -1) if x < 1000 else round(x, -2) if x < 10000 else round(x, -3)) for x in raw]
    row = traffic.request_stats(frame).first()
    for name, p in traffic.PERCENTILES.items():
        assert row[name] == tool_percentile(rounded, p), name
    assert row.median_response_time == sorted(rounded)[(len(rounded) - 1) // 2]
    assert row.max_response_time == 12345.0 and row.requests_per_s == 11 / 10
    assert row.average_content_size == 1026.0


def test_new_arrivals_ignore_resets(spark):
    rows = [(0, 1, 10), (0, 2, 20), (1, 1, 15), (1, 2, 5), (2, 1, 15), (2, 2, 9)]
    polls = spark.createDataFrame(rows, "poll_time int, partition int, last_sequence long")
    assert rows_of(traffic.new_arrivals(polls)) == [(0, 0), (4, 2), (5, 1)]


def test_verdict_summary_is_counted_from_the_rows(spark):
    # Published verdicts of the checks 6 to 34 of one run.
    cautions, fails = {16, 18, 25, 32}, {24, 28}
    rows = [
        (n, "all", verdicts.CAUTION if n in cautions else verdicts.FAIL if n in fails else verdicts.PASS)
        for n in range(6, 35)
    ]
    judged = spark.createDataFrame(rows, "check_id int, category string, verdict string")
    totals = {r.category: (r["pass"], r.fail, r.caution) for r in verdicts.roll_up(judged).collect()}
    assert totals["total"] == (23, 2, 4)


def test_missing_measure_is_a_caution(spark):
    measured = spark.createDataFrame([("avg_lag_sec", 22.96)], "metric string, value double")
    found = {r.metric: r.verdict for r in verdicts.judge(measured, verdicts.checks(spark)).collect()}
    assert found["avg_lag_sec"] == verdicts.FAIL and found["consumer_lag"] == verdicts.CAUTION


def test_catch_up():
    assert catch_up_minutes(700 * 3600, 700, 2100) == 30
    assert catch_up_minutes(1, 5, 5) is None


def test_largest_gap_reaches_across_days(spark):
    def gap(*texts):
        rows = spark.createDataFrame([(at(t) if t else None,) for t in texts], "timestamp timestamp")
        return validation.largest_gap_minutes(rows).first()[0]

    assert gap("2024-01-01T23:48:10", "2024-01-01T23:50:00", "2024-01-02T08:00:59", "2024-01-02T08:03:00") == 490
    assert gap("2024-01-01T12:00:00", "2024-01-04T12:00:00", None) == 3 * 24 * 60
    assert gap("2024-01-01T10:00:00", "2024-01-01T23:59:00", "2024-01-02T00:00:00") == 839
    assert gap("2024-01-01T10:00:00") is None
