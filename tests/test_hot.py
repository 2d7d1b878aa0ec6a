from __future__ import annotations

import random

from conftest import rows_of

from coldtrace.operators import correlate, hot, numbering
from coldtrace.session import materialise, scratch_root
from conftest import at
from datetime import timedelta


def test_no_hot_key(spark):
    assert hot.hot_keys(spark.range(10).selectExpr("id % 2 AS k"), ["k"], limit=5) is None


def test_null_is_a_key(spark):
    rows = spark.createDataFrame([(None,)] * 9 + [(1,)], "k int")
    found = hot.hot_keys(rows, ["k"], limit=5)
    ordinary, oversized = hot.split_hot(rows, found, ["k"])
    assert (ordinary.count(), oversized.count()) == (1, 9)


def test_all_hot_keys_are_named_with_their_rows(spark):
    rows = spark.createDataFrame([(1,)] * 4 + [(2,)] * 9 + [(3,)], "k int")
    assert rows_of(hot.hot_keys(rows, ["k"], limit=2).select("k", hot.COUNT)) == [(4, 1), (9, 2)]


def test_ways_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hot, "TASK_ROWS", 100)
    big = spark.range(1000).selectExpr("id AS seq", "if(id < 950, 0, id) AS k")
    small = spark.range(1000).selectExpr("id AS k", "id AS v")
    joined = hot.spread_join(big, small, ["k"], ["seq"], "inner", hot.hot_keys(big, ["k"], limit=500))
    assert joined.count() == 1000
    sliced = hot.slice_in_order(materialise(big), ["k", "seq"])
    assert sliced.select("slice").distinct().count() >= 9


def test_spread_join_is_a_join(spark):
    big = spark.range(1000).selectExpr("id AS seq", "if(id < 700, 0, id % 20) AS k")
    small = spark.range(15).selectExpr("id AS k", "id * 2 AS twice").unionAll(
        spark.createDataFrame([(0, 99)], "k long, twice long")
    )
    found = hot.hot_keys(big, ["k"], limit=100)
    for how in ("left", "inner"):
        assert rows_of(hot.spread_join(big, small, ["k"], ["seq"], how, found, ways=8)) == rows_of(
            big.join(small, "k", how)
        )


def test_slices_are_near_equal_whatever_the_key(spark):
    rows = spark.range(4000).selectExpr("1 AS k", "id")
    sizes = [r["count"] for r in hot.slice_in_order(rows, ["k", "id"], 8).groupBy("slice").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 1000


def test_materialise_uses_the_shared_folder(spark):
    kept = materialise(spark.range(5))
    assert kept.inputFiles()[0].startswith("file://" + scratch_root(spark))
    assert kept.count() == 5


def brute_force(messages):
    """Requests and responses gone through in time order with one open request per key."""
    opened, out = {}, []
    for client, kind, ident, time, is_response, seq in sorted(messages, key=lambda m: (m[3], m[4], m[5])):
        key = (client, kind, ident)
        if not is_response:
            if key in opened:
                out.append((*opened.pop(key), "Timeout", None))
            opened[key] = (seq, time)
        elif key in opened and time - opened[key][1] <= timedelta(seconds=15):
            asked = opened.pop(key)
            micros = (time - asked[1]) // timedelta(microseconds=1)
            out.append((*asked, "Success", -(-micros // 1000)))
        else:
            if key in opened:
                out.append((*opened.pop(key), "Timeout", None))
            out.append((seq, None, "Failure", None))
    out += [(*asked, "Timeout", None) for asked in opened.values()]
    return sorted(out, key=str)


def test_correlation_equals_brute_force(spark):
    pick, time, messages = random.Random(4), at("2024-01-01"), []
    for seq in range(600):
        time += timedelta(milliseconds=pick.choice([0, 1, 900, 5000, 14999, 15000, 15001]))
        messages.append(("c", pick.choice([1, 1, 2]), pick.choice([1, 1, 1, 2]), time, pick.random() < 0.5, seq))
    frame = spark.createDataFrame(
        messages, "client string, msg_type int, msg_id int, at timestamp, is_response boolean, seq long"
    )
    want = brute_force(messages)
    found = hot.hot_keys(frame, correlate.KEY, limit=100)
    for given in (None, found):
        rows = correlate.correlate(frame, hot=given, slices=9).collect()
        assert sorted([(r.seq, r.request_at, r.result, r.latency_ms) for r in rows], key=str) == want


def test_shares(spark):
    ids = spark.createDataFrame([(i * 3,) for i in range(10)], "device_id int")
    shared = numbering.share_out(numbering.number_rows(ids, "device_id", block=7), 3)
    rows = sorted((r.device_id, r.rn, r.worker) for r in shared.collect())
    assert [r[1] for r in rows] == list(range(1, 11))
    assert [r[2] for r in rows] == [0] * 3 + [1] * 3 + [2] * 4
    few = numbering.share_out(numbering.number_rows(ids.limit(2), "device_id"), 3)
    assert {r.worker for r in few.collect()} == {2}
