"""Requests matched with responses on a stream, by their neighbours in keyed state.

Messages of a (client, type, id) wait in its state until the watermark has passed them. They are then
in order for good, and the message before and the one after decide, as in the batch operator: no pairs
are formed. A request is given out when the message after it, or the end of its wait, has passed. A
timer wakes a key when its next message is due, or when nothing can meet its last one any more.

State lives in Spark's state store (RocksDB) under the checkpoint; a key that is settled has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from coldtrace.operators import correlate
from coldtrace.session import use_state_store
from coldtrace.streaming.tables import BatchTable, epoch_of

#: A message in the state of its key; times in microseconds. `given` marks one that was given out.
HELD = np.dtype([("at", "<i8"), ("is_response", "?"), ("numbered", "?"), ("seq", "<i8"), ("given", "?")])
PLACE = ["at", "is_response", "numbered", "seq"]
STATE = "held binary, timer long"
OUTPUT = "client string, msg_type int, msg_id int, at long, is_response boolean, seq long, answered_at long"
_SECOND = 1_000_000


def settle(held: np.ndarray, passed: int, wait: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(messages to give out, times of their answers or -1, messages to keep), once `passed` is over.

    Of a message that came more than once, one is kept. Responses that answer are not given out.
    """
    held = np.sort(held, order=PLACE)
    fresh = np.ones(len(held), bool)
    fresh[1:] = held[PLACE][1:] != held[PLACE][:-1]
    held = held[fresh]
    ready = int(np.searchsorted(held["at"], passed, "right"))
    known = held[:ready]
    if not ready:
        return known, known["at"], held
    near = np.diff(known["at"]) <= wait
    turns = near & ~known["is_response"][:-1] & known["is_response"][1:]
    answered, answers = np.append(turns, False), np.append(False, turns)
    over = bool(known["at"][-1] + wait <= passed)
    open_ = np.zeros(ready, bool)
    open_[-1] = not known["is_response"][-1] and not over
    out = ~known["given"] & ~answers & ~open_
    following = np.append(known["at"][1:], -1)
    # The last message in order stays while another one may meet it.
    kept = held[ready if over else ready - 1 :].copy()
    if not over:
        kept["given"][0] = not open_[-1]
    return known[out], np.where(answered, following, -1)[out], kept


class NeighbourProcessor(StatefulProcessor):
    def __init__(self, wait: int):
        self._wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._messages = handle.getValueState("messages", STATE)

    def _load(self) -> tuple[np.ndarray, int | None]:
        stored = self._messages.get()
        return (np.empty(0, HELD), None) if stored is None else (np.frombuffer(stored[0], HELD), stored[1])

    def _store(self, held: np.ndarray, timer: int | None, due: int | None) -> None:
        """Keeps `held`, and sets the key's one timer to the first millisecond after `due`."""
        wanted = None if due is None else due // 1000 + 1
        if timer is not None and wanted != timer:
            self._handle.deleteTimer(timer)
        if wanted is None:
            self._messages.clear()
            return
        if wanted != timer:
            self._handle.registerTimer(wanted)
        self._messages.update((held.tobytes(), wanted))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, timer = self._load()
        arrived = [held]
        for frame in rows:
            more = np.zeros(len(frame), HELD)
            more["at"] = frame["micros"].to_numpy()
            more["is_response"] = frame["is_response"].to_numpy()
            more["numbered"] = frame["numbered"].to_numpy()
            more["seq"] = frame["seq"].to_numpy()
            arrived.append(more)
        due = min(int(more["at"].min()) for more in arrived[1:] if len(more))
        if timer is not None:  # the first millisecond after what was due before
            due = min(due, (timer - 1) * 1000)
        self._store(np.concatenate(arrived), timer, due)
        yield _output(key, np.empty(0, HELD), np.empty(0, "<i8"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, timer = self._load()
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            yield _output(key, np.empty(0, HELD), np.empty(0, "<i8"))
            return
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        given, answered_at, held = settle(held, passed, self._wait)
        # The one that the watermark has passed is the last in order, all others wait for their time.
        due = np.where(held["at"] <= passed, held["at"] + self._wait, held["at"])
        self._store(held, None, int(due.min()) if len(held) else None)
        yield _output(key, given, answered_at)

    def close(self) -> None:
        pass


def _output(key, given: np.ndarray, answered_at: np.ndarray) -> pd.DataFrame:
    size = len(given)
    return pd.DataFrame(
        {
            "client": pd.array([key[0]] * size, "object"),
            "msg_type": pd.array([key[1]] * size, "Int32"),
            "msg_id": pd.array([key[2]] * size, "Int32"),
            "at": pd.array(given["at"], "Int64"),
            "is_response": pd.array(given["is_response"], "boolean"),
            "seq": pd.arrays.IntegerArray(given["seq"].copy(), ~given["numbered"]),
            "answered_at": pd.arrays.IntegerArray(answered_at.astype("int64"), answered_at < 0),
        }
    )


def settled_messages(messages: DataFrame, wait_seconds: int, lateness: str) -> DataFrame:
    """Requests, and responses that answer none, with the time of the answer or NULL."""
    rows = messages.filter(F.col("at").isNotNull()).withWatermark("at", lateness).select(
        *correlate.KEY,
        "at",
        F.unix_micros("at").alias("micros"),
        F.coalesce("is_response", F.lit(False)).alias("is_response"),
        F.col("seq").isNotNull().alias("numbered"),
        F.coalesce("seq", F.lit(0)).alias("seq"),
    )
    return rows.groupBy(*correlate.KEY).transformWithStateInPandas(
        NeighbourProcessor(int(wait_seconds) * _SECOND), OUTPUT, "Append", "EventTime"
    )


def results(settled: DataFrame) -> DataFrame:
    """One row per request (Success or Timeout) and per stray response (Failure)."""
    response, answered = F.col("is_response"), F.col("answered_at").isNotNull()
    at, answered_at = F.timestamp_micros("at"), F.timestamp_micros("answered_at")
    waited = F.col("answered_at") - F.col("at")
    return settled.select(
        *correlate.KEY,
        "seq",
        F.when(~response, at).alias("request_at"),
        F.when(response, at).when(answered, answered_at).alias("response_at"),
        F.when(response, "Failure").when(answered, "Success").otherwise("Timeout").alias("result"),
        F.when(answered, F.ceil(waited / F.lit(1000))).alias("latency_ms"),
    )


@dataclass
class CorrelationStream:
    """Table `results`: one row per message that is settled.

    Messages may come up to `lateness` behind the newest one. What is open stays in the checkpoint's
    state; a new checkpoint should start at the messages of the last wait.
    """

    spark: SparkSession
    root: str
    wait_seconds: int = correlate.WAIT_SECONDS
    lateness: str = "30 seconds"

    def __post_init__(self) -> None:
        self.results = BatchTable(f"{self.root.rstrip('/')}/results")

    def start(
        self, messages: DataFrame, again: DataFrame | None, checkpoint: str, interval: str | None = "10 seconds"
    ) -> StreamingQuery:
        """`again`, a second reading of `messages` that a join of the stream took, is not read."""
        use_state_store(self.spark)
        epoch = epoch_of(self.spark, f"{self.root.rstrip('/')}/epochs", checkpoint)
        found = results(settled_messages(messages, self.wait_seconds, self.lateness))
        writer = found.writeStream.foreachBatch(lambda frame, batch: self.results.write(frame, epoch, batch))
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
