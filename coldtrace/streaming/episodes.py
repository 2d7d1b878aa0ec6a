"""Alert episodes of a stream, judged event by event in keyed state.

Events of a (device, alert) wait in its state until the watermark has passed them; then they are
judged in the order of the replay, so the result does not depend on how they arrived. What comes
behind the watermark is left out by Spark. A timer wakes a key when its next event is due, and when
nothing has been heard of its device for too long; the state of a silent key that is in no episode is
given up.

State lives in Spark's state store (RocksDB) under the checkpoint. A new checkpoint begins with the
state that the last one left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from coldtrace.operators import alerts, replay
from coldtrace.session import use_state_store
from coldtrace.streaming.tables import BatchTable, checkpoints_before, epoch_of

KEY = replay.KEY
#: An event that waits for the watermark; times in microseconds.
WAITING = np.dtype(
    [("at", "<i8"), ("normal", "?"), ("seq", "<i8"), ("value", "<f8"), ("minutes", "<i8")]
)
STATE = "exceeded boolean, due boolean, start long, last long, waiting binary, timer long"
OUTPUT = "device_id int, alert_id int, kind string, start long, at long, value double"
FIRED, RECOVERED, SILENT = "fired", "recovered", "silent"
_SECOND = 1_000_000


@dataclass
class Episode:
    """What is known of a key: its last judged event, the episode that is open, and who waits."""

    exceeded: bool = False
    due: bool = False
    start: int | None = None
    last: int | None = None
    waiting: bytes = b""
    timer: int | None = None

    def judge(self, event) -> tuple[str, int, int, float] | None:
        """Takes the next event in order; returns (kind, episode start, time, value) if it matters."""
        at, value = int(event["at"]), float(event["value"])
        self.last = at
        if event["normal"]:
            ended = (RECOVERED, self.start, at, value) if self.exceeded and self.due else None
            self.exceeded = self.due = False
            self.start = None
            return ended
        if not self.exceeded:
            self.exceeded, self.due, self.start = True, False, at
            return None
        long_enough = at // _SECOND - self.start // _SECOND >= int(event["minutes"]) * 60
        fires = long_enough and not self.due
        self.due = self.due or long_enough
        return (FIRED, self.start, at, value) if fires else None


class EpisodeProcessor(StatefulProcessor):
    def __init__(self, silence_us: int | None):
        self._silence = silence_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._episode = handle.getValueState("episode", STATE)

    def _load(self) -> Episode:
        stored = self._episode.get()
        return Episode() if stored is None else Episode(*stored)

    def _wake(self, episode: Episode, at: int | None) -> None:
        """Sets the key's one timer to the first millisecond after `at`."""
        wanted = None if at is None else at // 1000 + 1
        if wanted == episode.timer:
            return
        if episode.timer is not None:
            self._handle.deleteTimer(episode.timer)
        if wanted is not None:
            self._handle.registerTimer(wanted)
        episode.timer = wanted

    def _store(self, episode: Episode) -> None:
        held = bytes(episode.waiting)
        self._episode.update(
            (episode.exceeded, episode.due, episode.start, episode.last, held, episode.timer)
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        episode = self._load()
        arrived = [np.frombuffer(episode.waiting, WAITING)]
        for frame in rows:
            more = np.zeros(len(frame), WAITING)
            for name in WAITING.names:
                more[name] = frame[name].to_numpy()
            arrived.append(more)
        waiting = np.concatenate(arrived)
        episode.waiting = waiting.tobytes()
        if len(waiting):
            self._wake(episode, int(waiting["at"].min()))
        self._store(episode)
        return _output(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        episode = self._load()
        if episode.timer != expiredTimerInfo.getExpiryTimeInMs():
            return _output(key, [])
        episode.timer = None
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = np.sort(np.frombuffer(episode.waiting, WAITING), order=["at", "normal", "seq"])
        ready = int(np.searchsorted(waiting["at"], passed, "right"))
        found = [f for f in map(episode.judge, waiting[:ready]) if f is not None]
        episode.waiting = waiting[ready:].tobytes()
        if ready < len(waiting):
            self._wake(episode, int(waiting["at"][ready]))
        elif self._silence is not None and episode.last is not None:
            if episode.last + self._silence < passed:
                found.append((SILENT, episode.start, episode.last, None))
                if not episode.exceeded:
                    self._episode.clear()
                    return _output(key, found)
            else:
                self._wake(episode, episode.last + self._silence)
        self._store(episode)
        return _output(key, found)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        stored = initialState.iloc[0]
        plain = [None if pd.isna(stored[n]) else stored[n] for n in ("start", "last")]
        episode = Episode(
            bool(stored["exceeded"]), bool(stored["due"]), *[None if x is None else int(x) for x in plain],
            bytes(stored["waiting"] or b""),
        )
        waiting = np.frombuffer(episode.waiting, WAITING)
        if len(waiting):
            self._wake(episode, int(waiting["at"].min()))
        elif self._silence is not None and episode.last is not None:
            self._wake(episode, episode.last + self._silence)
        self._store(episode)

    def close(self) -> None:
        pass


def _output(key, found: list[tuple]) -> Iterator[pd.DataFrame]:
    """A frame of what was found, and none if nothing was: a frame costs more than most events."""
    if not found:
        return iter(())
    kinds, starts, times, values = zip(*found)
    frame = pd.DataFrame(
        {
            "device_id": np.full(len(found), key[0], np.int32),
            "alert_id": np.full(len(found), key[1], np.int32),
            "kind": np.array(kinds, object),
            "start": np.array(starts, object),
            "at": np.array(times, np.int64),
            # What is no number becomes NULL.
            "value": np.array(values, np.float64),
        }
    )
    return iter((frame,))


@dataclass
class EpisodeStream:
    """Table `events`: firings, recoveries and silences of (device, alert), one row each.

    `rules` are read when the query starts. Events may come up to `lateness` behind the newest one.
    After `silence` without an event of a key a `silent` row is written, with the start of the episode
    that is still open, if any.
    """

    spark: SparkSession
    root: str
    rules: Callable[[], DataFrame]
    lateness: str = "10 minutes"
    silence: timedelta | None = timedelta(days=1)

    def __post_init__(self) -> None:
        self.events = BatchTable(f"{self.root.rstrip('/')}/events")
        self._epochs = f"{self.root.rstrip('/')}/epochs"

    def _left_by(self, checkpoint: str) -> DataFrame | None:
        """State at the end of the checkpoint used before this one."""
        before = checkpoints_before(self.spark, self._epochs, checkpoint)
        if not before:
            return None
        stored = self.spark.read.format("statestore").option("stateVarName", "episode").load(before[-1])
        return stored.select("key.*", "value.*").drop("timer")

    def episodes(self, rows: DataFrame, carried: DataFrame | None = None) -> DataFrame:
        """Stream of what happens, from a stream of sensor rows numbered by `event_id`."""
        # The watermark stands below the join, so that rows without a rule move it too.
        watched = rows.withWatermark("event_timestamp", self.lateness)
        judged = alerts.evaluate(watched, alerts.active_rules(self.rules()), how="inner")
        outcomes = replay.replay_rows(judged).select(
            *KEY,
            "event_timestamp",
            F.unix_micros("event_timestamp").alias("at"),
            "normal",
            "seq",
            F.coalesce("value", F.lit(float("nan"))).alias("value"),
            F.col("judgment_time").cast("long").alias("minutes"),
        )
        silence = None if self.silence is None else int(self.silence.total_seconds() * _SECOND)
        found = outcomes.groupBy(*KEY).transformWithStateInPandas(
            EpisodeProcessor(silence),
            OUTPUT,
            "Append",
            "EventTime",
            initialState=None if carried is None else carried.groupBy(*KEY),
        )
        return found.select(
            *KEY,
            "kind",
            F.timestamp_micros("start").alias("abnormal_start_time"),
            F.timestamp_micros("at").alias("event_time"),
            "value",
        )

    def start(self, rows: DataFrame, checkpoint: str, interval: str | None = "10 seconds") -> StreamingQuery:
        use_state_store(self.spark)
        carried = self._left_by(checkpoint)
        epoch = epoch_of(self.spark, self._epochs, checkpoint)
        writer = self.episodes(rows, carried).writeStream.foreachBatch(
            lambda frame, batch: self.events.write(frame, epoch, batch)
        )
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def history(self) -> DataFrame:
        """One row per firing with its recovery, as the replay gives it."""
        fired = F.col("kind") == FIRED
        matter = self.events.read(self.spark).filter(F.col("kind").isin(FIRED, RECOVERED))
        return matter.groupBy(*KEY, "abnormal_start_time").agg(
            F.max(F.when(fired, F.col("event_time"))).alias("fired_event_time"),
            F.max(F.when(fired, F.col("value"))).alias("alert_value"),
            F.max(F.when(~fired, F.col("event_time"))).alias("recovered_event_time"),
        )

    def silent(self) -> DataFrame:
        """Keys not heard of for longer than `silence`, and the episode open at that time."""
        found = self.events.read(self.spark).filter(F.col("kind") == SILENT)
        return found.select(*KEY, F.col("event_time").alias("last_event_time"), "abnormal_start_time")
