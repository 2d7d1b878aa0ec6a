"""What one micro-batch changes: state, firing history, mail queue, device status.

All change sets derive from one snapshot of the state as it was before the batch, and none reads a
table the batch itself writes, so their order of writing does not matter and a repeat of the batch
gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.functions import notices
from coldtrace.functions import rules as R
from coldtrace.operators.hot import spread_join
from coldtrace.schemas import ALERT_HISTORY, ALERT_STATE, STATUS_FIRING, STATUS_RECOVERED

KEY = ["device_id", "alert_id"]
# What a firing needs to know of its row beyond key, time and value.
FIRING_DETAIL = (
    "organization_id",
    "alert_name",
    "alert_conditions_measurement_item_id",
    "alert_conditions_operator",
    "alert_conditions_threshold",
    "alert_level_id",
    "alert_email_flag",
)
#: Queue rows that one task writes, about.
MAIL_ROWS = 500_000


Hold = Callable[[DataFrame], DataFrame]


def no_hold(rows: DataFrame) -> DataFrame:
    return rows


def is_late() -> Column:
    """Older than the last event already judged for the key."""
    return F.coalesce(F.col("event_timestamp") < F.col("last_event_time"), F.lit(False))


def considered(with_state: DataFrame, null_policy: str = "keep") -> DataFrame:
    """Rows that count as evidence.

    `keep`: a missing value says nothing and leaves the state alone. `reset`: it counts as normal.
    """
    rows = with_state.filter(F.col("alert_id").isNotNull() & ~is_late())
    if null_policy == "keep":
        return rows.filter(F.col("threshold_exceeded").isNotNull())
    if null_policy == "reset":
        return rows.withColumn("threshold_exceeded", F.coalesce("threshold_exceeded", F.lit(False)))
    raise ValueError(f"null_policy: {null_policy}")


def per_alert(rows: DataFrame, seq: str = "event_id") -> DataFrame:
    """One row per (device, alert) of the batch: newest row, first triggered row, last exceeded time.

    A single grouping with map-side combine; nothing is sorted per key.
    """
    exceeded = F.col("threshold_exceeded")
    detail = [c for c in FIRING_DETAIL if c in rows.columns]
    return rows.groupBy(*KEY).agg(
        F.max(
            F.struct(
                "event_timestamp",
                exceeded.alias("exceeded"),
                F.col(seq).alias("seq"),
                F.col("current_sensor_value").alias("value"),
                F.col("alert_triggered").alias("triggered"),
            )
        ).alias("newest"),
        F.min(
            F.when(
                F.col("alert_triggered"),
                F.struct(
                    "event_timestamp",
                    F.col(seq).alias("seq"),
                    F.col("current_sensor_value").alias("value"),
                    *detail,
                ),
            )
        ).alias("fired"),
        F.max(F.when(exceeded, F.col("event_timestamp"))).alias("last_exceeded_time"),
        F.max("abnormal_start_time").alias("abnormal_start_time"),
        F.max("alert_fired_time").alias("alert_fired_time"),
        F.max("alert_history_id").alias("alert_history_id"),
    ).withColumn("pattern", R.update_pattern(F.col("newest.exceeded"), F.col("newest.triggered")))


def firings(per_key: DataFrame) -> DataFrame:
    """One row per alert that fires in this batch, at its first triggered event."""
    detail = [f for f in per_key.schema["fired"].dataType.names if f in FIRING_DETAIL]
    return per_key.filter(F.col("fired").isNotNull()).select(
        *KEY,
        "abnormal_start_time",
        F.col("fired.event_timestamp").alias("event_timestamp"),
        F.col("fired.value").alias("alert_value"),
        *[F.col(f"fired.{name}").alias(name) for name in detail],
        R.history_id(F.col("device_id"), F.col("alert_id"), F.col("abnormal_start_time")).alias(
            "alert_history_id"
        ),
        R.history_uuid(F.col("device_id"), F.col("alert_id"), F.col("abnormal_start_time")).alias(
            "alert_history_uuid"
        ),
    )


def changed_state(per_key: DataFrame, state: DataFrame, batch_time: Column) -> DataFrame:
    """Full new state row of every key the batch touched."""
    created = state.select(*KEY, "create_time")
    pattern = F.col("pattern")
    fired_now = pattern == R.ALERT_FIRED
    new_id = R.history_id(F.col("device_id"), F.col("alert_id"), F.col("abnormal_start_time"))
    return (
        per_key.join(created, KEY, "left")
        .select(
            *KEY,
            F.when(
                pattern != R.RECOVERY,
                F.coalesce("abnormal_start_time", F.col("newest.event_timestamp")),
            ).alias("abnormal_start_time"),
            F.col("newest.event_timestamp").alias("last_event_time"),
            F.col("newest.value").alias("last_sensor_value"),
            F.when(fired_now, batch_time)
            .when(pattern == R.ABNORMAL_START, F.col("alert_fired_time"))
            .alias("alert_fired_time"),
            F.when(fired_now, new_id)
            .when(pattern == R.ABNORMAL_START, F.col("alert_history_id"))
            .alias("alert_history_id"),
            F.coalesce("create_time", batch_time).alias("create_time"),
            batch_time.alias("update_time"),
        )
    )


def merged_state(state: DataFrame, changed: DataFrame) -> DataFrame:
    """The whole state after the batch: changed rows replace stored ones of the same key."""
    names = [f.name for f in ALERT_STATE if f.name not in KEY]
    new = F.struct(*names).alias("new")
    old = F.struct(*names).alias("old")
    both = state.select(*KEY, old).join(changed.select(*KEY, new), KEY, "full")
    taken = F.coalesce("new", "old")
    return both.select(*KEY, *[taken[name].alias(name) for name in names])


def recoveries(rows: DataFrame, per_key: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Alerts that fired, before or in this batch, and whose newest row is normal.

    The recovery time is the first normal event after the last exceeded one.
    """
    fired_here = F.col("fired").isNotNull()
    new_id = R.history_id(F.col("device_id"), F.col("alert_id"), F.col("abnormal_start_time"))
    ended = per_key.filter(
        (F.col("pattern") == R.RECOVERY) & (fired_here | F.col("alert_fired_time").isNotNull())
    ).select(
        *KEY,
        "last_exceeded_time",
        F.when(fired_here, new_id).otherwise(F.col("alert_history_id")).alias("alert_history_id"),
    )
    normal = rows.filter(~F.col("threshold_exceeded")).select(*KEY, "event_timestamp")
    after = F.col("last_exceeded_time").isNull() | (
        F.col("event_timestamp") >= F.col("last_exceeded_time")
    )
    return (
        spread_join(normal, ended, KEY, ["event_timestamp"], "inner", hot)
        .filter(after)
        .groupBy(*KEY, "alert_history_id")
        .agg(F.min("event_timestamp").alias("recovered_event_time"))
    )


def history_rows(fired: DataFrame, batch_time: Column) -> DataFrame:
    """Opening rows of the firing history."""
    return fired.select(
        "alert_history_id",
        "alert_history_uuid",
        "alert_id",
        F.col("abnormal_start_time").alias("alert_occurrence_datetime"),
        F.lit(None).cast("timestamp").alias("alert_recovery_datetime"),
        F.lit(STATUS_FIRING).alias("alert_status_id"),
        "alert_value",
        batch_time.alias("create_date"),
        F.lit(0).alias("creator"),
        batch_time.alias("update_date"),
        F.lit(0).alias("modifier"),
        F.lit(False).alias("delete_flag"),
    )


def closing_rows(recovered: DataFrame, batch_time: Column) -> DataFrame:
    """Closing rows of the firing history: only key, recovery time, status and change time are set."""
    given = {
        "alert_history_id": F.col("alert_history_id"),
        "alert_recovery_datetime": F.col("recovered_event_time"),
        "alert_status_id": F.lit(STATUS_RECOVERED),
        "update_date": batch_time,
    }
    return recovered.filter(F.col("alert_history_id").isNotNull()).select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ALERT_HISTORY
        ]
    )


def with_mail(fired: DataFrame) -> DataFrame:
    return fired.filter(R.should_enqueue_email(F.lit(True), F.col("alert_email_flag")))


def mails(fired: DataFrame, items: DataFrame) -> DataFrame:
    """The mail of every mail-enabled firing, with its texts: once per firing, whoever gets it."""
    named = items.select(
        F.col("measurement_item_id").alias("alert_conditions_measurement_item_id"),
        "measurement_item_name",
    )
    wanted = with_mail(fired)
    name, device, event = F.col("alert_name"), F.col("device_id"), F.col("event_timestamp")
    texts = F.struct(
        notices.subject(name, device).alias("subject"),
        notices.body(name, device, F.col("measurement_item_name"), event).alias("body"),
        notices.detail_json().alias("alert_detail_json"),
    )
    # Unpacked from a one-element array, so that the join with recipients above does not write the
    # texts anew for each of them.
    return wanted.join(named, "alert_conditions_measurement_item_id", "left").select(
        "device_id", "organization_id", "alert_id", "event_timestamp", F.inline(F.array(texts))
    )


def active_recipients(recipients: DataFrame) -> DataFrame:
    return recipients.filter(F.col("is_active")).select(
        "organization_id", F.col("email_address").alias("recipient_email")
    )


@dataclass(frozen=True)
class Spread:
    """Tasks that queue rows are written in, and parts that the firings of an organization are cut into."""

    tasks: int
    ways: int


def spread_of(fired: DataFrame, recipients: DataFrame) -> Spread | None:
    """As many tasks as the queue rows need, counted from firings and recipients per organization.

    Few firings make many rows, by which no shuffle is cut: its parts are measured before the join. None
    if one task will do.
    """
    firings = with_mail(fired).groupBy("organization_id").agg(F.count("*").alias("firings"))
    active = active_recipients(recipients).groupBy("organization_id").agg(F.count("*").alias("recipients"))
    expected = F.sum(F.col("firings") * F.col("recipients")).alias("rows")
    counted = firings.join(active, "organization_id").agg(expected, F.count("*").alias("organizations")).first()
    tasks = -(-(counted.rows or 0) // MAIL_ROWS)
    return Spread(tasks, -(-4 * tasks // counted.organizations)) if tasks > 1 else None


def to_recipients(mail: DataFrame, recipients: DataFrame, spread: Spread | None = None) -> DataFrame:
    """Rows of an organization, each times every active recipient of it."""
    active = active_recipients(recipients)
    if spread is None:
        return mail.join(active, "organization_id")
    salt = F.pmod(F.xxhash64("device_id", "alert_id", "event_timestamp"), F.lit(spread.ways)).cast("int")
    dealt = mail.withColumn("salt", salt).repartition(spread.tasks, "organization_id", "salt")
    copies = active.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread.ways - 1))))
    return dealt.join(copies, ["organization_id", "salt"]).drop("salt")


def mail_rows(
    fired: DataFrame, recipients: DataFrame, items: DataFrame, batch_time: Column, spread: Spread | None = None
) -> DataFrame:
    """Queue rows: every mail-enabled firing times every active recipient of its organization."""
    return to_recipients(mails(fired, items), recipients, spread).select(
        "device_id",
        "organization_id",
        "alert_id",
        "recipient_email",
        "subject",
        "body",
        "alert_detail_json",
        F.lit(notices.QUEUE_STATUS).alias("status"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("error_message"),
        "event_timestamp",
        batch_time.alias("queued_time"),
        F.lit(None).cast("timestamp").alias("processed_time"),
        batch_time.alias("create_time"),
        batch_time.alias("update_time"),
    )


def status_rows(fired: DataFrame, status: DataFrame, batch_time: Column) -> DataFrame:
    """New status row of every device with a firing: latest times, count added to the stored one."""
    counted = fired.groupBy("device_id").agg(
        F.max("event_timestamp").alias("new_time"), F.count("*").alias("new_count")
    )
    return counted.join(status.select("device_id", "alert_count"), "device_id", "left").select(
        "device_id",
        F.lit("ALERT").alias("latest_status"),
        F.col("new_time").alias("latest_event_timestamp"),
        (F.coalesce("alert_count", F.lit(0)) + F.col("new_count")).alias("alert_count"),
        F.col("new_time").alias("last_alert_timestamp"),
        batch_time.alias("updated_at"),
    )


class BatchChanges:
    """Change sets of a batch judged as a whole against the state before it.

    Each set is built when asked for. `hold` may keep the frames several sets share.
    """

    def __init__(
        self,
        with_state: DataFrame,
        state: DataFrame,
        batch_time: Column,
        null_policy: str = "keep",
        seq: str = "event_id",
        hot: DataFrame | None = None,
        hold: Hold = no_hold,
    ):
        self._with_state, self._hot = with_state, hot
        self._state, self._batch_time = state, batch_time
        self._rows = considered(with_state, null_policy)
        self._keys = hold(per_alert(self._rows, seq))

    @cached_property
    def firings(self) -> DataFrame:
        return firings(self._keys)

    @cached_property
    def state(self) -> DataFrame:
        return changed_state(self._keys, self._state, self._batch_time)

    @cached_property
    def recoveries(self) -> DataFrame:
        return recoveries(self._rows, self._keys, self._hot)

    @cached_property
    def history(self) -> DataFrame:
        """Opening and closing rows of the firing history."""
        opened = history_rows(self.firings, self._batch_time)
        return opened.unionByName(closing_rows(self.recoveries, self._batch_time))

    @cached_property
    def late_rows(self) -> DataFrame:
        return self._with_state.filter(F.col("alert_id").isNotNull() & is_late())
