"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coldtrace.functions import frames, payload
from coldtrace.operators import alerts, changes, correlate, enrich, numbering, parse, replay
from coldtrace.operators.hot import hot_keys
from coldtrace.plans import catchup, runs, sketches, traffic, validation, verdicts
from coldtrace.schemas import SENSORS
from coldtrace.session import DROP_SHUFFLES, materialise, scratch_root, settings
from coldtrace.sources import documents, generator, loadtest, messages
from coldtrace.streaming import monitor
from coldtrace.streaming.pipeline import Masters, Pipeline
from coldtrace.streaming.correlation import CorrelationStream
from coldtrace.streaming.episodes import EpisodeStream
from coldtrace.streaming.minutes import MinuteStream
from coldtrace.streaming.tables import current_history
from workload.views import AS_OF, BATCH_TIME, OUTAGE_TO, POLL_PARTITIONS, Views, plain_times, week_of

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

STEADY_FROM, STEADY_TO = "2024-01-10", "2024-01-20"


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    _REGISTRY[build.__name__] = lambda spark, sf_dir: plain_times(build(Views(spark, sf_dir)))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _now():
    return F.lit(BATCH_TIME).cast("timestamp")


def _decoded(v: Views) -> DataFrame:
    return parse.decode(v.raw_messages, time_unit="us")


def _enriched(v: Views) -> DataFrame:
    return enrich.enrich(v.telemetry, v.device_master, v.organization_master)


def _judged(v: Views, how: str = "left") -> DataFrame:
    return alerts.evaluate(_enriched(v), alerts.active_rules(v.alert_setting), how=how)


def _with_state(v: Views) -> DataFrame:
    return alerts.with_state(_judged(v, "inner"), v.state0)


def _changes(v: Views) -> changes.BatchChanges:
    return changes.BatchChanges(_with_state(v), v.state0, _now())


# -- messages and parsing ----------------------------------------------------------------------


@query
def q_extract_device(v: Views) -> DataFrame:
    return _decoded(v).select(F.col("offset").alias("event_id"), "device_id")


@query
def q_json_path(v: Views) -> DataFrame:
    fields = {"json_id": "$.device_id", "json_time": "$.event_timestamp", "json_temp": "$.external_temp"}
    return v.raw_messages.select(
        F.col("offset").alias("event_id"),
        *[payload.json_path(F.col("value"), path).alias(name) for name, path in fields.items()],
    ).select(
        "event_id",
        F.col("json_id").try_cast("int").alias("json_id"),
        payload.event_time(F.col("json_time")).alias("json_time"),
        F.col("json_temp").try_cast("double").alias("json_temp"),
    )


@query
def q_parse(v: Views) -> DataFrame:
    return parse.accepted(_decoded(v)).select(
        F.col("offset").alias("event_id"), "device_id", "event_timestamp", *SENSORS
    )


@query
def q_funnel(v: Views) -> DataFrame:
    return parse.funnel(_decoded(v))


@query
def q_quarantine(v: Views) -> DataFrame:
    return parse.quarantine(_decoded(v)).select(
        F.col("offset").alias("event_id"), "device_id", "reason"
    )


@query
def q_payload_sample(v: Views) -> DataFrame:
    return parse.payload_sample(_decoded(v)).select("topic", "message_key", F.col("offset").alias("event_id"))


@query
def q_canonical_json(v: Views) -> DataFrame:
    """Device ids as the column, the canonical text and the variant hold them."""
    rows = parse.accepted(parse.decode(v.odd_messages, binary=False))
    text, document = F.col("raw_json"), F.col("document")
    names = F.map_keys(F.from_json(text, "map<string,variant>"))
    temperature = payload.variant_double(document, "external_temp")
    return rows.select(
        F.col("offset").alias("event_id"),
        "device_id",
        F.get_json_object(text, "$.device_id").try_cast("int").alias("text_id"),
        F.size(F.filter(names, lambda name: name == "device_id")).alias("id_fields"),
        F.try_variant_get(document, "$.device_id", "int").alias("variant_id"),
        F.coalesce(F.isnan(temperature), F.lit(False)).alias("is_nan"),
        F.when(~F.isnan(temperature), temperature).alias("temperature"),
        F.try_variant_get(document, "$.meta.device_id", "int").alias("nested_id"),
        F.try_variant_get(document, "$.note", "string").alias("note"),
        (F.try_parse_json(text).isNotNull() & document.isNotNull()).alias("is_valid"),
    )


@query
def q_variant(v: Views) -> DataFrame:
    rows = parse.accepted(_decoded(v)).select(
        F.col("offset").alias("event_id"), F.col("document").alias("doc")
    )
    return rows.select(
        "event_id",
        F.try_variant_get("doc", "$.device_id", "int").alias("device_id"),
        *[payload.variant_double(F.col("doc"), name).alias(name) for name in SENSORS],
    )


@query
def q_binary_decode(v: Views) -> DataFrame:
    told = payload.envelope_device(F.col("topic"), F.col("message_key"))
    record = payload.decode_binary(F.col("value"), told)
    rows = parse.select_message(v.raw_messages).select("offset", record.alias("record")).filter("record IS NOT NULL")
    return rows.select(
        F.col("offset").alias("event_id"),
        "record.device_id",
        payload.epoch_to_timestamp(F.col("record.event_time"), "us").alias("event_timestamp"),
        *[f"record.{name}" for name in SENSORS],
    )


@query
def q_bronze(v: Views) -> DataFrame:
    """Raw archive written and read back for an arrival window."""
    path = f"{scratch_root(v.spark)}/bronze-{uuid.uuid4().hex}"
    messages.write_archive(v.raw_messages, path, layout=("date",))
    rows = messages.read_archive(v.spark, path, "2024-01-10 06:00:00", "2024-01-20 18:00:00")
    return rows.select(F.col("offset").alias("event_id"), "partition", "topic", "timestamp")


# -- enrichment --------------------------------------------------------------------------------


@query
def q_enrich(v: Views) -> DataFrame:
    return _enriched(v).select("event_id", "device_id", "organization_id", "device_name")


@query
def q_unknown_devices(v: Views) -> DataFrame:
    return enrich.unknown_devices(v.telemetry, v.device_master, v.organization_master)


@query
def q_coverage(v: Views) -> DataFrame:
    return enrich.silent_devices(v.telemetry, v.device_master).select("device_id", "device_name")


@query
def q_silver(v: Views) -> DataFrame:
    return _enriched(v).select(
        "device_id",
        "organization_id",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        *SENSORS,
    )


# -- alert judgement ---------------------------------------------------------------------------


@query
def q_threshold(v: Views) -> DataFrame:
    return _judged(v).select(
        "event_id",
        "device_id",
        "alert_id",
        "alert_conditions_measurement_item_id",
        "current_sensor_value",
        "threshold_exceeded",
    )


@query
def q_threshold_null(v: Views) -> DataFrame:
    outcome = F.coalesce(F.col("threshold_exceeded").cast("string"), F.lit("unknown"))
    operator = F.coalesce("alert_conditions_operator", F.lit("none"))
    return _judged(v).groupBy(operator.alias("operator"), outcome.alias("outcome")).agg(
        F.count("*").alias("rows")
    )


@query
def q_duration(v: Views) -> DataFrame:
    return _with_state(v).filter("alert_triggered").select(
        "event_id", "device_id", "alert_id", "event_timestamp", "abnormal_start_time", "current_sensor_value"
    )


@query
def q_latest_per_alert(v: Views) -> DataFrame:
    return alerts.latest_per_alert(_with_state(v)).select(
        "device_id", "alert_id", "event_timestamp", "event_id", "threshold_exceeded", "alert_triggered"
    )


@query
def q_update_pattern(v: Views) -> DataFrame:
    rows = changes.per_alert(changes.considered(_with_state(v)))
    return rows.select(
        "device_id", "alert_id", F.col("newest.event_timestamp").alias("event_timestamp"), "pattern"
    )


@query
def q_update_pattern_reset(v: Views) -> DataFrame:
    rows = changes.per_alert(changes.considered(_with_state(v), "reset"))
    return rows.groupBy("pattern").agg(F.count("*").alias("alerts"))


@query
def q_state_merge(v: Views) -> DataFrame:
    merged = changes.merged_state(v.state0, _changes(v).state)
    return merged.select(
        "device_id",
        "alert_id",
        "abnormal_start_time",
        "last_event_time",
        "last_sensor_value",
        "alert_fired_time",
        F.col("alert_history_id").isNotNull().alias("has_history"),
        "create_time",
        "update_time",
    )


@query
def q_alert_history(v: Views) -> DataFrame:
    return _changes(v).firings.select(
        "device_id",
        "alert_id",
        F.col("abnormal_start_time").alias("alert_occurrence_datetime"),
        F.col("event_timestamp").alias("fired_event_time"),
        "alert_value",
    )


@query
def q_alert_recovery(v: Views) -> DataFrame:
    return _changes(v).recoveries.select(
        "device_id", "alert_id", "recovered_event_time"
    )


@query
def q_mail_queue(v: Views) -> DataFrame:
    rows = changes.mail_rows(_changes(v).firings, v.mail_setting, v.measurement_item, _now())
    return rows.drop("alert_detail_json", "error_message", "processed_time")


@query
def q_mail_detail(v: Views) -> DataFrame:
    """The fields of the detail text of every queued mail, read once per firing."""
    mail = changes.mails(_changes(v).firings, v.measurement_item)
    text = lambda name: F.get_json_object("alert_detail_json", f"$.{name}")
    numbers = ("alert_id", "measurement_item_id", "alert_level_id", "device_id")
    fields = F.struct(
        text("organization_id").cast("int").alias("told_organization"),
        *[text(name).cast("int").alias(name) for name in numbers],
        *[text(name).alias(name) for name in ("alert_name", "measurement_item_name", "operator")],
        text("threshold").cast("double").alias("threshold"),
        F.try_to_timestamp(text("detected_at")).alias("detected_at"),
    )
    told = mail.select("organization_id", F.inline(F.array(fields)))
    return changes.to_recipients(told, v.mail_setting).select(
        "recipient_email",
        "alert_id",
        "measurement_item_id",
        "alert_level_id",
        "device_id",
        F.col("told_organization").alias("organization_id"),
        "alert_name",
        "measurement_item_name",
        "operator",
        "threshold",
        "detected_at",
    )


@query
def q_history_identity(v: Views) -> DataFrame:
    """The lasting names of firings, and whether each has a key of its own."""
    fired = _changes(v).firings
    keys = fired.groupBy("alert_history_id").agg(F.count("*").alias("n"))
    return fired.join(keys, "alert_history_id").select(
        "device_id", "alert_id", "alert_history_uuid", (F.col("n") == 1).alias("own_key")
    )


@query
def q_device_status(v: Views) -> DataFrame:
    stored = v.device_master.filter("device_id % 5 = 0").select(
        "device_id", F.lit(3).cast("long").alias("alert_count")
    )
    return changes.status_rows(_changes(v).firings, stored, _now())


# -- replay ------------------------------------------------------------------------------------


def _replayed(v: Views) -> DataFrame:
    hot = hot_keys(v.telemetry, ["device_id"])
    rules = alerts.active_rules(v.alert_setting)
    return replay.replay(alerts.evaluate(_enriched(v), rules, hot=hot, how="inner"), hot=hot)


@query
def q_replay_history(v: Views) -> DataFrame:
    return _replayed(v)


@query
def q_replay_recovery(v: Views) -> DataFrame:
    return _replayed(v).filter("recovered_event_time IS NOT NULL").select(
        "device_id",
        "alert_id",
        "recovered_event_time",
        (
            F.unix_seconds("recovered_event_time") - F.unix_seconds("fired_event_time")
        ).alias("seconds_open"),
    )


@query
def q_replay_sliced(v: Views) -> DataFrame:
    """The replay with every device treated as oversized: judged in ordered slices."""
    hot = v.telemetry.select("device_id").distinct()
    return replay.replay(_judged(v, "inner"), hot=hot, slices=16)


def _in_quarters(v: Views) -> list[DataFrame]:
    """Judged rows in four batches by time; the first and the last one are open."""
    rows = _judged(v, "inner")
    ends = v.telemetry.agg(
        F.unix_micros(F.min("event_timestamp")).alias("a"), F.unix_micros(F.max("event_timestamp")).alias("b")
    ).first()
    micros = F.unix_micros("event_timestamp")
    if ends.a is None:
        return [rows]
    cuts = [ends.a + (ends.b - ends.a) * k // 4 for k in (1, 2, 3)]
    return [
        rows.filter(micros < cuts[0]),
        rows.filter((micros >= cuts[0]) & (micros < cuts[1])),
        rows.filter((micros >= cuts[1]) & (micros < cuts[2])),
        rows.filter(micros >= cuts[2]),
    ]


def _replay_in_batches(batches: list[DataFrame], hot: DataFrame | None, slices: int | None) -> DataFrame:
    """Episodes of batches that each carry on from the state the one before left.

    A judged batch is written once, for its episodes and for its state.
    """
    state, found = None, None
    for batch in batches:
        judged = materialise(replay.judge_in_order(replay.replay_rows(batch, carried=state), hot, slices))
        episodes = replay.episodes(judged)
        found = episodes if found is None else found.unionByName(episodes)
        closing = replay.closing_state(judged)
        if state is not None:
            kept = state.join(closing, replay.KEY, "left_anti")
            closing = closing.unionByName(kept)
        state = materialise(closing)
    # A recovery whose firing lies in an earlier batch meets it here.
    return found.groupBy(*replay.KEY, "abnormal_start_time").agg(
        F.max("fired_event_time").alias("fired_event_time"),
        F.max("alert_value").alias("alert_value"),
        F.max("recovered_event_time").alias("recovered_event_time"),
    )


@query
def q_replay_incremental(v: Views) -> DataFrame:
    """The replay in four batches."""
    return _replay_in_batches(_in_quarters(v), hot_keys(v.telemetry, ["device_id"]), None)


@query
def q_replay_carried_sliced(v: Views) -> DataFrame:
    """Four batches, every rule lengthened after the second one, all devices cut into slices.

    Episodes that have fired stay fired; those that have not need the longer time.
    """
    batches = _in_quarters(v)
    later = [b.withColumn("judgment_time", F.col("judgment_time") * 2 + 60) for b in batches[2:]]
    hot = v.telemetry.select("device_id").distinct()
    return _replay_in_batches([*batches[:2], *later], hot, 8)


# -- validation --------------------------------------------------------------------------------


@query
def q_total(v: Views) -> DataFrame:
    return validation.total(v.telemetry)


@query
def q_per_device(v: Views) -> DataFrame:
    return validation.per_device(v.telemetry)


@query
def q_minute_throughput(v: Views) -> DataFrame:
    return validation.per_minute(v.telemetry)


@query
def q_distinct_devices(v: Views) -> DataFrame:
    return validation.distinct_devices(validation.recent(v.telemetry, AS_OF, 1440))


@query
def q_distinct_devices_approx(v: Views) -> DataFrame:
    """Exact count, and whether the sketch comes within three times its standard error of 5 %."""
    about = validation.distinct_devices(v.telemetry, approximate=True).scalar()
    exact = validation.distinct_devices(v.telemetry)
    return exact.withColumn("within_bound", F.abs(about - F.col("devices")) <= 0.15 * F.col("devices"))


@query
def q_window_closed(v: Views) -> DataFrame:
    rows = validation.within(v.telemetry, STEADY_FROM, STEADY_TO)
    return rows.select("event_id", "device_id", "event_timestamp")


@query
def q_ingest_lag(v: Views) -> DataFrame:
    return validation.ingest_lag(v.stored)


@query
def q_staleness(v: Views) -> DataFrame:
    return validation.staleness(v.stored, AS_OF, 600)


@query
def q_workers_per_minute(v: Views) -> DataFrame:
    nodes = v.events.select(
        (F.col("event_id") % 7).alias("instance_id"), F.col("ts").alias("start_time")
    )
    return validation.workers_per_minute(nodes)


@query
def q_latest_rows(v: Views) -> DataFrame:
    return validation.latest_rows(v.telemetry, 50).select(
        "event_id", "device_id", "event_timestamp", *SENSORS
    )


@query
def q_busiest_devices(v: Views) -> DataFrame:
    return validation.busiest_devices(v.telemetry, 20)


@query
def q_current_status(v: Views) -> DataFrame:
    return validation.current_per_device(v.telemetry, list(SENSORS))


@query
def q_latest_per_key(v: Views) -> DataFrame:
    return _judged(v, "inner").groupBy("device_id", "alert_id").agg(
        F.max("event_timestamp").alias("latest")
    )


@query
def q_count_check(v: Views) -> DataFrame:
    return validation.count_check(v.mirror, v.telemetry)


@query
def q_reconcile(v: Views) -> DataFrame:
    return validation.reconcile(v.telemetry, v.mirror, ["event_id"])


@query
def q_reconcile_counts(v: Views) -> DataFrame:
    return validation.reconcile_counts(v.telemetry, v.mirror)


@query
def q_reconcile_buckets(v: Views) -> DataFrame:
    """Rows that differ between the stores, found through digests of their buckets."""
    return validation.reconcile_buckets(
        v.readings, v.altered, ["event_id"], ["device_id", "external_temp"]
    )


@query
def q_distinct_windows(v: Views) -> DataFrame:
    """Devices in windows of three lengths from stored minute sketches, held against the exact count."""
    minutes = materialise(sketches.per_minute(v.telemetry))
    found = None
    for window in ("10 minutes", "1 hour", "1 day"):
        begin = F.window("event_timestamp", window)["start"]
        exact = v.telemetry.groupBy(begin.alias("window_start")).agg(F.countDistinct("device_id").alias("devices"))
        both = sketches.per_window(minutes, window).join(exact, "window_start").select(
            F.lit(window).alias("window"), "window_start", "records", "devices",
            sketches.within(F.col("about"), F.col("devices")).alias("within_bound"),
        )
        found = both if found is None else found.unionByName(both)
    return found


@query
def q_variant_stored(v: Views) -> DataFrame:
    """All sensors read back from the stored documents."""
    path = f"{scratch_root(v.spark)}/documents-{uuid.uuid4().hex}"
    rows = parse.accepted(_decoded(v)).select(
        F.col("offset").alias("event_id"), F.to_date("event_timestamp").alias("event_date"), "document"
    )
    documents.write(rows, path, ["event_date"])
    return documents.read(v.spark, path, rows.schema, "document", SENSORS).drop("event_date")


@query
def q_catch_up(v: Views) -> DataFrame:
    """What waits in each partition at the end of every hour."""
    return catchup.backlog(v.hourly_flow)


@query
def q_catch_up_time(v: Views) -> DataFrame:
    """Highest backlog of each partition, and the minutes it takes to work it off after the outage."""
    return catchup.drained(catchup.backlog(v.hourly_flow), F.lit(OUTAGE_TO).cast("timestamp"))


# -- load runs ---------------------------------------------------------------------------------


@query
def q_request_stats(v: Views) -> DataFrame:
    return traffic.request_stats(v.requests)


@query
def q_request_total(v: Views) -> DataFrame:
    return traffic.request_stats(v.requests, with_total=True)


@query
def q_percentiles_approx(v: Views) -> DataFrame:
    """Per group whether every sketched percentile stands within the sketch's error of its rank."""
    sketched = traffic.approximate_percentiles(v.requests)
    points = F.array(
        *[F.struct(F.lit(p).alias("p"), F.col(name).alias("at")) for name, p in traffic.PERCENTILES.items()]
    )
    asked = sketched.select("type", "name", F.explode(points).alias("x")).select("type", "name", "x.*")
    times = v.requests.groupBy("type", "name", "response_time").agg(F.count("*").alias("n"))
    ranks = asked.join(times, ["type", "name"]).groupBy("type", "name", "p", "at").agg(
        F.sum("n").alias("requests"),
        F.sum(F.when(F.col("response_time") < F.col("at"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("response_time") <= F.col("at"), F.col("n")).otherwise(0)).alias("upto"),
    )
    rank, slack = F.col("p") * F.col("requests"), 1 + F.col("requests") / 10000
    good = (F.col("below") <= rank + slack) & (F.col("upto") >= rank - slack)
    return ranks.groupBy("type", "name").agg(
        F.max("requests").alias("requests"), F.min(good).alias("within_bound")
    )


@query
def q_failures(v: Views) -> DataFrame:
    return traffic.failures(v.requests)


@query
def q_exceptions(v: Views) -> DataFrame:
    return traffic.exceptions(v.raised)


@query
def q_seq_delta(v: Views) -> DataFrame:
    return traffic.new_arrivals(v.polls)


@query
def q_stats_file(v: Views) -> DataFrame:
    """Statistics saved as a load-test file and read back with their file time."""
    stats = traffic.request_stats(v.requests).drop("failure_rate")
    rows = loadtest.request_files(v.spark, _saved(v, stats))
    return rows.select("type", "name", "request_count", "failure_count", "median_response_time", "p99_9")


def _saved(v: Views, rows: DataFrame) -> str:
    path = f"{scratch_root(v.spark)}/files-{uuid.uuid4().hex}"
    rows.write.option("header", True).option("escape", '"').csv(path)
    return path


@query
def q_failure_files(v: Views) -> DataFrame:
    """Failures saved as load-test files and read back."""
    found = loadtest.failure_files(v.spark, _saved(v, traffic.failures(v.requests)))
    return found.select("method", "name", "error", "occurrences")


@query
def q_exception_files(v: Views) -> DataFrame:
    columns = ("count", "message", "traceback", "nodes")
    found = loadtest.exception_files(v.spark, _saved(v, traffic.exceptions(v.raised).select(*columns)))
    return found.select(*columns)


@query
def q_device_list(v: Views) -> DataFrame:
    path = f"{scratch_root(v.spark)}/devices-{uuid.uuid4().hex}"
    v.device_master.select("device_name", "device_id", F.lit("-").alias("primary_key")).write.option(
        "header", True
    ).csv(path)
    return loadtest.device_list(v.spark, path, 100, 700)


@query
def q_steady(v: Views) -> DataFrame:
    start, end = F.lit(STEADY_FROM).cast("timestamp"), F.lit(STEADY_TO).cast("timestamp")
    series = validation.per_minute(v.telemetry)
    fleet = v.telemetry.agg(F.countDistinct("device_id")).scalar()
    return runs.steady_rate(series, start, end, fleet, F.lit(38880))


@query
def q_phase(v: Views) -> DataFrame:
    target = v.minutes.agg(F.avg("records")).scalar()
    return runs.phases(v.minutes, target)


@query
def q_phase_summary(v: Views) -> DataFrame:
    target = v.minutes.agg(F.avg("records")).scalar()
    return runs.phase_summary(runs.phases(v.minutes, target))


@query
def q_sent_vs_stored(v: Views) -> DataFrame:
    return runs.sent_against_stored(v.telemetry, v.mirror, ["device_id"])


@query
def q_run_change(v: Views) -> DataFrame:
    return runs.run_change(v.runs, ["sent", "devices", "errors"])


@query
def q_ratio(v: Views) -> DataFrame:
    rows = v.events.withColumn("run", week_of("ts"))
    throttled = (F.col("event_type") == "error").cast("long")
    return runs.ratio_of_sums(rows, ["run"], throttled, F.lit(1))


@query
def q_run_summary(v: Views) -> DataFrame:
    day = v.events.groupBy(
        week_of("ts").alias("run"), F.to_date("ts").alias("day")
    ).agg(
        F.countDistinct("user_id").alias("connected"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    return runs.run_summary(day)


def _measured(v: Views) -> DataFrame:
    """Metrics of the checks, all measured over the tables.

    The first store is `stored`, the second one its rows that `mirror` holds. How long a batch takes
    is told by a running stream only (`q_stream_checks`).
    """
    lag = F.unix_seconds("create_time") - F.unix_seconds("event_timestamp")
    stored = v.stored.agg(
        F.avg(lag).alias("avg_lag_sec"),
        (F.countDistinct("device_id") / F.lit(v.device_master.agg(F.count("*")).scalar())).alias(
            "device_coverage"
        ),
    )
    second = v.stored.join(v.mirror.select("event_id"), "event_id", "left_semi").agg(
        F.avg(lag).alias("avg_lag_sec_oltp")
    )
    minutes = validation.per_minute(v.telemetry).agg(F.avg("records").alias("records_per_minute"))
    stages = parse.funnel(_decoded(v)).agg(F.max("rows").alias("raw"), F.min("rows").alias("kept"))
    rejected = stages.select(((F.col("raw") - F.col("kept")) / F.col("raw")).alias("error_rate"))
    newest = v.polls.groupBy("partition").agg(F.max("last_sequence").alias("sent"))
    read = (
        v.telemetry.join(v.mirror.select("event_id"), "event_id", "left_semi")
        .groupBy((F.col("device_id") % POLL_PARTITIONS).cast("int").alias("partition"))
        .agg(F.max("event_id").alias("stored"))
    )
    behind = newest.join(read, "partition", "left").agg(
        F.sum(F.col("sent") - F.coalesce("stored", F.lit(0))).cast("double").alias("consumer_lag")
    )
    share = lambda test: F.count_if(test) / F.count("*")
    requests = v.requests.agg(
        share(F.col("exception").isNotNull()).alias("failure_rate"),
        share(F.col("type") == "error").alias("throttled_ratio"),
    )
    start, end = F.lit(STEADY_FROM).cast("timestamp"), F.lit(STEADY_TO).cast("timestamp")
    fleet = v.telemetry.agg(F.countDistinct("device_id")).scalar()
    steady = runs.steady_rate(validation.per_minute(v.telemetry), start, end, fleet, F.lit(38880)).select(
        F.abs("deviation_pct").alias("rate_deviation_pct")
    )
    total = traffic.request_stats(v.requests, with_total=True).filter("name = 'Aggregated'")
    sending = total.select(
        F.col("median_response_time").alias("send_median_ms"), F.col("p95").alias("send_p95_ms")
    )
    known = v.telemetry.join(v.device_master, "device_id", "left_semi").agg(
        (F.countDistinct("device_id") / F.lit(v.device_master.agg(F.count("*")).scalar())).alias("devices_started")
    )
    polled = v.polls.agg(share(F.col("last_sequence").isNull()).alias("poll_failure_rate"))
    failed = traffic.failures(v.requests).agg(F.count("*").cast("double").alias("failure_rows"))
    arrived = traffic.new_arrivals(v.polls).agg(F.sum("new_messages").cast("double").alias("new_messages"))
    sent, kept = (t.agg(F.count("*")).scalar() for t in (v.telemetry, v.mirror))
    both = v.spark.range(1).select(
        (F.abs(kept / sent - 1) * 100).alias("in_out_deviation_pct"),
        sent.cast("double").alias("stored_rows"),
        kept.cast("double").alias("stored_rows_oltp"),
    )
    archive = v.stored.select(F.col("create_time").alias("timestamp"))
    gap = validation.largest_gap_minutes(archive).select(F.col("gap_minutes").alias("archive_gap_minutes"))
    fresh = v.stored.agg(
        (F.max(lag) / 60).alias("archive_delay_minutes"),
        (F.unix_seconds(F.max("create_time")) - F.unix_seconds(F.max("event_timestamp")))
        .cast("double")
        .alias("freshness_sec"),
    )
    frames_ = (stored, second, minutes, rejected, behind, requests, steady, sending, known, polled, failed, arrived, both, gap, fresh)
    parts = [part.unpivot([], part.columns, "metric", "value") for part in frames_]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def q_checks(v: Views) -> DataFrame:
    return verdicts.judge(_measured(v), verdicts.checks(v.spark))


@query
def q_verdict_rollup(v: Views) -> DataFrame:
    return verdicts.roll_up(verdicts.judge(_measured(v), verdicts.checks(v.spark)))


@query
def q_stream_checks(v: Views) -> DataFrame:
    """The checks that only a running stream can measure: which were measured, and which passed.

    Times of this machine are no results to compare, so a pass is shown for the other checks only.
    """
    pipeline, running = run_stream(v, "batch")
    measured = monitor.measures(monitor.recent_progress(running)).filter("metric = 'batch_seconds'")
    failed = pipeline.audit.read(v.spark).agg(
        (F.count_if(~F.col("ok")) / F.count("*")).alias("failure_rate")
    )
    both = measured.unionByName(failed.unpivot([], failed.columns, "metric", "value"))
    judged = verdicts.judge(both, verdicts.checks(v.spark)).join(both.select("metric"), "metric", "left_semi")
    timed = F.col("metric") == "batch_seconds"
    return judged.select(
        "check_id", "metric", (F.col("value") >= 0).alias("measured"),
        F.when(~timed, F.col("verdict")).alias("verdict"),
    )


@query
def q_frames(v: Views) -> DataFrame:
    text = F.col("payload")
    return v.frames.select(
        "event_id",
        frames.message_type(text).alias("msg_type"),
        frames.message_id(text).alias("msg_id"),
        frames.status(text).alias("status"),
    )


@query
def q_correlate(v: Views) -> DataFrame:
    hot = hot_keys(v.messages, correlate.KEY)
    return correlate.correlate(v.messages, hot=hot)


@query
def q_correlate_sliced(v: Views) -> DataFrame:
    """The correlation with every key treated as oversized."""
    hot = v.messages.select(*correlate.KEY).distinct()
    return correlate.correlate(v.messages, hot=hot, slices=16)


@query
def q_response_times(v: Views) -> DataFrame:
    found = correlate.correlate(v.messages, hot=hot_keys(v.messages, correlate.KEY))
    return found.groupBy("client", "result").agg(
        F.count("*").alias("n"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.sum("latency_ms").alias("sum_ms"),
    )


# -- devices and generated data ----------------------------------------------------------------


def _fleet(v: Views) -> DataFrame:
    last = v.table("customer").agg(F.max("c_custkey")).first()[0]
    template = v.device_master.filter("device_id = 1").select(
        F.lit("model").alias("device_model"),
        "organization_id",
        F.lit(1).alias("device_type_id"),
        F.lit(1).alias("device_stock_id"),
        F.lit(0).alias("creator"),
        F.lit(0).alias("modifier"),
    )
    return generator.devices(v.spark, 3, int(last), template, _now())


@query
def q_device_dim(v: Views) -> DataFrame:
    return generator.with_new_structure(_fleet(v)).drop("device_uuid")


@query
def q_prefix(v: Views) -> DataFrame:
    both = _fleet(v).select("device_id", "device_name").unionAll(
        v.device_master.select("device_id", "device_name")
    )
    return generator.with_prefix(both).agg(F.count("*").alias("devices"))


@query
def q_prefix_cleanup(v: Views) -> DataFrame:
    both = _fleet(v).select("device_id", "device_name").unionAll(
        v.device_master.select("device_id", "device_name")
    )
    return generator.without_prefix(both)


@query
def q_buckets(v: Views) -> DataFrame:
    numbered = numbering.number_rows(v.device_master.select("device_id"), "device_id", block=1000)
    return numbering.share_out(numbered, 16)


@query
def q_fixed_ranges(v: Views) -> DataFrame:
    worker = numbering.fixed_range(F.col("device_id"), 130)
    return v.device_master.groupBy(worker.alias("worker")).agg(
        F.count("*").alias("devices"),
        F.min("device_id").alias("first_device"),
        F.max("device_id").alias("last_device"),
    )


@query
def q_generate(v: Views) -> DataFrame:
    start = F.lit("2024-03-01").cast("timestamp")
    return generator.telemetry(v.device_master, start, ticks=4)


@query
def q_generate_messages(v: Views) -> DataFrame:
    start = F.lit("2024-03-01").cast("timestamp")
    made = generator.as_messages(generator.telemetry(v.device_master, start, ticks=2))
    return parse.accepted(parse.decode(made, binary=False)).groupBy("device_id").agg(
        F.count("*").alias("messages"),
        F.min(F.length("raw_json")).alias("min_bytes"),
        F.max(F.length("raw_json")).alias("max_bytes"),
    )


# -- streaming ---------------------------------------------------------------------------------


def masters_of(v: Views) -> Masters:
    return Masters(
        devices=lambda: v.device_master,
        organizations=lambda: v.organization_master,
        alert_settings=lambda: v.alert_setting,
        mail_settings=lambda: v.mail_setting,
        measurement_items=lambda: v.measurement_item,
    )


def land_in_order(
    rows: DataFrame, order: str, path: str, parts: int, files: int = 4,
    make: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows written in `parts` parts along `order`, each as `files` files; returns the stream of them.

    The stream takes one part at a time. Rows without an order come with the first part. With `make`,
    the rows are those of a table, and what is written is made from each part of them.
    """
    spark = rows.sparkSession
    arrived = materialise(rows) if make is None else rows
    shares = [n / parts for n in range(1, parts)]
    number = F.col(order).cast("double")
    cuts = arrived.agg(F.percentile_approx(number, shares, 10000)).first()[0] or []
    lower = None
    for upper in [*cuts, None]:
        part = arrived
        part = part if lower is None else part.filter(number > lower)
        if upper is not None:
            first = number.isNull() if lower is None else F.lit(False)
            part = part.filter((number <= upper) | first)
        _land(part, path, files, make)
        lower = upper
    schema = arrived.schema if make is None else make(arrived).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def _land(
    part: DataFrame, path: str, files: int = 4, make: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Rows, or what is made of them, written as `files` files: dealt out while they are narrow."""
    dealt = part.repartition(files)
    with settings(part.sparkSession, {DROP_SHUFFLES: "true"}):
        (dealt if make is None else make(dealt)).write.mode("append").parquet(path, compression="zstd")


def land_messages(v: Views, path: str, parts: int) -> DataFrame:
    return land_in_order(v.events, "event_id", path, parts, make=v.messages_of)


def new_pipeline(v: Views, mode: str) -> Pipeline:
    return Pipeline(
        v.spark,
        f"{scratch_root(v.spark)}/stream-{uuid.uuid4().hex}",
        masters_of(v),
        mode=mode,
        time_unit="us",  # of the test messages' binary times
    )


def run_stream(v: Views, mode: str, parts: int = 3) -> tuple[Pipeline, StreamingQuery]:
    """Telemetry messages landed part by part in order and streamed through the pipeline."""
    pipeline = new_pipeline(v, mode)
    stream = land_messages(v, f"{pipeline.root}/landing", parts)
    running = pipeline.start(stream, f"{pipeline.root}/checkpoint", interval=None)
    running.awaitTermination()
    return pipeline, running


@query
def q_stream_silver(v: Views) -> DataFrame:
    pipeline, _ = run_stream(v, "batch")
    return pipeline.silver.read(v.spark).select(
        "device_id", "organization_id", "event_timestamp", "event_date", *SENSORS
    )


@query
def q_stream_alerts(v: Views) -> DataFrame:
    pipeline, _ = run_stream(v, "replay")
    return _streamed_history(pipeline, v)


def _streamed_history(pipeline: Pipeline, v: Views) -> DataFrame:
    history = current_history(pipeline.history.read(v.spark))
    return history.select(
        "alert_id",
        "alert_occurrence_datetime",
        "alert_recovery_datetime",
        "alert_status_id",
        "alert_value",
    )


def _closing(v: Views) -> DataFrame:
    """A reading without values, two years after all others: it only moves the clock of a stream."""
    device = v.alert_setting.agg(F.min("device_id").alias("device_id"))
    return device.select(
        F.lit(-1).cast("long").alias("event_id"),
        "device_id",
        F.lit("2026-01-01").cast("timestamp").alias("event_timestamp"),
        *[F.lit(None).cast("double").alias(name) for name in SENSORS],
    )


def _land_last(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(path)


@query
def q_start_over(v: Views) -> DataFrame:
    """The stream of alerts, started over with a new checkpoint after half of the messages."""
    pipeline = new_pipeline(v, "replay")
    half = v.events.agg(F.percentile_approx("event_id", 0.5, 10000)).first()[0] or 0
    parts = (v.events.filter(F.col("event_id") <= half), v.events.filter(F.col("event_id") > half))
    for number, part in enumerate(parts):
        landing = f"{pipeline.root}/landing-{number}"
        _land(part, landing, make=v.messages_of)
        stream = v.spark.readStream.schema(v.raw_messages.schema).parquet(landing)
        pipeline.start(stream, f"{pipeline.root}/checkpoint-{number}", interval=None).awaitTermination()
    return _streamed_history(pipeline, v)


@query
def q_stream_minutes(v: Views) -> DataFrame:
    """The minute series, each minute written once the watermark has passed it."""
    root = f"{scratch_root(v.spark)}/minutes-{uuid.uuid4().hex}"
    rows = v.telemetry.select("event_id", "device_id", "event_timestamp")
    stream = land_in_order(rows, "event_timestamp", f"{root}/landing", 3)
    _land_last(_closing(v).select(*rows.columns), f"{root}/landing")
    minutes = MinuteStream(v.spark, f"{root}/tables")
    minutes.start(stream, f"{root}/checkpoint", interval=None).awaitTermination()
    return minutes.series()


def _with_stragglers(v: Views) -> MinuteStream:
    """Telemetry in three parts by date; every 50th row of the first week comes with the last one,
    every 70th of the second part comes twice."""
    root = f"{scratch_root(v.spark)}/late-{uuid.uuid4().hex}"
    rows = v.telemetry.select("event_id", "device_id", "event_timestamp")
    event, day = F.col("event_id"), F.to_date("event_timestamp")
    straggles = (event % 50 == 0) & (day < "2024-01-08")
    part = F.when(straggles | (day >= "2024-01-20"), 2).when(day >= "2024-01-10", 1).otherwise(0)
    parts = [rows.filter(part == n) for n in range(3)]
    parts[1] = parts[1].unionAll(parts[1].filter(event % 70 == 0))
    for landed in [*parts, _closing(v).select(*rows.columns)]:
        _land_last(landed, f"{root}/landing")
    reader = v.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    stream = MinuteStream(v.spark, f"{root}/tables", lateness="1 hour")
    stream.start(reader.parquet(f"{root}/landing"), f"{root}/checkpoint", interval=None).awaitTermination()
    return stream


@query
def q_minute_windows(v: Views) -> DataFrame:
    """Finished minutes of a stream with late and repeated rows, which are not counted."""
    return _with_stragglers(v).series()


@query
def q_late_rows(v: Views) -> DataFrame:
    """The rows left out of those minutes."""
    return _with_stragglers(v).left_out()


@query
def q_state_stream(v: Views) -> DataFrame:
    """The replay as a stream with keyed state: three triggers, two runs, one checkpoint."""
    root = f"{scratch_root(v.spark)}/episodes-{uuid.uuid4().hex}"
    stream = EpisodeStream(v.spark, f"{root}/tables", lambda: v.alert_setting)

    def run(rows: DataFrame) -> None:
        stream.start(rows, f"{root}/checkpoint", interval=None).awaitTermination()

    landed = land_in_order(_enriched(v).select(*v.telemetry.columns), "event_timestamp", f"{root}/landing", 3)
    run(landed)
    # What is still open waits in the checkpoint for the next run.
    _land_last(_closing(v), f"{root}/landing")
    run(landed)
    return stream.history()


@query
def q_stream_correlate(v: Views) -> DataFrame:
    root = f"{scratch_root(v.spark)}/correlation-{uuid.uuid4().hex}"
    path = f"{root}/landing"
    first = land_in_order(v.messages, "at", path, 3)
    last = v.spark.range(1).select(
        F.lit("closing").alias("client"),
        *[F.lit(0).alias(name) for name in ("msg_type", "msg_id")],
        F.lit("2026-01-01").cast("timestamp").alias("at"),
        F.lit(False).alias("is_response"),
        F.lit(0).cast("long").alias("seq"),
    )
    _land_last(last.select(*v.messages.columns), path)
    correlation = CorrelationStream(v.spark, f"{root}/tables")
    correlation.start(first, None, f"{root}/checkpoint", interval=None).awaitTermination()
    return correlation.results.read(v.spark).drop("epoch", "batch_id")


@query
def q_stream_redelivery(v: Views) -> DataFrame:
    """Silver of a stream whose second third is delivered twice, in two triggers."""
    pipeline = new_pipeline(v, "batch")
    landing = f"{pipeline.root}/landing"
    stream = land_messages(v, landing, 3)
    _land(v.events.filter(F.col("event_id") % 3 == 1), landing, make=v.messages_of)
    pipeline.start(stream, f"{pipeline.root}/checkpoint", interval=None).awaitTermination()
    return pipeline.silver.read(v.spark).groupBy("device_id", "event_date").agg(F.count("*").alias("rows"))


@query
def q_stream_funnel(v: Views) -> DataFrame:
    """The funnel as the stream counted it while it wrote."""
    pipeline, _ = run_stream(v, "batch")
    return pipeline.funnel()


@query
def q_sink_audit(v: Views) -> DataFrame:
    """Per sink the batches that it finished and that it failed."""
    pipeline, _ = run_stream(v, "batch")
    return pipeline.audit.read(v.spark).groupBy("sink").agg(
        F.count_if("ok").alias("finished"), F.count_if(~F.col("ok")).alias("failed")
    )


@query
def q_monitor(v: Views) -> DataFrame:
    """Progress reports of a stream: rows handled, batches with rows, and whether times are told."""
    _, running = run_stream(v, "batch")
    progress = monitor.recent_progress(running)
    timed = monitor.measures(progress).filter("metric IN ('batch_seconds', 'rows_per_second')")
    return progress.filter("input_rows > 0").agg(
        F.sum("input_rows").alias("input_rows"), F.count("*").alias("batches")
    ).withColumn("timed", timed.agg(F.min(F.col("value") > 0)).scalar())


@query
def q_restart(v: Views) -> DataFrame:
    """A stream that stops after a third of its messages and goes on: every row is stored once."""
    pipeline = new_pipeline(v, "batch")
    third = F.col("event_id") % 3 == 0
    for part in (v.events.filter(third), v.events.filter(~third)):
        v.messages_of(part).write.mode("append").parquet(f"{pipeline.root}/landing", compression="zstd")
        for _ in range(2):  # the second start finds nothing new
            stream = v.spark.readStream.schema(v.raw_messages.schema).parquet(f"{pipeline.root}/landing")
            pipeline.start(stream, f"{pipeline.root}/checkpoint", interval=None).awaitTermination()
    return pipeline.silver.read(v.spark).groupBy("device_id").agg(F.count("*").alias("rows"))
