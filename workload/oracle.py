"""SQL counterparts of the registered queries, over the plain test tables."""

from __future__ import annotations

import re

from coldtrace.functions import notices
from coldtrace.schemas import SENSORS
from coldtrace.sources.generator import HEATER_ON, RANGES
from workload.views import AS_OF, BATCH_TIME, STATE_FIRED, STATE_START

_SENSOR_LIST = ", ".join(SENSORS)

# Fixed values, stated here once more so that a slip in the code under test shows.
PERCENTILES = {
    "p50": 0.5,
    "p66": 0.66,
    "p75": 0.75,
    "p80": 0.8,
    "p90": 0.9,
    "p95": 0.95,
    "p98": 0.98,
    "p99": 0.99,
    "p99_9": 0.999,
    "p99_99": 0.9999,
    "p100": 1.0,
}
CHECKS = [
    (6, "sending", "failure_rate", "<=", 0.0, 0.01),
    (7, "sending", "send_median_ms", "<", 5000.0, 10000.0),
    (8, "sending", "send_p95_ms", "<", 5000.0, 10000.0),
    (9, "sending", "rate_deviation_pct", "<=", 1.0, 5.0),
    (10, "sending", "devices_started", ">=", 1.0, 1.0),
    (12, "broker", "poll_failure_rate", "<=", 0.0, 0.0),
    (14, "sending", "failure_rows", "<=", 0.0, 0.0),
    (15, "broker", "new_messages", ">", 0.0, 0.0),
    (16, "broker", "consumer_lag", "<=", 10000.0, 100000.0),
    (17, "broker", "throttled_ratio", "<=", 0.0, 0.0),
    (18, "broker", "in_out_deviation_pct", "<=", 1.0, 5.0),
    (20, "archive", "archive_gap_minutes", "<=", 5.0, 10.0),
    (21, "archive", "archive_delay_minutes", "<=", 10.0, 30.0),
    (22, "lakehouse", "stored_rows", ">", 0.0, 0.0),
    (23, "lakehouse", "freshness_sec", "<=", 60.0, 600.0),
    (24, "lakehouse", "avg_lag_sec", "<", 5.0, 10.0),
    (25, "lakehouse", "records_per_minute", ">=", 7200.0, 3600.0),
    (26, "lakehouse", "device_coverage", ">=", 1.0, 1.0),
    (27, "oltp", "stored_rows_oltp", ">", 0.0, 0.0),
    (28, "oltp", "avg_lag_sec_oltp", "<", 5.0, 10.0),
    (32, "pipeline", "batch_seconds", "<", 10.0, 60.0),
    (33, "pipeline", "error_rate", "<=", 0.01, 0.01),
]


def _seconds(column: str) -> str:
    return f"(epoch_us({column}) // 1000000)"


def _telemetry() -> str:
    sensors = ", ".join(
        f"CASE WHEN event_id % 11 = {k % 11} THEN NULL "
        f"ELSE value + {k} * CAST(0.5 AS DOUBLE) END AS {name}"
        for k, name in enumerate(SENSORS, start=1)
    )
    return (
        "SELECT event_id, CAST(user_id AS INTEGER) AS device_id, ts AS event_timestamp, "
        f"{sensors} FROM events"
    )


def _sensor_choice() -> str:
    cases = " ".join(f"WHEN {k} THEN {name}" for k, name in enumerate(SENSORS, start=1))
    return f"CASE alert_conditions_measurement_item_id {cases} END"


_EXCEEDED = """CASE alert_conditions_operator
    WHEN '>' THEN current_sensor_value > alert_conditions_threshold
    WHEN '>=' THEN current_sensor_value >= alert_conditions_threshold
    WHEN '<' THEN current_sensor_value < alert_conditions_threshold
    WHEN '<=' THEN current_sensor_value <= alert_conditions_threshold
    WHEN '==' THEN current_sensor_value = alert_conditions_threshold
    WHEN '!=' THEN current_sensor_value <> alert_conditions_threshold
    ELSE FALSE END"""

# Which messages are broken, and how.
_FLAGS = """SELECT *,
    event_id % 97 = 0 AS bad,
    event_id % 97 <> 0 AND event_id % 89 = 0 AS plain,
    event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 = 0 AS no_device,
    event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 = 0
        AS bad_time,
    event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0
        AND event_id % 73 = 0 AS framed
    FROM telemetry"""

_PARSED = "SELECT event_id, device_id, event_timestamp, " + ", ".join(
    f"CASE WHEN framed THEN coalesce({name}, 0.0) ELSE {name} END AS {name}" for name in SENSORS
) + " FROM flagged WHERE NOT (bad OR plain OR no_device OR bad_time)"

_WEEK = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)"

_VIEWS = {
    "telemetry": _telemetry(),
    "flagged": _FLAGS,
    "parsed": _PARSED,
    "device_master": """SELECT CAST(c_custkey AS INTEGER) AS device_id, c_name AS device_name,
        CAST(c_nationkey AS INTEGER) AS organization_id FROM customer WHERE c_custkey % 17 <> 3""",
    "organization_master": """SELECT CAST(n_nationkey AS INTEGER) AS organization_id,
        n_name AS organization_name FROM nation WHERE n_regionkey <> 4""",
    "alert_setting": """SELECT CAST(c_custkey AS INTEGER) AS device_id,
        CAST(c_custkey * 10 + r AS INTEGER) AS alert_id,
        concat('rule-', CAST(c_custkey * 10 + r AS VARCHAR)) AS alert_name,
        CAST(1 + (c_custkey * 7 + r * 5) % 22 AS INTEGER) AS alert_conditions_measurement_item_id,
        CASE (c_custkey + r) % 7 WHEN 0 THEN '>' WHEN 1 THEN '>=' WHEN 2 THEN '<' WHEN 3 THEN '<='
            WHEN 4 THEN '==' WHEN 5 THEN '!=' ELSE '<>' END AS alert_conditions_operator,
        CAST(20 + 10 * ((c_custkey + r) % 5) AS DOUBLE) AS alert_conditions_threshold,
        CAST(600 * r AS INTEGER) AS judgment_time,
        CAST(1 + c_custkey % 3 AS INTEGER) AS alert_level_id,
        c_custkey % 2 = 0 AS alert_email_flag,
        c_custkey % 13 = 5 AS delete_flag
        FROM customer CROSS JOIN (VALUES (0), (1)) AS t(r) WHERE c_custkey % 3 <> 0""",
    "mail_setting": """SELECT CAST(s_nationkey AS INTEGER) AS organization_id,
        concat('u', CAST(s_suppkey AS VARCHAR), '@example.test') AS email_address,
        s_suppkey % 2 = 0 AS is_active FROM supplier""",
    "measurement_item": """SELECT CAST(i AS INTEGER) AS measurement_item_id,
        concat('item-', CAST(i AS VARCHAR)) AS measurement_item_name FROM range(1, 22) AS t(i)""",
    "state0": f"""SELECT device_id, alert_id,
        CASE WHEN alert_id % 4 <> 0 THEN TIMESTAMP '{STATE_START}' END AS abnormal_start_time,
        CASE WHEN alert_id % 4 = 2 THEN TIMESTAMP '{STATE_FIRED}' END AS alert_fired_time,
        CASE WHEN alert_id % 4 = 2 THEN alert_id + 1000 END AS alert_history_id
        FROM alert_setting WHERE alert_id % 4 <> 3""",
    "enriched": """SELECT t.*, d.device_name, d.organization_id FROM telemetry t
        LEFT JOIN device_master d ON t.device_id = d.device_id
        WHERE d.organization_id IN (SELECT organization_id FROM organization_master)""",
    "chosen": f"""SELECT e.*, r.* EXCLUDE (device_id), {_sensor_choice()} AS current_sensor_value
        FROM enriched e LEFT JOIN (SELECT * FROM alert_setting WHERE NOT delete_flag) r
        ON e.device_id = r.device_id""",
    "judged": f"SELECT *, {_EXCEEDED} AS threshold_exceeded FROM chosen",
    "stated": f"""SELECT j.*, s.abnormal_start_time, s.alert_fired_time, s.alert_history_id,
        coalesce(threshold_exceeded AND s.abnormal_start_time IS NOT NULL
            AND {_seconds('j.event_timestamp')} - {_seconds('s.abnormal_start_time')}
                >= judgment_time * 60
            AND s.alert_fired_time IS NULL, FALSE) AS alert_triggered
        FROM judged j LEFT JOIN state0 s ON j.device_id = s.device_id AND j.alert_id = s.alert_id
        WHERE j.alert_id IS NOT NULL""",
    "evidence": "SELECT * FROM stated WHERE threshold_exceeded IS NOT NULL",
    "newest": """SELECT *, CASE WHEN NOT threshold_exceeded THEN 'recovery'
            WHEN alert_triggered THEN 'alert_fired' ELSE 'abnormal_start' END AS pattern
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id
            ORDER BY event_timestamp DESC, threshold_exceeded DESC, event_id DESC) AS rn
            FROM evidence) WHERE rn = 1""",
    "fired": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id
            ORDER BY event_timestamp, event_id) AS rn
            FROM evidence WHERE alert_triggered) WHERE rn = 1""",
    # Replay: episodes numbered by the normal rows before them.
    "numbered": """SELECT *, sum(CASE WHEN threshold_exceeded THEN 0 ELSE 1 END) OVER (
            PARTITION BY device_id, alert_id ORDER BY event_timestamp, event_id
            ROWS UNBOUNDED PRECEDING) AS episode
        FROM judged WHERE alert_id IS NOT NULL AND threshold_exceeded IS NOT NULL""",
    "running": """SELECT *, min(event_timestamp) OVER w AS started,
            row_number() OVER (w ORDER BY event_timestamp, event_id) AS place
        FROM numbered WHERE threshold_exceeded
        WINDOW w AS (PARTITION BY device_id, alert_id, episode)""",
    # The queue, slot by slot.
    "waiting": """WITH RECURSIVE counted AS (
            SELECT user_id % 16 AS part, date_trunc('hour', ts) AS slot, count(*) AS arrived
            FROM events GROUP BY ALL),
        hours AS (SELECT unnest(generate_series(min(slot), max(slot), INTERVAL 1 HOUR)) AS slot FROM counted),
        grid AS (SELECT p.part, h.slot, coalesce(c.arrived, 0) AS arrived
            FROM (SELECT DISTINCT part FROM counted) p CROSS JOIN hours h
            LEFT JOIN counted c ON c.part = p.part AND c.slot = h.slot),
        able AS (SELECT part, ceil(2 * avg(arrived)) AS able FROM grid GROUP BY part),
        flow AS (SELECT g.part, slot, arrived, CAST(CASE WHEN slot >= TIMESTAMP '2024-01-10'
                AND slot < TIMESTAMP '2024-01-10 12:00:00' THEN 0 ELSE able END AS BIGINT) AS capacity,
                row_number() OVER (PARTITION BY g.part ORDER BY slot) AS k
            FROM grid g JOIN able USING (part)),
        queue AS (SELECT part, slot, arrived, capacity, k, greatest(0, arrived - capacity) AS backlog
            FROM flow WHERE k = 1
            UNION ALL SELECT f.part, f.slot, f.arrived, f.capacity, f.k,
                greatest(0, q.backlog + f.arrived - f.capacity)
            FROM queue q JOIN flow f ON f.part = q.part AND f.k = q.k + 1)
        SELECT part, slot, arrived, capacity, backlog FROM queue""",
    "replay": f"""SELECT f.device_id, f.alert_id, f.started AS abnormal_start_time,
            f.event_timestamp AS fired_event_time, f.current_sensor_value AS alert_value,
            n.event_timestamp AS recovered_event_time
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id, episode
                ORDER BY event_timestamp, event_id) AS turn
            FROM running WHERE place > 1 AND
                {_seconds('event_timestamp')} - {_seconds('started')} >= judgment_time * 60) f
        LEFT JOIN (SELECT * FROM numbered WHERE NOT threshold_exceeded) n
            ON n.device_id = f.device_id AND n.alert_id = f.alert_id AND n.episode = f.episode + 1
        WHERE f.turn = 1""",
    "stored": """SELECT *, event_timestamp + to_seconds(event_id % 40) AS create_time
        FROM telemetry""",
    "mirror": """SELECT CASE WHEN event_id % 103 = 0 THEN event_id + 1000000000 ELSE event_id END
        AS event_id, device_id FROM telemetry WHERE event_id % 101 <> 0""",
    "requests": """SELECT event_type AS type, concat('name-', CAST(user_id % 3 AS VARCHAR)) AS name,
        CAST(floor(value * 10) AS DOUBLE) AS response_time,
        CAST(length(props) AS DOUBLE) AS response_length,
        CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'error' END AS exception, ts AS sent_at
        FROM events""",
    "timed": """SELECT *, CASE WHEN response_time < 100 THEN round_even(response_time, 0)
            WHEN response_time < 1000 THEN round_even(response_time / 10, 0) * 10
            WHEN response_time < 10000 THEN round_even(response_time / 100, 0) * 100
            ELSE round_even(response_time / 1000, 0) * 1000 END AS rounded FROM requests""",
    "timed_total": """SELECT * FROM timed UNION ALL
        SELECT * REPLACE ('' AS type, 'Aggregated' AS name) FROM timed""",
    "minutes": f"""SELECT {_WEEK} AS run,
        TIMESTAMP '2024-01-01' + to_minutes(
            (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 21600000000) AS minute,
        count(*) AS records FROM events GROUP BY 1, 2""",
    "phased": """SELECT m.run, m.minute, m.records,
            CASE WHEN b.steady_from IS NULL OR m.minute < b.steady_from THEN 'ramp-up'
                WHEN m.minute <= b.steady_to THEN 'steady' ELSE 'end' END AS phase
        FROM minutes m JOIN (
            SELECT run, min(minute) FILTER (reached) AS steady_from,
                max(minute) FILTER (reached) AS steady_to
            FROM (SELECT run, minute, sum(records) OVER (PARTITION BY run ORDER BY minute
                    RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW)
                    >= 0.95 * (SELECT avg(records) FROM minutes) * 5 AS reached FROM minutes)
            GROUP BY run) b ON m.run = b.run""",
    "measured": """SELECT unnest([
            {'metric': 'avg_lag_sec', 'value': avg(lag)},
            {'metric': 'avg_lag_sec_oltp',
             'value': avg(lag) FILTER (event_id % 101 <> 0 AND event_id % 103 <> 0)},
            {'metric': 'records_per_minute',
             'value': count(*) / count(DISTINCT date_trunc('minute', event_timestamp))},
            {'metric': 'consumer_lag', 'value': (SELECT CAST(sum(sent - coalesce(got, 0)) AS DOUBLE)
                FROM (SELECT user_id % 16 AS p, max(CASE WHEN user_id % 16 = 3
                        AND hour(date_trunc('hour', ts)) = 0 THEN 0 ELSE event_id END) AS sent
                    FROM events GROUP BY 1)
                LEFT JOIN (SELECT user_id % 16 AS p, max(event_id) AS got FROM events
                    WHERE event_id % 101 <> 0 AND event_id % 103 <> 0 GROUP BY 1) USING (p))},
            {'metric': 'throttled_ratio', 'value': (SELECT count(*) FILTER (type = 'error')
                / count(*) FROM requests)},
            {'metric': 'rate_deviation_pct', 'value': (SELECT abs((n / 864000 - d / 38880)
                / (d / 38880) * 100) FROM (SELECT count(*) FILTER (
                    event_timestamp >= TIMESTAMP '2024-01-10'
                    AND event_timestamp < TIMESTAMP '2024-01-20') AS n,
                count(DISTINCT device_id) AS d FROM telemetry))},
            {'metric': 'device_coverage',
             'value': count(DISTINCT device_id) / (SELECT count(*) FROM device_master)},
            {'metric': 'archive_delay_minutes', 'value': max(lag) / 60},
            {'metric': 'freshness_sec', 'value': CAST(epoch_us(max(create_time)) // 1000000
                - epoch_us(max(event_timestamp)) // 1000000 AS DOUBLE)},
            {'metric': 'stored_rows', 'value': CAST(count(*) AS DOUBLE)},
            {'metric': 'stored_rows_oltp', 'value': (SELECT CAST(count(*) AS DOUBLE) FROM mirror)},
            {'metric': 'in_out_deviation_pct',
             'value': abs((SELECT count(*) FROM mirror) / count(*) - 1) * 100},
            {'metric': 'send_median_ms', 'value': (SELECT median_response_time FROM sending)},
            {'metric': 'send_p95_ms', 'value': (SELECT p95 FROM sending)},
            {'metric': 'devices_started', 'value': (SELECT count(DISTINCT device_id) FROM telemetry
                WHERE device_id IN (SELECT device_id FROM device_master))
                / (SELECT count(*) FROM device_master)},
            {'metric': 'poll_failure_rate', 'value': 0 / count(*)},
            {'metric': 'failure_rows', 'value': (SELECT CAST(count(*) AS DOUBLE) FROM (
                SELECT DISTINCT type, name, exception FROM requests WHERE exception IS NOT NULL))},
            {'metric': 'new_messages', 'value': (SELECT CAST(sum(grown) AS DOUBLE) FROM (
                SELECT greatest(0, coalesce(last_sequence - lag(last_sequence) OVER (
                    PARTITION BY partition ORDER BY poll_time), 0)) AS grown
                FROM (SELECT user_id % 16 AS partition, date_trunc('hour', ts) AS poll_time,
                        CASE WHEN user_id % 16 = 3 AND hour(date_trunc('hour', ts)) = 0 THEN 0
                            ELSE max(event_id) END AS last_sequence
                    FROM events GROUP BY user_id % 16, date_trunc('hour', ts))))},
            {'metric': 'archive_gap_minutes', 'value': (SELECT max(gap) FROM (
                SELECT (epoch_us(m) - epoch_us(lag(m) OVER (ORDER BY m))) / 60000000 AS gap
                FROM (SELECT DISTINCT date_trunc('minute', create_time) AS m FROM stored)))},
            {'metric': 'error_rate', 'value': (count(*) - (SELECT count(*) FROM parsed)) / count(*)},
            {'metric': 'failure_rate', 'value': (SELECT count(exception) / count(*) FROM requests)}],
            recursive := true)
        FROM (SELECT *, epoch_us(create_time) // 1000000 - epoch_us(event_timestamp) // 1000000 AS lag
            FROM stored)""",
    "checks": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({n}, '{category}', '{metric}', '{sign}', CAST({ok} AS DOUBLE), CAST({bad} AS DOUBLE))"
        for n, category, metric, sign, ok, bad in CHECKS
    )
    + ") AS t(check_id, category, metric, comparison, pass_limit, fail_limit)",
    "verdict": """SELECT c.check_id, c.category, c.metric, m.value,
            CASE WHEN m.value IS NULL THEN 'caution'
                WHEN CASE comparison WHEN '<' THEN value < pass_limit WHEN '<=' THEN value <= pass_limit
                    WHEN '>' THEN value > pass_limit ELSE value >= pass_limit END THEN 'pass'
                WHEN CASE comparison WHEN '<' THEN value < fail_limit WHEN '<=' THEN value <= fail_limit
                    WHEN '>' THEN value > fail_limit ELSE value >= fail_limit END THEN 'caution'
                ELSE 'fail' END AS verdict
        FROM checks c LEFT JOIN measured m ON c.metric = m.metric""",
    "squeezed": """SELECT *, concat('c', CAST(user_id % 20 AS VARCHAR)) AS client,
            CAST(event_id % 3 AS INTEGER) AS msg_type, CAST(event_id % 4 AS INTEGER) AS msg_id,
            epoch_us(TIMESTAMP '2024-01-01')
                + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60 AS us FROM events""",
    "messages": """SELECT client, msg_type, msg_id, us, FALSE AS is_response, event_id AS seq
        FROM squeezed WHERE event_type IN ('click', 'view', 'purchase')
        UNION ALL SELECT client, msg_type, msg_id, us + CAST(floor(value * 1000000 / 3) AS BIGINT),
            TRUE, event_id FROM squeezed
            WHERE event_type IN ('click', 'view', 'purchase') AND event_id % 7 <> 0
        UNION ALL SELECT client, msg_type, msg_id, us, TRUE, event_id
        FROM squeezed WHERE event_type NOT IN ('click', 'view', 'purchase')""",
    # The request open at a response: the newest one before it, unless a response came in between.
    "matched": """SELECT * FROM (SELECT client, msg_type, msg_id, seq, is_response, us,
            lead(is_response) OVER w AS next_is_response, lead(us) OVER w AS next_us,
            lag(is_response) OVER w AS last_is_response, lag(us) OVER w AS last_us
        FROM messages WINDOW w AS (PARTITION BY client, msg_type, msg_id
            ORDER BY us, is_response, seq))""",
    "correlated": """SELECT client, msg_type, msg_id, seq, make_timestamp(us) AS request_at,
            CASE WHEN next_is_response AND next_us - us <= 15000000 THEN make_timestamp(next_us) END
                AS response_at,
            CASE WHEN next_is_response AND next_us - us <= 15000000 THEN 'Success' ELSE 'Timeout' END
                AS result,
            CASE WHEN next_is_response AND next_us - us <= 15000000
                THEN CAST(ceil((next_us - us) / 1000) AS BIGINT) END AS latency_ms
        FROM matched WHERE NOT is_response
        UNION ALL SELECT client, msg_type, msg_id, seq, NULL, make_timestamp(us), 'Failure', NULL
        FROM matched WHERE is_response AND NOT coalesce(
            NOT last_is_response AND us - last_us <= 15000000, FALSE)""",
    "fleet": """SELECT CAST(i AS INTEGER) AS device_id, 'model' AS device_model,
            (SELECT organization_id FROM device_master WHERE device_id = 1) AS organization_id,
            concat('loadtest-device-', CASE WHEN length(CAST(i AS VARCHAR)) >= 5
                THEN CAST(i AS VARCHAR) ELSE lpad(CAST(i AS VARCHAR), 5, '0') END) AS device_name
        FROM (SELECT unnest(range(3, max(c_custkey) + 1)) AS i FROM customer)""",
    "named": """SELECT device_id, device_name FROM fleet
        UNION ALL SELECT device_id, device_name FROM device_master""",
    "ranked": """SELECT device_id, row_number() OVER (ORDER BY device_id) AS rn,
        count(*) OVER () AS total FROM device_master""",
}


def _with_views(body: str) -> str:
    """`body` preceded by the views it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _VIEWS:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(_VIEWS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ", ".join(f"{name} AS ({_VIEWS[name]})" for name in needed) + " " + body


def _stats(view: str) -> str:
    """Statistics with the percentiles taken from all rows in order."""
    points = ", ".join(
        f"max(rounded) FILTER (below <= floor(n * CAST({p} AS DOUBLE))) AS {name}"
        for name, p in PERCENTILES.items()
    )
    return f"""SELECT type, name, count(*) AS request_count, count(exception) AS failure_count,
            min(rounded) FILTER (upto > (n - 1) / 2) AS median_response_time,
            CAST(sum(CAST(response_time AS DECIMAL(20, 6))) AS DOUBLE) / count(*)
                AS average_response_time,
            min(response_time) AS min_response_time, max(response_time) AS max_response_time,
            CAST(sum(CAST(response_length AS DECIMAL(20, 6))) AS DOUBLE) / count(*)
                AS average_content_size,
            count(*) / any_value(run_seconds) AS requests_per_s,
            count(exception) / any_value(run_seconds) AS failures_per_s,
            count(exception) / count(*) AS failure_rate, {points}
        FROM (SELECT *, count(*) OVER (PARTITION BY type, name) AS n,
                rank() OVER (PARTITION BY type, name ORDER BY rounded) - 1 AS below,
                count(*) OVER (PARTITION BY type, name ORDER BY rounded) AS upto,
                (SELECT (epoch_us(max(sent_at)) - epoch_us(min(sent_at))) / 1000000 FROM requests)
                    AS run_seconds
            FROM {view}) GROUP BY type, name"""


def _draw(key: str, index: int) -> str:
    digest, slot = divmod(index, 4)
    text = f"substr(md5(concat_ws('|', {key}, '{digest}')), {1 + 8 * slot}, 8)"
    return f"(CAST(('0x' || {text}) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _generated() -> str:
    key = "'7', CAST(device_id AS VARCHAR), CAST(tick AS VARCHAR)"
    columns, layers = [], []
    for index, name in enumerate(SENSORS):
        low, high, base = RANGES[name]
        value = f"CAST({low} AS DOUBLE) + {_draw(key, index)} * CAST({high - low} AS DOUBLE)"
        if base is not None:
            value = f"{base} + ({value})"
        if name.startswith("defrost_heater"):
            on = f"{_draw(key, len(SENSORS) + index)} < {HEATER_ON}"
            value = f"CASE WHEN {on} THEN {value} ELSE 0.0 END"
        (columns if base is None else layers).append(f"round({value}, 1) AS {name}")
    first = _draw("'7', CAST(device_id AS VARCHAR), 'start'", 0)
    seconds = f"CAST(floor({first} * 60) AS BIGINT) + tick * 300"
    return f"""SELECT device_id, tick, event_timestamp, {_SENSOR_LIST} FROM (
        SELECT *, {', '.join(layers)} FROM (
            SELECT device_id, tick, TIMESTAMP '2024-03-01' + to_seconds({seconds}) AS event_timestamp,
                {', '.join(columns)}
            FROM (SELECT device_id, CAST(unnest(range(0, 4)) AS INTEGER) AS tick FROM device_master)))"""


_VIEWS["sending"] = (
    f"SELECT median_response_time, p95 FROM ({_stats('timed_total')}) WHERE name = 'Aggregated'"
)

_MAIL_BODY = (
    f"concat('{notices.BODY_HEAD}', '{notices.BODY_DEVICE}', CAST(device_id AS VARCHAR), '\n', "
    f"'{notices.BODY_ALERT}', alert_name, '\n', '{notices.BODY_ITEM}', "
    f"coalesce(measurement_item_name, ''), '\n', '{notices.BODY_TIME}', "
    "CAST(event_timestamp AS VARCHAR), '\n')"
)
_NOW = f"TIMESTAMP '{BATCH_TIME}'"
_SILVER = f"""SELECT p.device_id, organization_id, event_timestamp,
    CAST(event_timestamp AS DATE) AS event_date, {_SENSOR_LIST}"""

_QUERIES = {
    "q_extract_device": """SELECT event_id, CASE WHEN NOT no_device THEN device_id END AS device_id
        FROM flagged""",
    "q_json_path": """SELECT event_id,
            CASE WHEN NOT (bad OR plain OR framed OR no_device) THEN device_id END AS json_id,
            CASE WHEN NOT (bad OR plain OR framed) AND event_id % 79 <> 0
                THEN event_timestamp END AS json_time,
            CASE WHEN NOT (bad OR plain OR framed) THEN external_temp END AS json_temp
        FROM flagged""",
    "q_parse": "SELECT * FROM parsed",
    "q_funnel": """SELECT CAST(step AS INTEGER) AS step, stage, rows FROM (
            SELECT 0 AS step, 'raw' AS stage, count(*) AS rows FROM flagged
            UNION ALL SELECT 1, 'device_id', count(*) FILTER (NOT no_device) FROM flagged
            UNION ALL SELECT 2, 'json_text', count(*) FILTER (NOT (no_device OR plain)) FROM flagged
            UNION ALL SELECT 3, 'payload', count(*) FILTER (NOT (no_device OR plain OR bad))
                FROM flagged
            UNION ALL SELECT 4, 'event_time',
                count(*) FILTER (NOT (no_device OR plain OR bad OR bad_time)) FROM flagged)""",
    "q_quarantine": """SELECT event_id, CASE WHEN NOT no_device THEN device_id END AS device_id,
            CASE WHEN no_device THEN 'no_device_id' WHEN plain THEN 'no_json_text'
                WHEN bad THEN 'no_payload' ELSE 'no_event_time' END AS reason
        FROM flagged WHERE no_device OR plain OR bad OR bad_time""",
    "q_payload_sample": """SELECT CASE WHEN no_device THEN 'devices/unknown/messages/events/'
            ELSE concat('devices/loadtest-device-', lpad(CAST(device_id AS VARCHAR), 5, '0'),
                '/messages/events/') END AS topic,
            CAST(device_id AS VARCHAR) AS message_key, event_id
        FROM flagged WHERE NOT (no_device OR plain)
        ORDER BY topic, CAST(device_id % 16 AS INTEGER), event_id LIMIT 3""",
    "q_canonical_json": """SELECT event_id, device_id, device_id AS text_id,
            CAST(1 AS INTEGER) AS id_fields, device_id AS variant_id, event_id % 12 = 4 AS is_nan,
            CASE WHEN event_id % 12 <> 4 THEN external_temp END AS temperature,
            CASE WHEN event_id % 12 = 5 THEN 3 END AS nested_id,
            CASE WHEN event_id % 12 = 8 THEN 't: NaN, x' END AS note, true AS is_valid
        FROM telemetry""",
    "q_variant": f"SELECT event_id, device_id, {_SENSOR_LIST} FROM parsed",
    "q_binary_decode": f"""SELECT event_id, device_id, event_timestamp,
        {', '.join(f'coalesce({n}, 0.0) AS {n}' for n in SENSORS)} FROM flagged WHERE framed""",
    "q_bronze": """SELECT event_id, CAST(device_id % 16 AS INTEGER) AS partition,
            CASE WHEN event_id % 83 = 0 AND event_id % 89 <> 0 AND event_id % 97 <> 0
                THEN 'devices/unknown/messages/events/'
                ELSE concat('devices/loadtest-device-', lpad(CAST(device_id AS VARCHAR), 5, '0'),
                    '/messages/events/') END AS topic,
            create_time AS timestamp
        FROM stored WHERE create_time >= TIMESTAMP '2024-01-10 06:00:00'
            AND create_time < TIMESTAMP '2024-01-20 18:00:00'""",
    "q_enrich": "SELECT event_id, device_id, organization_id, device_name FROM enriched",
    "q_unknown_devices": """SELECT t.device_id,
            CASE WHEN d.organization_id IS NULL THEN 'device' ELSE 'organization' END AS missing,
            count(*) AS dropped_rows
        FROM telemetry t LEFT JOIN device_master d ON t.device_id = d.device_id
        LEFT JOIN organization_master o ON d.organization_id = o.organization_id
        WHERE o.organization_id IS NULL GROUP BY 1, 2""",
    "q_coverage": """SELECT device_id, device_name FROM device_master
        WHERE device_id NOT IN (SELECT device_id FROM telemetry)""",
    "q_silver": _SILVER + " FROM enriched p",
    "q_threshold": """SELECT event_id, device_id, alert_id, alert_conditions_measurement_item_id,
        current_sensor_value, threshold_exceeded FROM judged""",
    "q_threshold_null": """SELECT coalesce(alert_conditions_operator, 'none') AS operator,
            CASE WHEN threshold_exceeded THEN 'true' WHEN NOT threshold_exceeded THEN 'false'
                ELSE 'unknown' END AS outcome, count(*) AS rows
        FROM judged GROUP BY 1, 2""",
    "q_duration": """SELECT event_id, device_id, alert_id, event_timestamp, abnormal_start_time,
        current_sensor_value FROM stated WHERE alert_triggered""",
    "q_latest_per_alert": """SELECT device_id, alert_id, event_timestamp, event_id,
            threshold_exceeded, alert_triggered
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id
            ORDER BY event_timestamp DESC, coalesce(threshold_exceeded, FALSE) DESC, event_id DESC)
            AS rn FROM stated) WHERE rn = 1""",
    "q_update_pattern": "SELECT device_id, alert_id, event_timestamp, pattern FROM newest",
    "q_update_pattern_reset": """SELECT CASE WHEN NOT exceeded THEN 'recovery'
            WHEN alert_triggered THEN 'alert_fired' ELSE 'abnormal_start' END AS pattern,
            count(*) AS alerts
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id
                ORDER BY event_timestamp DESC, exceeded DESC, event_id DESC) AS rn
            FROM (SELECT *, coalesce(threshold_exceeded, FALSE) AS exceeded FROM stated))
        WHERE rn = 1 GROUP BY 1""",
    "q_state_merge": f"""SELECT coalesce(s.device_id, n.device_id) AS device_id,
            coalesce(s.alert_id, n.alert_id) AS alert_id,
            CASE WHEN pattern IS NULL THEN s.abnormal_start_time WHEN pattern <> 'recovery'
                THEN coalesce(s.abnormal_start_time, n.event_timestamp) END AS abnormal_start_time,
            n.event_timestamp AS last_event_time, n.current_sensor_value AS last_sensor_value,
            CASE WHEN pattern = 'alert_fired' THEN {_NOW}
                WHEN pattern IS NULL OR pattern = 'abnormal_start' THEN s.alert_fired_time END
                AS alert_fired_time,
            CASE WHEN pattern = 'alert_fired' THEN TRUE
                WHEN pattern IS NULL OR pattern = 'abnormal_start'
                THEN s.alert_history_id IS NOT NULL ELSE FALSE END AS has_history,
            CASE WHEN s.device_id IS NULL THEN {_NOW} ELSE TIMESTAMP '{STATE_START}' END
                AS create_time,
            CASE WHEN n.device_id IS NOT NULL THEN {_NOW} ELSE TIMESTAMP '{STATE_START}' END
                AS update_time
        FROM state0 s FULL JOIN newest n ON s.device_id = n.device_id AND s.alert_id = n.alert_id""",
    "q_alert_history": """SELECT device_id, alert_id,
        abnormal_start_time AS alert_occurrence_datetime, event_timestamp AS fired_event_time,
        current_sensor_value AS alert_value FROM fired""",
    "q_alert_recovery": """SELECT e.device_id, e.alert_id,
            min(e.event_timestamp) AS recovered_event_time
        FROM evidence e JOIN newest n ON e.device_id = n.device_id AND e.alert_id = n.alert_id
        WHERE n.pattern = 'recovery' AND NOT e.threshold_exceeded
            AND (n.alert_fired_time IS NOT NULL OR EXISTS (SELECT 1 FROM fired f
                WHERE f.device_id = e.device_id AND f.alert_id = e.alert_id))
            AND NOT EXISTS (SELECT 1 FROM evidence x WHERE x.device_id = e.device_id
                AND x.alert_id = e.alert_id AND x.threshold_exceeded
                AND x.event_timestamp > e.event_timestamp)
        GROUP BY 1, 2""",
    "q_mail_queue": f"""SELECT device_id, organization_id, alert_id,
            email_address AS recipient_email,
            concat('{notices.SUBJECT_HEAD}', alert_name, '{notices.SUBJECT_DEVICE}',
                CAST(device_id AS VARCHAR)) AS subject,
            {_MAIL_BODY} AS body, 'PENDING' AS status, CAST(0 AS INTEGER) AS retry_count,
            event_timestamp, {_NOW} AS queued_time, {_NOW} AS create_time, {_NOW} AS update_time
        FROM fired f JOIN (SELECT * FROM mail_setting WHERE is_active) m USING (organization_id)
        LEFT JOIN measurement_item i
            ON f.alert_conditions_measurement_item_id = i.measurement_item_id
        WHERE alert_email_flag""",
    "q_mail_detail": """SELECT email_address AS recipient_email, alert_id,
            alert_conditions_measurement_item_id AS measurement_item_id, alert_level_id, device_id,
            organization_id, alert_name, measurement_item_name, alert_conditions_operator AS operator,
            alert_conditions_threshold AS threshold, date_trunc('millisecond', event_timestamp) AS detected_at
        FROM fired f JOIN (SELECT * FROM mail_setting WHERE is_active) m USING (organization_id)
        LEFT JOIN measurement_item i
            ON f.alert_conditions_measurement_item_id = i.measurement_item_id
        WHERE alert_email_flag""",
    "q_history_identity": """SELECT device_id, alert_id, regexp_replace(
                md5(concat_ws('|', device_id, alert_id, epoch_us(abnormal_start_time))),
                '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS alert_history_uuid,
            true AS own_key
        FROM fired""",
    "q_device_status": f"""SELECT f.device_id, 'ALERT' AS latest_status,
            max(event_timestamp) AS latest_event_timestamp,
            count(*) + CASE WHEN f.device_id % 5 = 0 THEN 3 ELSE 0 END AS alert_count,
            max(event_timestamp) AS last_alert_timestamp, {_NOW} AS updated_at
        FROM fired f GROUP BY f.device_id""",
    "q_replay_history": "SELECT * FROM replay",
    "q_replay_recovery": f"""SELECT device_id, alert_id, recovered_event_time,
            {_seconds('recovered_event_time')} - {_seconds('fired_event_time')} AS seconds_open
        FROM replay WHERE recovered_event_time IS NOT NULL""",
    "q_replay_sliced": "SELECT * FROM replay",
    "q_replay_incremental": "SELECT * FROM replay",
    "q_replay_carried_sliced": f"""SELECT f.device_id, f.alert_id, f.started AS abnormal_start_time,
            f.event_timestamp AS fired_event_time, f.current_sensor_value AS alert_value,
            n.event_timestamp AS recovered_event_time
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id, alert_id, episode
                ORDER BY event_timestamp, event_id) AS turn
            FROM (SELECT *, CASE WHEN epoch_us(event_timestamp) >= (
                    SELECT min(epoch_us(event_timestamp)) + (max(epoch_us(event_timestamp))
                        - min(epoch_us(event_timestamp))) * 2 // 4 FROM telemetry)
                    THEN judgment_time * 2 + 60 ELSE judgment_time END AS needed FROM running)
            WHERE place > 1 AND
                {_seconds('event_timestamp')} - {_seconds('started')} >= needed * 60) f
        LEFT JOIN (SELECT * FROM numbered WHERE NOT threshold_exceeded) n
            ON n.device_id = f.device_id AND n.alert_id = f.alert_id AND n.episode = f.episode + 1
        WHERE f.turn = 1""",
    "q_total": "SELECT count(*) AS records FROM telemetry",
    "q_per_device": """SELECT device_id, count(*) AS cnt, max(event_timestamp) AS latest
        FROM telemetry GROUP BY device_id""",
    "q_minute_throughput": """SELECT date_trunc('minute', event_timestamp) AS minute,
        count(*) AS records, count(DISTINCT device_id) AS devices FROM telemetry GROUP BY 1""",
    "q_distinct_devices": f"""SELECT count(DISTINCT device_id) AS devices FROM telemetry
        WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 1440 MINUTE
            AND event_timestamp <= TIMESTAMP '{AS_OF}'""",
    "q_window_closed": """SELECT event_id, device_id, event_timestamp FROM telemetry
        WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'""",
    "q_ingest_lag": f"""SELECT avg(lag) AS avg_lag_sec, max(lag) AS max_lag_sec,
            count(*) AS records
        FROM (SELECT {_seconds('create_time')} - {_seconds('event_timestamp')} AS lag FROM stored)""",
    "q_staleness": f"""SELECT avg(lag) AS avg_lag_sec, max(lag) AS max_lag_sec,
            count(*) AS records_last_1min
        FROM (SELECT {_seconds(f"TIMESTAMP '{AS_OF}'")} - {_seconds('event_timestamp')} AS lag
            FROM stored WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 600 MINUTE
                AND event_timestamp <= TIMESTAMP '{AS_OF}')""",
    "q_workers_per_minute": """SELECT date_trunc('minute', ts) AS minute,
        count(DISTINCT event_id % 7) AS worker_count FROM events GROUP BY 1""",
    "q_latest_rows": f"""SELECT event_id, device_id, event_timestamp, {_SENSOR_LIST} FROM telemetry
        ORDER BY event_timestamp DESC, event_id DESC LIMIT 50""",
    "q_distinct_devices_approx": """SELECT count(DISTINCT device_id) AS devices, TRUE AS within_bound
        FROM telemetry""",
    "q_percentiles_approx": """SELECT type, name, count(*) AS requests, TRUE AS within_bound
        FROM requests GROUP BY 1, 2""",
    "q_busiest_devices": """SELECT device_id, count(*) AS cnt, max(event_timestamp) AS latest
        FROM telemetry GROUP BY device_id ORDER BY cnt DESC, device_id LIMIT 20""",
    "q_current_status": f"""SELECT device_id, event_timestamp, event_id, {_SENSOR_LIST}
        FROM (SELECT *, row_number() OVER (PARTITION BY device_id
            ORDER BY event_timestamp DESC, event_id DESC) AS rn FROM telemetry) WHERE rn = 1""",
    "q_latest_per_key": """SELECT device_id, alert_id, max(event_timestamp) AS latest FROM judged
        WHERE alert_id IS NOT NULL GROUP BY 1, 2""",
    "q_count_check": """SELECT (SELECT count(*) FROM mirror) AS stored_rows,
        (SELECT count(*) FROM telemetry) AS expected_rows,
        (SELECT count(*) FROM mirror) = (SELECT count(*) FROM telemetry) AS matches""",
    "q_reconcile": """SELECT event_id, 'both' AS side FROM telemetry
            WHERE event_id IN (SELECT event_id FROM mirror)
        UNION ALL SELECT event_id, 'only_left' FROM telemetry
            WHERE event_id NOT IN (SELECT event_id FROM mirror)
        UNION ALL SELECT event_id, 'only_right' FROM mirror
            WHERE event_id NOT IN (SELECT event_id FROM telemetry)""",
    "q_reconcile_counts": """SELECT 'left' AS store, count(*) AS records,
            count(DISTINCT device_id) AS devices FROM telemetry
        UNION ALL SELECT 'right', count(*), count(DISTINCT device_id) FROM mirror""",
    "q_request_stats": _stats("timed"),
    "q_request_total": _stats("timed_total"),
    "q_failures": """SELECT type AS method, name, exception AS error, count(*) AS occurrences
        FROM requests WHERE exception IS NOT NULL GROUP BY 1, 2, 3""",
    "q_exceptions": """SELECT message, traceback, count(*) AS count,
            string_agg(DISTINCT node, ', ' ORDER BY node) AS nodes
        FROM (SELECT concat('message-', CAST(event_id % 5 AS VARCHAR)) AS message,
                concat('line-', CAST(event_id % 3 AS VARCHAR)) AS traceback,
                concat('node-', CAST(user_id % 4 AS VARCHAR)) AS node
            FROM events WHERE event_type = 'error') GROUP BY 1, 2""",
    "q_exception_files": """SELECT message, traceback, count(*) AS count,
            string_agg(DISTINCT node, ', ' ORDER BY node) AS nodes
        FROM (SELECT concat('message-', CAST(event_id % 5 AS VARCHAR)) AS message,
                concat('line-', CAST(event_id % 3 AS VARCHAR)) AS traceback,
                concat('node-', CAST(user_id % 4 AS VARCHAR)) AS node
            FROM events WHERE event_type = 'error') GROUP BY 1, 2""",
    "q_seq_delta": """SELECT poll_time, CAST(sum(grown) AS BIGINT) AS new_messages FROM (
            SELECT poll_time, greatest(0, coalesce(last_sequence - lag(last_sequence) OVER (
                PARTITION BY partition ORDER BY poll_time), 0)) AS grown
            FROM (SELECT user_id % 16 AS partition, date_trunc('hour', ts) AS poll_time,
                    CASE WHEN user_id % 16 = 3 AND hour(date_trunc('hour', ts)) = 0 THEN 0
                        ELSE max(event_id) END AS last_sequence
                FROM events GROUP BY user_id % 16, date_trunc('hour', ts)))
        GROUP BY poll_time""",
    "q_stats_file": "SELECT type, name, request_count, failure_count, median_response_time, p99_9 "
    f"FROM ({_stats('timed')})",
    "q_failure_files": """SELECT type AS method, name, exception AS error, count(*) AS occurrences
        FROM requests WHERE exception IS NOT NULL GROUP BY 1, 2, 3""",
    "q_sink_audit": """SELECT sink, CAST(3 AS BIGINT) AS finished, CAST(0 AS BIGINT) AS failed
        FROM (VALUES ('silver'), ('alert_state'), ('alert_history'), ('email_queue'),
            ('device_status'), ('alert_evaluation'), ('quarantine'), ('late_rows')) AS t(sink)""",
    "q_monitor": """SELECT count(*) AS input_rows, CAST(3 AS BIGINT) AS batches, TRUE AS timed
        FROM events""",
    "q_restart": """SELECT p.device_id, count(*) AS rows FROM parsed p
        JOIN device_master d ON p.device_id = d.device_id
        WHERE organization_id IN (SELECT organization_id FROM organization_master) GROUP BY 1""",
    "q_device_list": """SELECT device_name, device_id FROM device_master
        WHERE device_id >= 100 AND device_id < 800""",
    "q_steady": """SELECT records, rate, expected_rate,
            (rate - expected_rate) / expected_rate * 100 AS deviation_pct
        FROM (SELECT count(*) AS records, count(*) / 864000 AS rate,
                (SELECT count(DISTINCT device_id) FROM telemetry) / 38880 AS expected_rate
            FROM telemetry WHERE event_timestamp >= TIMESTAMP '2024-01-10'
                AND event_timestamp < TIMESTAMP '2024-01-20')""",
    "q_phase": "SELECT run, minute, records, phase FROM phased",
    "q_phase_summary": """SELECT run, phase, count(*) AS minutes,
            CAST(sum(records) AS BIGINT) AS records, min(records) AS min_records,
            max(records) AS max_records, min(minute) AS first_minute, max(minute) AS last_minute
        FROM phased GROUP BY 1, 2""",
    "q_sent_vs_stored": """SELECT device_id, sent, coalesce(stored, 0) AS stored,
            coalesce(stored, 0) - sent AS difference,
            (coalesce(stored, 0) - sent) / sent * 100 AS difference_pct
        FROM (SELECT device_id, count(*) AS sent FROM telemetry GROUP BY 1)
        LEFT JOIN (SELECT device_id, count(*) AS stored FROM mirror GROUP BY 1) USING (device_id)""",
    "q_run_change": f"""SELECT run, metric, value, previous,
            CASE WHEN previous <> 0 THEN (value - previous) / previous * 100 END AS change_pct
        FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY run) AS previous FROM (
            SELECT {_WEEK} AS run, 'sent' AS metric, CAST(count(*) AS DOUBLE) AS value
                FROM events GROUP BY 1
            UNION ALL SELECT {_WEEK}, 'devices', CAST(count(DISTINCT user_id) AS DOUBLE)
                FROM events GROUP BY 1
            UNION ALL SELECT {_WEEK}, 'errors',
                CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) FROM events GROUP BY 1))""",
    "q_ratio": f"""SELECT {_WEEK} AS run, count(*) FILTER (event_type = 'error') AS numerator,
            count(*) AS denominator, count(*) FILTER (event_type = 'error') / count(*) AS ratio
        FROM events GROUP BY 1""",
    "q_run_summary": f"""SELECT run, avg(connected) AS avg_connected,
            max(connected) AS max_connected, CAST(sum(errors) AS BIGINT) AS errors
        FROM (SELECT {_WEEK} AS run, CAST(ts AS DATE) AS d, count(DISTINCT user_id) AS connected,
                count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2)
        GROUP BY run""",
    "q_checks": "SELECT check_id, category, metric, value, verdict FROM verdict",
    "q_verdict_rollup": """SELECT coalesce(category, 'total') AS category,
            count(*) FILTER (verdict = 'pass') AS pass, count(*) FILTER (verdict = 'fail') AS fail,
            count(*) FILTER (verdict = 'caution') AS caution
        FROM verdict GROUP BY ROLLUP (category)""",
    "q_frames": """SELECT event_id, CAST(event_id % 5 AS INTEGER) AS msg_type,
            CAST(event_id % 300 AS INTEGER) AS msg_id,
            CASE WHEN event_id % 6 = 0 THEN 'NG' ELSE 'OK' END AS status FROM events""",
    "q_correlate": "SELECT * FROM correlated",
    "q_correlate_sliced": "SELECT * FROM correlated",
    "q_response_times": """SELECT client, result, count(*) AS n, min(latency_ms) AS min_ms,
            max(latency_ms) AS max_ms, CAST(sum(latency_ms) AS BIGINT) AS sum_ms
        FROM correlated GROUP BY 1, 2""",
    "q_device_dim": f"""SELECT device_id, device_name, device_model, organization_id,
            CAST(1 AS INTEGER) AS device_type_id, CAST(1 AS INTEGER) AS device_inventory_id,
            CAST(0 AS INTEGER) AS creator, CAST(0 AS INTEGER) AS modifier,
            CAST(NULL AS VARCHAR) AS mac_address, {_NOW} AS create_date, {_NOW} AS update_date,
            FALSE AS delete_flag, CAST(NULL AS VARCHAR) AS sim_id,
            CAST(NULL AS VARCHAR) AS software_version, CAST(NULL AS VARCHAR) AS device_location,
            CAST(NULL AS TIMESTAMP) AS certificate_expiration_date FROM fleet""",
    "q_prefix": "SELECT count(*) AS devices FROM named WHERE device_name LIKE 'loadtest-device-%'",
    "q_prefix_cleanup": """SELECT device_id, device_name FROM named
        WHERE device_name NOT LIKE 'loadtest-device-%'""",
    "q_buckets": """SELECT device_id, rn,
            CAST(least(CASE WHEN total // 16 > 0 THEN (rn - 1) // (total // 16) ELSE 15 END, 15)
                AS INTEGER) AS worker FROM ranked""",
    "q_fixed_ranges": """SELECT CAST(floor((device_id - 1) / 130) AS INTEGER) AS worker,
            count(*) AS devices, min(device_id) AS first_device, max(device_id) AS last_device
        FROM device_master GROUP BY 1""",
    "q_generate": _generated(),
    "q_generate_messages": """SELECT device_id, CAST(2 AS BIGINT) AS messages,
            CAST(1024 AS INTEGER) AS min_bytes, CAST(1024 AS INTEGER) AS max_bytes
        FROM device_master""",
    "q_stream_minutes": """SELECT date_trunc('minute', event_timestamp) AS minute,
        count(*) AS records, count(DISTINCT device_id) AS devices FROM telemetry GROUP BY 1""",
    "q_stream_checks": """SELECT check_id, metric, true AS measured,
            CASE WHEN metric = 'failure_rate' THEN 'pass' END AS verdict
        FROM checks WHERE metric IN ('batch_seconds', 'failure_rate')""",
    "q_reconcile_buckets": """SELECT coalesce(l.event_id, r.event_id) AS event_id,
            CASE WHEN r.event_id IS NULL THEN 'only_left' WHEN l.event_id IS NULL THEN 'only_right'
                ELSE 'differs' END AS side
        FROM telemetry l FULL JOIN (
            SELECT CASE WHEN event_id % 103 = 0 THEN event_id + 1000000000 ELSE event_id END AS event_id,
                device_id, CASE WHEN event_id % 107 = 0 THEN -1.0 ELSE external_temp END AS external_temp
            FROM telemetry WHERE event_id % 101 <> 0) r ON l.event_id = r.event_id
        WHERE l.event_id IS NULL OR r.event_id IS NULL OR l.device_id <> r.device_id
            OR l.external_temp IS DISTINCT FROM r.external_temp""",
    "q_distinct_windows": " UNION ALL ".join(
        f"""SELECT '{name}' AS window, time_bucket(INTERVAL '{name}', event_timestamp) AS window_start,
            count(*) AS records, count(DISTINCT device_id) AS devices, true AS within_bound
        FROM telemetry GROUP BY 2"""
        for name in ("10 minutes", "1 hour", "1 day")
    ),
    "q_variant_stored": f"SELECT event_id, {_SENSOR_LIST} FROM parsed",
    "q_catch_up": "SELECT part, slot, arrived, capacity, backlog FROM waiting",
    "q_catch_up_time": """SELECT part, max(backlog) AS highest,
            date_diff('minute', TIMESTAMP '2024-01-10 12:00:00', min(slot)
                FILTER (slot >= TIMESTAMP '2024-01-10 12:00:00' AND backlog = 0)) + 60 AS minutes
        FROM waiting GROUP BY part""",
    "q_minute_windows": """SELECT date_trunc('minute', event_timestamp) AS minute,
            count(*) AS records, count(DISTINCT device_id) AS devices FROM telemetry
        WHERE NOT (event_id % 50 = 0 AND event_timestamp < TIMESTAMP '2024-01-08') GROUP BY 1""",
    "q_late_rows": """SELECT event_id, device_id, event_timestamp, 1 AS times FROM telemetry
        WHERE event_id % 50 = 0 AND event_timestamp < TIMESTAMP '2024-01-08'
        UNION ALL SELECT event_id, device_id, event_timestamp, 1 FROM telemetry
        WHERE event_id % 70 = 0 AND event_timestamp >= TIMESTAMP '2024-01-10'
            AND event_timestamp < TIMESTAMP '2024-01-20'""",
    "q_state_stream": "SELECT * FROM replay",
    "q_stream_redelivery": """SELECT p.device_id, CAST(event_timestamp AS DATE) AS event_date, count(*) AS rows
        FROM parsed p JOIN device_master d ON p.device_id = d.device_id
        WHERE organization_id IN (SELECT organization_id FROM organization_master) GROUP BY ALL""",
    "q_stream_correlate": "SELECT * FROM correlated",
    "q_stream_silver": _SILVER
    + """ FROM parsed p JOIN device_master d ON p.device_id = d.device_id
        WHERE organization_id IN (SELECT organization_id FROM organization_master)""",
}


def _streamed_alerts() -> str:
    """The replay over the parsed messages instead of the telemetry."""
    text = _with_views("SELECT * FROM replay")
    parsed = (
        f"telemetry_all AS ({_VIEWS['telemetry']}), "
        f"flagged AS ({_VIEWS['flagged'].replace('FROM telemetry', 'FROM telemetry_all')}), "
        f"telemetry AS ({_VIEWS['parsed']}), "
    )
    text = text.replace(f"telemetry AS ({_VIEWS['telemetry']}), ", parsed)
    body = """SELECT alert_id, abnormal_start_time AS alert_occurrence_datetime,
        recovered_event_time AS alert_recovery_datetime,
        CAST(CASE WHEN recovered_event_time IS NULL THEN 1 ELSE 2 END AS INTEGER) AS alert_status_id,
        alert_value FROM replay"""
    return text.replace("SELECT * FROM replay", body)


def all_oracles() -> dict[str, str]:
    texts = {name: _with_views(body) for name, body in _QUERIES.items()}
    texts["q_stream_alerts"] = _streamed_alerts()
    texts["q_start_over"] = texts["q_stream_alerts"]
    texts["q_stream_funnel"] = texts["q_funnel"]
    return texts
