"""Expected results of the registered queries as plain SQL on the given tables.

The operators are stated anew here; only the column mapping of the events table is shared.
"""

from __future__ import annotations

from clickweir.sources.clicks import FIELDS

_EVENT = [
    "event_id", "event_type", "user_id", "session_id", "timestamp", "page_url", "referrer_url", "user_agent",
    "device_type", "browser", "os", "country", "city", "ip_address", "amount", "currency", "product_id", "category",
    "error_code", "response_time_ms", "status_code", "event_date",
]


def _names(columns):
    return ", ".join(f'"{name}"' for name in columns)


_SOURCE = """CASE WHEN referrer_url IS NULL OR referrer_url IN ('', '/', 'None') THEN 'direct'
    WHEN lower(referrer_url) LIKE '%google%' THEN 'organic'
    WHEN lower(referrer_url) LIKE '%facebook%' OR lower(referrer_url) LIKE '%twitter%'
      OR lower(referrer_url) LIKE '%linkedin%' OR lower(referrer_url) LIKE '%instagram%' THEN 'social'
    WHEN lower(referrer_url) LIKE '%email%' OR lower(referrer_url) LIKE '%newsletter%' THEN 'email'
    WHEN lower(referrer_url) LIKE '%bing%' OR lower(referrer_url) LIKE '%yahoo%' THEN 'organic'
    ELSE 'referral' END"""

_RT = "response_time_ms"
_NOW = "TIMESTAMP '2024-01-28 00:00:00'"


def _number(partition):
    return f'CAST(row_number() OVER (PARTITION BY {partition} ORDER BY "timestamp", event_id) AS BIGINT)'


def _visit_ids(rows, gap, ordered='ORDER BY "timestamp", event_id'):
    return f"""SELECT g.* EXCLUDE (opens), user_id || '-' || CAST(CAST(sum(opens) OVER (
            PARTITION BY user_id {ordered} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS VARCHAR) AS session_id
        FROM (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY user_id {ordered})
            < {gap} THEN 0 ELSE 1 END AS opens FROM {rows}) g"""


_SCORE = f"""greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE
    - 0.15::DOUBLE * ((user_id IS NULL OR trim(user_id) = '')::INT + (session_id IS NULL OR trim(session_id) = '')::INT)
    - CASE WHEN event_type NOT IN ('page_view', 'click', 'add_to_cart', 'purchase', 'login', 'logout', 'error', 'search')
        THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN device_type NOT IN ('desktop', 'mobile', 'tablet') THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN "timestamp" > {_NOW} THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN abs(epoch_us("timestamp") - epoch_us({_NOW})) > 604800000000 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN response_time_ms > 30000 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END))"""

_FLAGS = f"""nullif(concat_ws(',',
    CASE WHEN user_id IS NULL AND session_id IS NULL THEN 'missing:user_id,session_id'
         WHEN user_id IS NULL THEN 'missing:user_id' WHEN session_id IS NULL THEN 'missing:session_id' END,
    CASE WHEN event_type NOT IN ('page_view', 'click', 'add_to_cart', 'purchase', 'login', 'logout', 'error', 'search')
        THEN 'invalid_event_type:' || event_type END,
    CASE WHEN device_type NOT IN ('desktop', 'mobile', 'tablet') THEN 'invalid_device:' || device_type END,
    CASE WHEN "timestamp" > {_NOW} THEN 'future_timestamp' END,
    CASE WHEN abs(epoch_us("timestamp") - epoch_us({_NOW})) > 604800000000 THEN 'stale_timestamp' END,
    CASE WHEN response_time_ms > 30000 THEN 'high_response_time:' || CAST(response_time_ms AS VARCHAR) || 'ms' END), '')"""

_ENRICHED = """CAST(hour("timestamp") AS INT) AS hour_of_day, CAST(dayofweek("timestamp") + 1 AS INT) AS day_of_week,
    event_type = 'purchase' AS is_purchase_event, event_type = 'error' AS is_error_event"""


def _flag(rows, stats, rate="0.05", samples=10):
    """Anomaly columns for rows ``p`` with stats ``s``."""
    return f"""SELECT p.*, kind IS NOT NULL AS is_anomaly, kind AS anomaly_type,
            CASE kind WHEN 'error_rate_spike' THEN round(least(error_rate / {rate}::DOUBLE, 2.0::DOUBLE), 2)
                WHEN 'slow_response' THEN round((response_time_ms - rt_mean) / (rt_dev * 3.0::DOUBLE), 2) END AS anomaly_score
        FROM (SELECT r.*, {stats}.error_rate, {stats}.rt_mean, {stats}.rt_dev,
            CASE WHEN {stats}.n < {samples} THEN NULL
                 WHEN event_type = 'error' AND error_rate > {rate}::DOUBLE THEN 'error_rate_spike'
                 WHEN (response_time_ms - rt_mean) / rt_dev > 3.0::DOUBLE THEN 'slow_response' END AS kind
          FROM {rows} r JOIN {stats} USING (day)) p"""


def _stats(rows):
    return f"""SELECT day, count(*) AS n, count(*) FILTER (event_type = 'error') / count(*) AS error_rate,
        coalesce(avg(response_time_ms), 0.0) AS rt_mean,
        CASE WHEN stddev_samp(response_time_ms) > 0 THEN stddev_samp(response_time_ms) ELSE 1.0 END AS rt_dev
        FROM {rows} GROUP BY day"""


_STEPS = {
    "base": "SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "e": "SELECT " + ", ".join(f"{text} AS {name}" for name, text in FIELDS.items())
         + f""", ts AS "timestamp", k, strftime(ts, '%Y-%m-%d') AS event_date FROM base""",
    "m": f"SELECT *, {_SOURCE} AS traffic_source FROM e",
    "v": _visit_ids("m", "INTERVAL 6 HOUR"),
    # users and sessions missing, unknown types
    "b": """SELECT * REPLACE (CASE WHEN k % 11 <> 0 THEN user_id END AS user_id,
        CASE WHEN k % 13 <> 0 THEN session_id END AS session_id,
        CASE WHEN k % 17 = 0 THEN 'bogus' ELSE event_type END AS event_type) FROM v""",
    # repeats, then what survives ingestion
    "rep": """SELECT *, CAST(event_id AS BIGINT) AS num FROM b UNION ALL
        SELECT * REPLACE ("timestamp" + INTERVAL 1 SECOND AS "timestamp"), CAST(event_id AS BIGINT)
        FROM b WHERE CAST(event_id AS BIGINT) % 50 = 0""",
    "bz": """SELECT * REPLACE (CASE WHEN num % 19 <> 0 THEN response_time_ms END AS response_time_ms,
        strftime("timestamp", '%Y-%m-%d') AS event_date) FROM rep WHERE num % 97 <> 0""",
    "dd": """SELECT * FROM bz QUALIFY row_number() OVER (PARTITION BY event_date, event_id ORDER BY "timestamp") = 1""",
    "sc": f"""SELECT {_names(_EVENT)}, {_ENRICHED}, traffic_source, event_date AS day,
        {_number('event_date, session_id')} AS event_number_in_session,
        {_SCORE} AS quality_score, {_FLAGS} AS quality_flags FROM dd""",
    "ps": "SELECT * FROM sc WHERE quality_score >= 0.5",
    "pstats": _stats("ps"),
    "sv": _flag("ps", "pstats"),
    # all events as one batch
    "one": "SELECT *, 1 AS day FROM e",
    "onestats": _stats("one"),
    "vday": "SELECT *, 1 AS day FROM v",
    "vstats": _stats("vday"),
    "fl": _flag("vday", "vstats"),
}

# What each step reads.
_NEEDS = {
    "e": ["base"], "m": ["e"], "v": ["m"], "b": ["v"], "rep": ["b"], "bz": ["rep"], "dd": ["bz"], "sc": ["dd"],
    "ps": ["sc"], "pstats": ["ps"], "sv": ["ps", "pstats"], "one": ["e"], "onestats": ["one"], "vday": ["v"],
    "vstats": ["vday"], "fl": ["vday", "vstats"],
}


def _sql(body, *steps, **own):
    """``body`` after the named steps, everything they read, and steps of its own."""
    wanted = []

    def add(step):
        for need in _NEEDS.get(step, []):
            add(need)
        if step not in wanted:
            wanted.append(step)

    for step in steps:
        add(step)
    ctes = [f"{step} AS ({_STEPS[step]})" for step in wanted] + [f"{name} AS ({text})" for name, text in own.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body


def _bucket(width, ts='"timestamp"'):
    return f"time_bucket(INTERVAL {width}, {ts}, TIMESTAMP '1970-01-01')"


def _kpis(rows, per_day=False):
    """KPIs over windowed rows ``w`` (with ``win``, ``win_end`` columns) and sessions of ``rows``."""
    return f"""SELECT win AS window_start, any_value(win_end) AS window_end, any_value(label) AS window_duration,
        strftime(win, '%Y-%m-%d') AS event_date, CAST(hour(win) AS INT) AS hour,
        count(*) FILTER (event_type IN ('page_view','click','add_to_cart','purchase','login','error','search')) AS total_events,
        count(*) FILTER (event_type = 'page_view') AS page_views, count(*) FILTER (event_type = 'click') AS clicks,
        count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts, count(*) FILTER (event_type = 'purchase') AS purchases,
        count(*) FILTER (event_type = 'login') AS logins, count(*) FILTER (event_type = 'error') AS errors,
        count(*) FILTER (event_type = 'search') AS searches, count(DISTINCT user_id) AS unique_users,
        count(DISTINCT session_id) AS unique_sessions, round(avg(response_time_ms), 6) AS avg_response_time_ms,
        CAST(quantile_disc(response_time_ms, 0.95) AS DOUBLE) AS p95_response_time_ms,
        CAST(max(response_time_ms) AS DOUBLE) AS max_response_time_ms,
        CASE WHEN total_events > 0 THEN round(errors / total_events, 4) ELSE 0.0 END AS error_rate,
        CASE WHEN total_events > 0 THEN round(purchases / total_events, 4) ELSE 0.0 END AS purchase_rate,
        CASE WHEN page_views > 0 THEN round(purchases / page_views, 4) ELSE 0.0 END AS conversion_rate,
        round(sum(CASE WHEN event_type = 'purchase' THEN amount ELSE 0.0 END), 6) AS revenue_total,
        CAST(round(CAST(avg(amount) FILTER (event_type = 'purchase') AS DECIMAL(38, 9)), 6) AS DOUBLE) AS revenue_avg,
        CASE WHEN unique_sessions > 0 THEN round(count(*) FILTER (in_session <= 1) / unique_sessions, 4) ELSE 0.0 END AS bounce_rate,
        {_NOW} AS processed_at FROM w GROUP BY win"""


def _windowed(rows, width, label, per_day=False):
    day = "event_date, " if per_day else ""
    return f"""SELECT *, {_bucket(width)} AS win, {_bucket(width)} + INTERVAL {width} AS win_end, '{label}' AS label,
        CASE WHEN session_id IS NOT NULL THEN count(event_id) OVER (PARTITION BY {day}session_id) END AS in_session FROM {rows}"""


def _sessions(rows, per_day=False):
    day = "event_date, " if per_day else ""
    part = f'PARTITION BY {day}session_id ORDER BY "timestamp", event_id'
    return f"""SELECT session_id, any_value(user_id) FILTER (first = 1) AS user_id, min("timestamp") AS session_start,
        max("timestamp") AS session_end,
        round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1000000.0::DOUBLE, 6) AS session_duration_seconds,
        count(event_id) AS event_count, count(*) FILTER (event_type = 'page_view') AS page_view_count,
        count(*) FILTER (event_type = 'click') AS click_count, count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart_count,
        count(*) FILTER (event_type = 'purchase') AS purchase_count, count(*) FILTER (event_type = 'error') AS error_count,
        count(*) FILTER (event_type = 'purchase') > 0 AS has_purchased,
        round(sum(CASE WHEN event_type = 'purchase' THEN amount ELSE 0.0 END), 6) AS total_revenue,
        any_value(page_url) FILTER (first = 1) AS entry_page, any_value(page_url) FILTER (last = 1) AS exit_page,
        any_value(traffic_source) FILTER (first = 1) AS entry_traffic_source,
        any_value(device_type) FILTER (first = 1) AS device_type, any_value(browser) FILTER (first = 1) AS browser,
        any_value(os) FILTER (first = 1) AS os, any_value(country) FILTER (first = 1) AS country,
        count(event_id) <= 1 AS is_bounced, any_value(event_date) FILTER (first = 1) AS event_date, {_NOW} AS processed_at
        FROM (SELECT *, row_number() OVER ({part}) AS first,
            row_number() OVER ({part.replace('"timestamp", event_id', '"timestamp" DESC, event_id DESC')}) AS last
          FROM {rows} WHERE session_id IS NOT NULL)
        GROUP BY {day}session_id"""


def _steps(rows):
    return f"""SELECT {_bucket('24 HOUR')} AS window_start, event_type AS funnel_step,
        CAST(CASE event_type WHEN 'page_view' THEN 1 WHEN 'click' THEN 2 WHEN 'add_to_cart' THEN 3 ELSE 4 END AS INT) AS step_order,
        count(DISTINCT user_id) AS unique_users, count(event_id) AS event_count
        FROM {rows} WHERE event_type IN ('page_view', 'click', 'add_to_cart', 'purchase') GROUP BY 1, 2"""


_FUNNELS = f"""SELECT c.window_start, c.window_start + INTERVAL 24 HOUR AS window_end, '24h' AS window_duration,
    strftime(c.window_start, '%Y-%m-%d') AS event_date, c.funnel_step, c.step_order, c.unique_users, c.event_count,
    CASE WHEN c.unique_users > 0 THEN round(n.unique_users / c.unique_users, 4) END AS conversion_to_next,
    c.unique_users - n.unique_users AS drop_off_count,
    CASE WHEN c.unique_users > 0 THEN round((c.unique_users - n.unique_users) / c.unique_users, 4) END AS drop_off_rate,
    {_NOW} AS processed_at
    FROM steps c LEFT JOIN steps n ON c.window_start = n.window_start AND c.step_order = n.step_order - 1"""


def _summary(rows):
    return f"""SELECT {_bucket('1 HOUR')} AS window_start, {_bucket('1 HOUR')} + INTERVAL 1 HOUR AS window_end,
        '1h' AS window_duration, strftime({_bucket('1 HOUR')}, '%Y-%m-%d') AS event_date, anomaly_type,
        count(event_id) AS anomaly_count, round(avg(anomaly_score), 6) AS avg_anomaly_score,
        max(anomaly_score) AS max_anomaly_score,
        CASE WHEN count(*) >= 100 THEN 'critical' WHEN count(*) >= 50 THEN 'high' WHEN count(*) >= 10 THEN 'medium'
            ELSE 'low' END AS severity,
        CASE anomaly_type WHEN 'error_rate_spike' THEN 'error_rate' WHEN 'slow_response' THEN 'response_time_ms'
            ELSE anomaly_type END AS triggering_metric,
        CAST(CASE anomaly_type WHEN 'slow_response' THEN max(response_time_ms) ELSE count(*) END AS DOUBLE) AS metric_value,
        CAST(CASE anomaly_type WHEN 'error_rate_spike' THEN 0.05 WHEN 'slow_response' THEN 3.0 ELSE 1 END AS DOUBLE)
            AS metric_threshold, {_NOW} AS processed_at
        FROM {rows} WHERE is_anomaly GROUP BY anomaly_type, {_bucket('1 HOUR')}"""


_ISO = """strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us("timestamp") % 1000000 > 0
    THEN '.' || lpad(CAST(epoch_us("timestamp") % 1000000 AS VARCHAR), 6, '0') ELSE '' END"""

_MESSAGE = """CASE anomaly_type WHEN 'error_rate_spike'
    THEN 'Error rate spike detected: anomaly_score=' || printf('%.2f', coalesce(anomaly_score, 0.0)) || ', event_type=' || event_type
    WHEN 'slow_response' THEN 'Slow response detected: ' || CAST(coalesce(response_time_ms, 0) AS VARCHAR)
        || 'ms, anomaly_score=' || printf('%.2f', coalesce(anomaly_score, 0.0)) || ', event_id=' || event_id
    ELSE 'Anomaly detected: type=' || anomaly_type || ', score=' || printf('%.2f', coalesce(anomaly_score, 0.0))
        || ', event_id=' || event_id END"""


def _alerts(rows):
    return f"""SELECT 'alert-' || event_id || '-1706400000' AS alert_id, event_id, anomaly_type,
        nullif(anomaly_score, 0.0) AS anomaly_score, event_type, {_ISO} AS "timestamp",
        '2024-01-28T00:00:00+00:00' AS detected_at, response_time_ms, CAST(error_code AS INT) AS error_code,
        {_MESSAGE} AS message FROM {rows} WHERE is_anomaly"""


_FEED = f"""SELECT a.*, s.severity FROM al a LEFT JOIN sm s
    ON s.window_start = time_bucket(INTERVAL 1 HOUR, CAST(a."timestamp" AS TIMESTAMP)) AND s.anomaly_type = a.anomaly_type"""


def _hist(values, bins):
    """Zero-filled bins over ``x`` (values ``v``)."""
    return f"""SELECT CAST(i AS INT) AS bin, round(lo + (hi - lo) / n * (i - 1), 6) AS bin_start,
        round(lo + (hi - lo) / n * i, 6) AS bin_end, coalesce(c, 0) AS count
        FROM (SELECT lo, hi, n, unnest(range(1, n + 1)) AS i FROM lim)
        LEFT JOIN (SELECT CASE WHEN hi = lo THEN 1
              ELSE least(CAST(floor((v - lo) / (hi - lo) * n) AS BIGINT) + 1, n) END AS place, count(*) AS c
            FROM ({values}) x CROSS JOIN lim GROUP BY 1) ON place = i"""


def _lim(values, bins):
    return f"SELECT min(v) AS lo, max(v) AS hi, CAST({bins} AS BIGINT) AS n FROM ({values}) x"


def _bronze_columns(rows):
    return f"SELECT {_names(_EVENT)} FROM {rows}"


def statements() -> dict[str, str]:
    out = {}
    event_columns = _names(_EVENT)
    raw_columns = [name for name in _EVENT if name != "event_date"]

    # -- sources and sinks
    texts = {name: f'CAST("{name}" AS VARCHAR)' for name in raw_columns}
    texts["timestamp"] = """CASE WHEN num % 97 = 0 AND (num // 97) % 4 = 2 THEN 'not a time'
        ELSE strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') END"""
    texts["response_time_ms"] = "CASE WHEN num % 19 = 0 THEN 'n/a' ELSE CAST(response_time_ms AS VARCHAR) END"
    texts["event_id"] = "CASE WHEN num % 97 <> 0 OR (num // 97) % 4 <> 0 THEN event_id END"
    texts["event_type"] = "CASE WHEN num % 97 = 0 AND (num // 97) % 4 = 1 THEN '' ELSE event_type END"
    broken = "num % 97 = 0 AND (num // 97) % 4 = 3"
    out["s3_parse_json"] = _sql(
        "SELECT " + ", ".join(f'CASE WHEN NOT ({broken}) THEN {text} END AS "{name}"' for name, text in texts.items())
        + " FROM rep", "rep")
    out["s2_jsonl_source"] = out["s3_parse_json"]
    out["s4_bronze_table"] = _sql(_bronze_columns("bz"), "bz")
    out["t1_bronze_stream"] = out["s4_bronze_table"]
    out["s5_dead_letters"] = _sql("""SELECT CASE WHEN (num // 97) % 4 IN (1, 2) THEN event_id END AS event_id,
        CASE (num // 97) % 4 WHEN 3 THEN NULL WHEN 1 THEN '' ELSE event_type END AS event_type,
        CASE WHEN (num // 97) % 4 IN (0, 1) THEN "timestamp" END AS "timestamp",
        CASE (num // 97) % 4 WHEN 1 THEN 'missing_event_type' WHEN 2 THEN 'invalid_timestamp' ELSE 'missing_event_id' END
            AS error_reason, '2024-01-28T00:00:00+00:00' AS error_timestamp, true AS has_raw
        FROM rep WHERE num % 97 = 0""", "rep")
    silver_columns = f"""{event_columns}, hour_of_day, day_of_week, is_purchase_event, is_error_event, traffic_source,
        event_number_in_session, round(quality_score, 6) AS quality_score, quality_flags"""
    load = f"{_NOW} AS processed_at, '1.0.0' AS silver_version"
    out["s6_silver_table"] = _sql(f"SELECT {silver_columns}, is_anomaly, anomaly_type, anomaly_score, {load} FROM sv", "sv")
    out["t4_live_silver"] = out["s6_silver_table"]
    out["s7_quarantine_table"] = _sql(f"SELECT {silver_columns}, {load} FROM sc WHERE quality_score < 0.5", "sc")
    out["s8_gold_kpis_table"] = _sql(_kpis("sv", True), "sv", w=_windowed("sv", "1 HOUR", "1h", True))
    out["s8_gold_sessions_table"] = _sql(_sessions("sv", True), "sv")
    out["s8_gold_funnels_table"] = _sql(_FUNNELS, "sv", steps=_steps("sv"))
    out["s8_gold_anomalies_table"] = _sql(_summary("sv"), "sv")
    out["s9_alert_sink"] = _sql("SELECT alert_id AS key, event_id, message FROM al", "sv", al=_alerts("sv"))
    out["s10_read_bronze_date"] = _sql(_bronze_columns("bz") + " WHERE event_date = '2024-01-15'", "bz")
    out["s11_read_silver_range"] = (
        out["s6_silver_table"] + " WHERE event_date BETWEEN '2024-01-10' AND '2024-01-12'")
    out["s12_latest_date"] = _sql(
        _bronze_columns("bz") + " WHERE event_date = (SELECT max(event_date) FROM bz)", "bz")
    out["s12_latest_date_of_frame"] = _sql("SELECT max(event_date) AS event_date FROM e", "e")
    out["s13_missing_table"] = "SELECT 'events' AS stage, count(*) AS rows FROM events UNION ALL SELECT 'missing', 0"
    out["s14_create_table"] = _sql("SELECT event_date, count(*) AS rows FROM e GROUP BY 1", "e")

    # -- columns and filters
    # Of the spoilt lines some lack the id, some the type, some have a bad time, some are broken throughout.
    way = "CASE WHEN num % 97 = 0 THEN (num // 97) % 4 ELSE -1 END"
    spoilt = f"""SELECT CASE WHEN way NOT IN (0, 3) THEN event_id END AS event_id, way,
        CASE WHEN way <> 3 THEN amount END AS amount, CASE WHEN way <> 3 THEN CAST(error_code AS INT) END AS error_code,
        CASE WHEN way <> 3 AND num % 19 <> 0 THEN response_time_ms END AS response_time_ms,
        CASE WHEN way <> 3 THEN CAST(status_code AS INT) END AS status_code,
        CASE WHEN way NOT IN (2, 3) THEN "timestamp" END AS "timestamp" FROM (SELECT *, {way} AS way FROM rep)"""
    out["p1_numeric_coercion"] = _sql(
        "SELECT event_id, amount, error_code, response_time_ms, status_code FROM sp", "rep", sp=spoilt)
    out["p2_timestamp_coercion"] = _sql('SELECT event_id, "timestamp" FROM sp', "rep", sp=spoilt)
    out["p3_event_date"] = "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d') AS event_date FROM events"
    out["p4_clean_split"] = _sql("""SELECT CASE WHEN num % 97 <> 0 THEN 'clean' WHEN (num // 97) % 4 = 1
        THEN 'missing_event_type' WHEN (num // 97) % 4 = 2 THEN 'invalid_timestamp' ELSE 'missing_event_id' END
        AS error_reason, count(*) AS rows FROM rep GROUP BY 1""", "rep")
    out["p5_p6_p7_enrichment"] = _sql(f"SELECT event_id, {_ENRICHED} FROM e", "e")
    out["p8_traffic_source"] = _sql("SELECT event_id, referrer_url, traffic_source FROM m", "m")
    out["p9_quality_score"] = _sql(
        f"SELECT event_id, round({_SCORE}, 6) AS quality_score, {_FLAGS} AS quality_flags FROM b", "b")
    out["p10_quality_split"] = _sql(
        f"SELECT event_id, CASE WHEN {_SCORE} >= 0.5 THEN 'passed' ELSE 'quarantined' END AS part FROM b", "b")
    out["p11_p12_conform_and_stamp"] = _sql(f"""SELECT {event_columns}, {_ENRICHED}, traffic_source,
        {_number('session_id')} AS event_number_in_session, round({_SCORE}, 6) AS quality_score, {_FLAGS} AS quality_flags,
        false AS is_anomaly, CAST(NULL AS VARCHAR) AS anomaly_type, CAST(NULL AS DOUBLE) AS anomaly_score, {load}
        FROM b""", "b")
    widths = {"5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "6h": 21600, "24h": 86400, "2h": 7200, "90s": 90}
    out["p13_window_widths"] = " UNION ALL ".join(
        f"SELECT '{label}' AS label, count(DISTINCT epoch_us(ts) // {s * 1_000_000}) AS windows FROM events"
        for label, s in widths.items())

    # -- windows and joins
    out["w1_deduplicate"] = _sql('SELECT event_id, "timestamp", event_type FROM e', "e")
    out["w2_event_number"] = _sql(
        f"SELECT event_id, session_id, {_number('session_id')} AS event_number_in_session FROM b", "b")
    out["w3_w4_first_and_last"] = _sql("""SELECT session_id, entry_page, exit_page, entry_traffic_source, device_type,
        browser, os, country, user_id, event_date FROM s""", "v", s=_sessions("v"))
    gaps = """SELECT * REPLACE (CASE WHEN event_type = 'click' AND event_date >= '2024-01-10' THEN 'error'
        ELSE event_type END AS event_type) FROM e"""
    out["w5_next_step"] = _sql(f"""SELECT window_start, funnel_step, unique_users, conversion_to_next, drop_off_count,
        drop_off_rate FROM ({_FUNNELS}) f""", "e", g=gaps, steps=_steps("g"))
    out["w6_visits"] = _sql("SELECT event_id, session_id FROM v", "v")
    out["w6_visits_half_hour"] = _sql("SELECT event_id, session_id FROM h", "m", h=_visit_ids("m", "INTERVAL 30 MINUTE"))
    out["j1_bounced_events"] = _sql(
        "SELECT win AS window_start, count(*) AS bounce_count FROM w WHERE in_session <= 1 GROUP BY 1",
        "b", w=_windowed("b", "1 HOUR", "1h"))

    # -- aggregations
    out["a1_kpis_hourly"] = _sql(_kpis("b"), "b", w=_windowed("b", "1 HOUR", "1h"))
    out["a1_kpis_five_minutes"] = _sql(_kpis("b"), "b", w=_windowed("b", "5 MINUTE", "5m"))
    out["a1_kpis_estimated"] = _sql(
        """SELECT * EXCLUDE (unique_users, unique_sessions, bounce_rate), true AS unique_users_close,
        true AS unique_sessions_close, CAST(round(bounce_rate * unique_sessions) AS BIGINT) AS bounced FROM kp""", "b",
        w=_windowed("b", "1 HOUR", "1h"), kp=_kpis("b"))
    out["a3_funnels_estimated"] = _sql(
        "SELECT window_start, funnel_step, event_count, true AS unique_users_close FROM steps", "v", steps=_steps("v"))
    out["a2_sessions"] = _sql(_sessions("v"), "v")
    out["a3_funnels_daily"] = _sql(_FUNNELS, "v", steps=_steps("v"))
    out["a4_anomaly_summary"] = _sql(_summary("fl"), "fl")
    out["a5_tumbling_windows"] = _sql(
        f"SELECT {_bucket('7 HOUR')} AS window_start, count(*) AS events FROM e GROUP BY 1", "e")
    out["s8_kpis_rolled_up"] = _sql(
        """SELECT * EXCLUDE (unique_users, unique_sessions, bounce_rate, p95_response_time_ms), true AS unique_users_close,
        true AS unique_sessions_close, true AS p95_close, CAST(round(bounce_rate * unique_sessions) AS BIGINT) AS bounced
        FROM kp""", "b", w=_windowed("b", "1 HOUR", "1h"), kp=_kpis("b"))
    out["a6_kpis_sliding"] = out["a6_kpis_by_panes"] = _sql(
        _kpis("b"), "b", q=_windowed("b", "15 MINUTE", "1h"),
        w="""SELECT * REPLACE (win - i * INTERVAL 15 MINUTE AS win, win + INTERVAL 1 HOUR - i * INTERVAL 15 MINUTE AS win_end)
            FROM q CROSS JOIN (SELECT unnest(range(0, 4)) AS i)""")
    out["a7_a8_batch_stats"] = _sql("""SELECT n AS rows, round(error_rate, 6) AS error_rate, round(rt_mean, 6) AS rt_mean,
        round(rt_dev, 6) AS rt_dev FROM onestats""", "onestats")

    # -- anomalies and alerts
    flags = "SELECT event_id, is_anomaly, anomaly_type, anomaly_score FROM f"
    out["d1_min_samples"] = _sql(flags, "onestats", f=_flag("one", "onestats", samples=1_000_000_000))
    out["d2_d4_error_spike"] = _sql(flags, "onestats", f=_flag("one", "onestats"))
    out["d3_d4_slow_response"] = _sql(flags, "onestats", f=_flag("one", "onestats", rate="0.25"))
    al = _alerts("fl")
    out["d5_d6_alert_rows"] = _sql("SELECT * FROM al", "fl", al=al)
    out["d7_min_score"] = _sql(
        "SELECT alert_id, anomaly_score FROM al WHERE coalesce(anomaly_score, 0) >= 1.5", "fl", al=al)
    order = "ORDER BY anomaly_score DESC NULLS LAST, alert_id"
    out["d8_top_alerts"] = _sql(f"SELECT alert_id, anomaly_score FROM al {order} LIMIT 50", "fl", al=al)
    out["d8_alerts_cut"] = _sql("SELECT count(*) AS total, greatest(count(*) - 50, 0) AS cut FROM al", "fl", al=al)
    out["d9_score_bands"] = _sql("""SELECT alert_id, CASE WHEN anomaly_score >= 0.8 THEN 'red'
        WHEN anomaly_score >= 0.5 THEN 'orange' ELSE 'yellow' END AS band FROM al""", "fl", al=al)
    out["d10_alert_digest"] = _sql(f"""SELECT (SELECT count(*) FROM al) AS total,
        CAST((SELECT count(*) FROM al) AS VARCHAR) || ' Anomaly Alert(s) Detected' AS title,
        coalesce((SELECT string_agg(alert_id || ': ' || message, chr(10) {order})
            FROM (SELECT * FROM al {order} LIMIT 10)), '') AS messages""", "fl", al=al)
    per5 = f"""SELECT {_bucket('5 MINUTE')} AS win, count(*) AS c,
        count(*) FILTER (event_type = 'purchase') AS p FROM e GROUP BY 1"""
    spine = """SELECT win, coalesce(c, 0) AS c, coalesce(p, 0) AS p FROM
        (SELECT unnest(generate_series((SELECT min(win) FROM per5), (SELECT max(win) FROM per5), INTERVAL 5 MINUTE)) AS win)
        LEFT JOIN per5 USING (win)"""
    out["d11_traffic_spikes"] = _sql("""SELECT win AS window_start, c AS event_count, round(a, 6) AS rolling_avg,
        coalesce(c > a * 3, false) AS is_spike FROM (SELECT win, c,
            avg(c) OVER (ORDER BY win ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS a FROM spine) WHERE c > 0""",
        "e", per5=per5, spine=spine)
    out["d12_purchase_drops"] = _sql("""SELECT win AS window_start, p AS purchases, q AS previous_purchases,
        CASE WHEN q > 0 THEN round(1 - p / q, 6) END AS drop_rate, coalesce(1 - p / q > 0.5 AND q > 0, false) AS is_drop
        FROM (SELECT win, p, coalesce(lag(p) OVER (ORDER BY win), 0) AS q FROM spine) WHERE p > 0 OR q > 0""",
        "e", per5=per5, spine=spine)
    out["d13_slow_windows"] = _sql(f"""SELECT {_bucket('5 MINUTE')} AS window_start,
        quantile_disc(response_time_ms, 0.99) AS p99_response_time_ms,
        quantile_disc(response_time_ms, 0.99) > 5000 AS is_slow FROM e GROUP BY 1""", "e")
    per5 = f"""SELECT {_bucket('5 MINUTE')} AS win, count(*) AS c, count(*) FILTER (event_type = 'purchase') AS p,
        quantile_disc(response_time_ms, 0.99) AS q FROM sv GROUP BY 1"""
    spine = """SELECT win, coalesce(c, 0) AS c, coalesce(p, 0) AS p, q FROM
        (SELECT unnest(generate_series((SELECT min(win) FROM per5), (SELECT max(win) FROM per5), INTERVAL 5 MINUTE)) AS win)
        LEFT JOIN per5 USING (win)"""
    seen = """SELECT *, avg(c) OVER (ORDER BY win ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS a,
        coalesce(lag(p) OVER (ORDER BY win), 0) AS b FROM spine"""
    judged = """SELECT win, 'traffic_spike' AS kind, c AS v, a AS base, a * 3 AS lim, c > a * 3 AS hit,
            CASE WHEN a > 0 THEN c / (a * 3) END AS s FROM seen WHERE c > 0
        UNION ALL SELECT win, 'purchase_drop', p, b, b * 0.5::DOUBLE, b > 0 AND 1 - p / b > 0.5::DOUBLE,
            CASE WHEN b > 0 THEN (1 - p / b) / 0.5::DOUBLE END FROM seen WHERE p > 0 OR b > 0
        UNION ALL SELECT win, 'slow_window', q, NULL, 5000.0::DOUBLE, q > 5000, q / 5000.0::DOUBLE FROM seen WHERE q IS NOT NULL"""
    trend = """SELECT win AS window_start, win + INTERVAL 5 MINUTE AS window_end, '5m' AS window_duration,
        strftime(win, '%Y-%m-%d') AS event_date, kind AS trend_type, v::DOUBLE AS metric_value, base::DOUBLE AS baseline,
        lim AS metric_threshold, CASE WHEN lim > 0 THEN least(s, 2.0::DOUBLE) WHEN hit THEN 2.0::DOUBLE END AS trend_score,
        coalesce(hit, false) AS is_triggered FROM judged"""
    steps = {"per5": per5, "spine": spine, "seen": seen, "judged": judged, "trend": trend}
    out["d11_d13_trend_table"] = _sql("""SELECT * REPLACE (round(baseline, 6) AS baseline,
        round(metric_threshold, 6) AS metric_threshold, round(trend_score, 6) AS trend_score) FROM trend""", "sv", **steps)
    since = "strftime(window_start, '%Y-%m-%dT%H:%M:%S')"
    out["d11_d13_trend_alerts"] = _sql(f"""SELECT concat_ws('-', 'alert', trend_type, '5m',
            CAST(epoch(window_start) AS BIGINT), CAST(epoch({_NOW}) AS BIGINT)) AS key, event_date,
        trend_type AS anomaly_type, round(trend_score, 6) AS anomaly_score,
        CASE trend_type WHEN 'purchase_drop' THEN 'purchase' END AS event_type, {since} AS timestamp,
        CASE trend_type WHEN 'slow_window' THEN CAST(metric_value AS INT) END AS response_time_ms,
        CASE trend_type
            WHEN 'traffic_spike' THEN format('Traffic spike detected: {{:.0f}} events in 5m from {{}}, on average {{:.1f}} before',
                metric_value, {since}, round(baseline, 1))
            WHEN 'purchase_drop' THEN format('Purchase drop detected: {{:.0f}} purchases in 5m from {{}}, {{:.0f}} before',
                metric_value, {since}, baseline)
            ELSE format('Slow responses detected: 99th percentile {{:.0f}}ms in 5m from {{}}', metric_value, {since}) END AS message
        FROM trend WHERE is_triggered""", "sv", **steps)

    # -- rollups
    s = _sessions("v")
    out["r1_overview"] = _sql("""SELECT count(*) AS total_events, count(DISTINCT user_id) AS total_users,
        count(DISTINCT session_id) AS total_sessions, count(*) FILTER (event_type = 'purchase') AS total_purchases,
        round(sum(amount), 6) AS total_revenue,
        round(count(*) FILTER (event_type = 'purchase') / count(*) FILTER (event_type = 'page_view') * 100, 6) AS conversion_rate_pct,
        round(count(*) / count(DISTINCT session_id), 6) AS avg_events_per_session,
        (SELECT round(avg(is_bounced::INT) * 100, 6) FROM s) AS bounce_rate_pct,
        round(count(*) FILTER (event_type = 'error') / count(*) * 100, 6) AS error_rate_pct,
        round(avg(response_time_ms), 6) AS avg_response_time_ms,
        round(quantile_cont(response_time_ms, 0.95), 6) AS p95_response_time_ms FROM v""", "v", s=s)
    out["r2_stage_counts"] = _sql("""SELECT 'bronze' AS stage, count(*) AS rows FROM bz
        UNION ALL SELECT 'silver', count(*) FROM ps UNION ALL SELECT 'quarantine', count(*) FROM sc WHERE quality_score < 0.5
        UNION ALL SELECT 'gold_kpis', count(DISTINCT date_trunc('hour', "timestamp")) FROM ps
        UNION ALL SELECT 'gold_sessions', count(DISTINCT event_date || session_id) FROM ps""", "ps")
    out["r3_hourly_timeline"] = _sql("""SELECT hour_start, count(event_id) AS event_count,
        round(coalesce(sum(amount), 0.0), 6) AS revenue FROM (SELECT unnest(generate_series(
            (SELECT date_trunc('hour', min("timestamp")) FROM e), (SELECT date_trunc('hour', max("timestamp")) FROM e),
            INTERVAL 1 HOUR)) AS hour_start)
        LEFT JOIN e ON date_trunc('hour', "timestamp") = hour_start GROUP BY 1""", "e")
    out["r4_event_types"] = _sql("SELECT event_type, count(*) AS count FROM e GROUP BY 1", "e")
    hourly = _windowed("v", "1 HOUR", "1h")
    out["r5_kpi_trend"] = _sql("""SELECT window_start, metric, value FROM (
        SELECT window_start, 'total_events' AS metric, CAST(total_events AS DOUBLE) AS value FROM kp
        UNION ALL SELECT window_start, 'unique_users', CAST(unique_users AS DOUBLE) FROM kp
        UNION ALL SELECT window_start, 'error_rate', error_rate FROM kp
        UNION ALL SELECT window_start, 'revenue_total', revenue_total FROM kp)""", "v", w=hourly, kp=_kpis("v"))
    out["r6_latest_window"] = _sql("SELECT * FROM kp ORDER BY window_start DESC LIMIT 1", "v", w=hourly, kp=_kpis("v"))
    rts = "SELECT CAST(response_time_ms AS DOUBLE) AS v FROM e"
    out["r7_response_histogram"] = _sql(f"""SELECT h.*, round(m.median, 6) AS median, round(m.p95, 6) AS p95
        FROM ({_hist(rts, 50)}) h CROSS JOIN (SELECT quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.95) AS p95
        FROM ({rts}) r) m""", "e", lim=_lim(rts, 50))
    out["r8_traffic_sources"] = _sql("SELECT traffic_source, count(*) AS count FROM m GROUP BY 1", "m")
    out["r9_session_summary"] = _sql("""SELECT count(*) AS total_sessions, count(*) FILTER (is_bounced) AS bounced,
        count(*) FILTER (has_purchased) AS with_purchase, round(avg(session_duration_seconds), 6) AS avg_duration_seconds,
        round(avg(event_count), 6) AS avg_events, round(avg(is_bounced::INT) * 100, 6) AS bounce_rate_pct FROM s""", "v", s=s)
    cap = """SELECT quantile_cont(session_duration_seconds, 0.5) AS median,
        quantile_cont(session_duration_seconds, 0.99) AS cap FROM s"""
    capped = "SELECT least(session_duration_seconds, cap) AS v FROM s CROSS JOIN q"
    out["r10_duration_histogram"] = _sql(f"""SELECT h.*, round(q.median, 6) AS median, round(q.cap, 6) AS cap
        FROM ({_hist(capped, 40)}) h CROSS JOIN q""", "v", s=s, q=cap, lim=_lim(capped, 40))
    out["r11_session_devices"] = _sql("SELECT device_type, count(*) AS sessions FROM s GROUP BY 1", "v", s=s)
    hours = ", ".join(f"""count(*) FILTER (hour("timestamp") = {h}) AS h{h:02d}""" for h in range(24))
    out["r12_activity_heatmap"] = _sql(f"""SELECT CAST(isodow("timestamp") AS INT) AS weekday,
        dayname("timestamp") AS day_name, {hours} FROM e GROUP BY 1, 2""", "e")
    out["r13_session_countries"] = _sql("SELECT country, count(*) AS sessions FROM s GROUP BY 1", "v", s=s)
    totals = """SELECT funnel_step, step_order, CAST(sum(unique_users) AS BIGINT) AS unique_users,
        CAST(sum(event_count) AS BIGINT) AS event_count FROM steps GROUP BY 1, 2"""
    out["r14_overall_funnel"] = _sql("SELECT * FROM t", "v", steps=_steps("v"), t=totals)
    out["r15_overall_conversion"] = _sql("""SELECT *, coalesce(round(lead(unique_users) OVER (ORDER BY step_order)
            / unique_users * 100, 1), 0.0) AS conversion_to_next_pct,
        coalesce(unique_users - lead(unique_users) OVER (ORDER BY step_order), 0) AS drop_off FROM t""",
        "v", steps=_steps("v"), t=totals)
    pivot = ", ".join(
        f"CAST(coalesce(sum(unique_users) FILTER (funnel_step = '{x}'), 0) AS BIGINT) AS {x}"
        for x in ("page_view", "click", "add_to_cart", "purchase"))
    out["r16_funnel_trend"] = _sql(f"SELECT window_start, {pivot} FROM steps GROUP BY 1", "v", steps=_steps("v"))
    alert_steps = {"al": al, "sm": _summary("fl"), "fd": _FEED}
    out["r17_alert_summary"] = _sql("""SELECT count(*) AS active, count(*) AS total,
        count(*) FILTER (severity = 'critical') AS critical, CAST(0 AS BIGINT) AS acknowledged FROM fd""", "fl", **alert_steps)
    out["r18_alerts_by_type"] = _sql("SELECT anomaly_type, count(*) AS count FROM fd GROUP BY 1", "fl", **alert_steps)
    out["r19_alerts_by_severity"] = _sql("""SELECT x.severity, CAST(x.rank AS INT) AS rank, count(alert_id) AS count
        FROM (VALUES ('low', 0), ('medium', 1), ('high', 2), ('critical', 3)) x(severity, rank)
        LEFT JOIN fd ON fd.severity = x.severity GROUP BY 1, 2""", "fl", **alert_steps)
    out["r20_alert_timeline"] = _sql("""SELECT "timestamp", alert_id, anomaly_type, severity, message, anomaly_score,
        false AS acknowledged FROM fd""", "fl", **alert_steps)
    out["r21_browse_events"] = _sql("""SELECT event_id, event_type, user_id, session_id, "timestamp", country, device_type,
        traffic_source, response_time_ms, amount, CAST(error_code AS INT) AS error_code FROM v
        WHERE event_type IN ('purchase', 'error') AND traffic_source IN ('organic', 'social') AND country IN ('US', 'DE')
        ORDER BY "timestamp" DESC, event_id LIMIT 100""", "v")
    profile = []
    numbers = {"amount": "double", "error_code": "int", "response_time_ms": "int", "status_code": "int"}
    for name in _EVENT:
        kind = numbers.get(name, "timestamp" if name == "timestamp" else "string")
        quoted = f'"{name}"'
        numeric = name in numbers
        stats = [("mean", f"avg({name})"), ("std", f"stddev_samp({name})"), ("min", f"CAST(min({name}) AS DOUBLE)"),
                 ("max", f"CAST(max({name}) AS DOUBLE)"), ("median", f"quantile_cont({name}, 0.5)")]
        shown = ", ".join(
            f"round({text}, 6) AS {alias}" if numeric else f"CAST(NULL AS DOUBLE) AS {alias}" for alias, text in stats)
        profile.append(f"""SELECT '{name}' AS "column", '{kind}' AS type, count(*) AS rows,
            count(*) - count({quoted}) AS nulls, round((count(*) - count({quoted})) / count(*) * 100, 6) AS null_pct,
            count(DISTINCT {quoted}) AS distinct, {shown} FROM ec""")
    out["r22_column_profile"] = _sql(" UNION ALL ".join(profile).replace(" AS distinct", ' AS "distinct"'), "e",
                                     ec="SELECT *, CAST(NULL AS VARCHAR) AS session_id FROM e")
    for key, column in (("r23_numeric_histogram", "amount"), ("r23_numeric_histogram_few_values", "status_code")):
        values = f"SELECT CAST({column} AS DOUBLE) AS v FROM e WHERE {column} IS NOT NULL"
        out[key] = _sql(_hist(values, 50), "e", lim=_lim(values, "least(50, count(DISTINCT v))"))
    out["r24_top_values"] = _sql("""SELECT product_id, count(*) AS count FROM e WHERE product_id IS NOT NULL GROUP BY 1
        ORDER BY count DESC, product_id LIMIT 20""", "e")
    out["r25_dashboard_kpis"] = _sql("""SELECT win AS window_start, count(event_id) AS total_events,
        count(*) FILTER (event_type = 'page_view') AS page_views, count(*) FILTER (event_type = 'click') AS clicks,
        count(*) FILTER (event_type = 'add_to_cart') AS add_to_carts, count(*) FILTER (event_type = 'purchase') AS purchases,
        count(*) FILTER (event_type = 'login') AS logins, count(*) FILTER (event_type = 'error') AS errors,
        count(*) FILTER (event_type = 'search') AS searches, count(DISTINCT user_id) AS unique_users,
        count(DISTINCT session_id) AS unique_sessions, round(avg(response_time_ms), 6) AS avg_response_time_ms,
        CAST(max(response_time_ms) AS DOUBLE) AS max_response_time_ms,
        round(sum(coalesce(amount, 0.0)), 6) AS revenue_total,
        round(quantile_cont(response_time_ms, 0.95), 6) AS response_time_p95,
        round(count(*) FILTER (event_type = 'error') / count(*), 4) AS error_rate,
        round(count(*) FILTER (event_type = 'purchase') / count(*), 4) AS purchase_rate,
        round(count(*) FILTER (event_type = 'purchase') / greatest(count(*) FILTER (event_type = 'page_view'), 1), 4)
            AS conversion_rate,
        CAST(round(CAST(sum(coalesce(amount, 0.0)) / greatest(count(*) FILTER (event_type = 'purchase'), 1) AS DECIMAL(20, 6)), 2)
            AS DOUBLE) AS revenue_avg
        FROM w GROUP BY 1""", "v", w=hourly)
    out["r26_dashboard_sessions"] = _sql("""SELECT session_id, user_id, session_start, session_end, event_count,
        page_view_count, click_count, add_to_cart_count, purchase_count, error_count, total_revenue, entry_traffic_source,
        device_type, browser, country, session_duration_seconds, has_purchased, is_bounced,
        round(avg(is_bounced::INT) OVER (), 6) AS bounce_rate FROM s""", "v", s=s)
    out["r27_dashboard_funnels"] = _sql("""SELECT window_start, funnel_step, step_order, unique_users, event_count,
        nxt AS next_step_users, coalesce(round(nxt / unique_users, 4), 0.0) AS conversion_to_next,
        coalesce(unique_users - nxt, 0) AS drop_off_count,
        round(coalesce(unique_users - nxt, 0) / unique_users, 4) AS drop_off_rate
        FROM (SELECT *, lead(unique_users) OVER (PARTITION BY window_start ORDER BY step_order) AS nxt FROM steps)""",
        "e", g=gaps, steps=_steps("g"))
    out["exact_quantiles_by_type"] = _sql("""SELECT event_type, count(response_time_ms) AS n,
        round(quantile_cont(response_time_ms, 0.5), 6) AS p50, round(quantile_cont(response_time_ms, 0.95), 6) AS p95,
        round(quantile_cont(response_time_ms, 0.99), 6) AS p99 FROM e GROUP BY 1""", "e")

    # -- streams, all of whose windows are closed
    kpi_names = """window_start, window_end, window_duration, event_date, hour, total_events, page_views, clicks,
        add_to_carts, purchases, logins, errors, searches, avg_response_time_ms, p95_response_time_ms,
        max_response_time_ms, error_rate, purchase_rate, conversion_rate, revenue_total, revenue_avg, processed_at"""
    rejoined = "CAST(round(bounce_rate * unique_sessions) AS BIGINT) AS bounced"
    out["t4_live_kpis"] = _sql(
        f"SELECT {kpi_names}, {rejoined}, true AS unique_users_close, true AS unique_sessions_close FROM kp", "v",
        w=hourly, kp=_kpis("v"))
    out["t4_live_kpis_sliding"] = _sql(
        f"SELECT window_start, window_end, total_events, {rejoined} FROM kp", "v", q=_windowed("v", "15 MINUTE", "1h"),
        w="""SELECT * REPLACE (win - i * INTERVAL 15 MINUTE AS win, win + INTERVAL 1 HOUR - i * INTERVAL 15 MINUTE AS win_end)
            FROM q CROSS JOIN (SELECT unnest(range(0, 4)) AS i)""", kp=_kpis("v"))
    # Every day is a batch of its own.
    daily = {"dy": f"""SELECT *, {_bucket('24 HOUR')} AS day FROM v""", "dystats": _stats("dy"), "df": _flag("dy", "dystats")}
    out["t4_live_flags"] = _sql("SELECT event_id, is_anomaly, anomaly_type, anomaly_score FROM df", "v", **daily)
    out["d2_d4_flags_by_window"] = out["t4_live_flags"]
    out["t4_live_anomaly_summary"] = _sql(_summary("df"), "v", **daily)
    out["t4_live_funnels"] = out["a3_funnels_daily"]
    out["t4_live_funnels_with_gap"] = _sql(f"""SELECT window_start, funnel_step, unique_users, conversion_to_next,
        drop_off_count, drop_off_rate FROM ({_FUNNELS}) f""", "e", g=gaps, steps=_steps("g"))
    out["t4_live_dedup"] = _sql('SELECT event_id, "timestamp" FROM e', "e")
    unsessioned = _SCORE.replace("(session_id IS NULL OR trim(session_id) = '')::INT", "1")
    out["t4_live_scoring"] = _sql(f"SELECT event_id, traffic_source, round({unsessioned}, 6) AS quality_score FROM b", "b")
    out["t4_live_visits"] = _sql(f"""SELECT user_id, session_start, session_end, event_count, page_view_count, click_count,
        add_to_cart_count, purchase_count, error_count, entry_page, exit_page, session_duration_seconds, is_bounced,
        has_purchased FROM s""", "v", s=s)

    # -- jobs
    out["b1_bronze_batch"] = _sql("""SELECT count(*) FILTER (num % 97 <> 0) AS clean,
        count(*) FILTER (num % 97 = 0) AS dead_letter FROM rep""", "rep")
    silver_stats = """(SELECT count(*) FROM bz) AS bronze_read, (SELECT count(*) FROM sc) AS after_dedup,
        (SELECT count(*) FROM ps) AS passed_quality,
        (SELECT count(*) FROM sc WHERE quality_score < 0.5) AS quarantined, (SELECT count(*) FROM ps) AS silver_written"""
    out["b3_b6_silver_range"] = _sql(f"""SELECT {silver_stats}, (SELECT count(*) FROM sv WHERE is_anomaly) AS anomalies,
        (SELECT count(*) FROM sv WHERE is_anomaly) AS alerts_sent""", "sv")
    out["b7_silver_without_anomalies"] = _sql(
        f"SELECT {silver_stats}, CAST(0 AS BIGINT) AS anomalies, CAST(0 AS BIGINT) AS alerts_sent", "ps")
    # Dates whose bronze rows are gone leave nothing behind, nor do alerts of a run that looks for none.
    out["b3_emptied_date"] = "SELECT '' AS stage, '' AS event_id FROM events WHERE false"
    out["b4_emptied_date"] = "SELECT '' AS stage, '' AS event_date FROM events WHERE false"
    out["b7_rerun_skips"] = "SELECT '' AS key, '' AS event_date FROM events WHERE false"
    counts = {
        "windows": """count(DISTINCT date_trunc('hour', "timestamp"))""",
        "sessions": "count(DISTINCT event_date || session_id)",
        "funnel_rows": """count(DISTINCT event_date || event_type)
            FILTER (event_type IN ('page_view', 'click', 'add_to_cart', 'purchase'))""",
        "anomaly_rows": """count(DISTINCT CAST(date_trunc('hour', "timestamp") AS VARCHAR) || anomaly_type)""",
    }
    written = {"windows": "kpis_written", "sessions": "sessions_written", "funnel_rows": "funnels_written",
               "anomaly_rows": "anomalies_written"}
    shown = ", ".join(f"{text} AS {name}, {text} AS {written[name]}" for name, text in counts.items())
    out["b4_b5_b6_gold_range"] = _sql(f"SELECT count(*) AS silver_read, {shown} FROM sv", "sv")
    return out
