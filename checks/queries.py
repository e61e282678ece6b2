"""Every operator as a query over the given tables: name -> ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import lake
from clickweir import schemas
from clickweir.functions import events as fx
from clickweir.functions.timing import DAY_SECONDS, days_in, tumbling, window_label, window_seconds
from clickweir.operators import (
    alerts, anomalies, events, funnels, ingest, kpis, panes, ordering, quantiles, rollups, sessions, summaries,
)
from clickweir.plans import bronze, gold, silver
from clickweir.plans import live as live_plan
from clickweir.plans.config import Layout
from clickweir.sources import clicks, raw, tables
from clickweir.sources.session import scratch_path, use_utc
from clickweir.streaming import live

NOW = clicks.AS_OF
_REGISTERED: dict = {}


def plain(df: DataFrame) -> DataFrame:
    """Comparable values: zoneless timestamps (UTC), doubles to six digits. They are cut to nine
    first, so that a tie at the sixth does not hang on the order of a sum."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "double":
            column = F.round(F.round(column, 9), 6)
        columns.append(column.alias(name))
    return df.select(*columns)


def query(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        use_utc(spark)
        return plain(build(spark, folder))

    _REGISTERED[build.__name__] = run
    return build


def registered() -> dict:
    return dict(_REGISTERED)


# ---------------------------------------------------------------- shared inputs

visited = lake.visited


def dirty(spark, folder):
    return clicks.blemished(visited(spark, folder))


def lines(spark, folder):
    return clicks.raw_lines(clicks.repeated(dirty(spark, folder)))


def flagged(spark, folder):
    return anomalies.flag_anomalies(visited(spark, folder))


def session_table(spark, folder):
    return sessions.session_metrics(visited(spark, folder), as_of=NOW)


def alert_table(spark, folder):
    return alerts.alert_rows(flagged(spark, folder), NOW)


def feed(spark, folder):
    rows = flagged(spark, folder)
    return rollups.alert_feed(alerts.alert_rows(rows, NOW), summaries.anomaly_summary(rows))


def alert_counts(spark, folder):
    rows = flagged(spark, folder)
    return rollups.alert_counts(alerts.alert_rows(rows, NOW), summaries.anomaly_summary(rows))


def gapped(spark, folder):
    """Events whose clicks become errors from 10 January on, so that the funnel has a gap."""
    late = (F.col("event_type") == "click") & (F.col("event_date") >= "2024-01-10")
    return clicks.events(spark, folder).withColumn("event_type", F.when(late, "error").otherwise(F.col("event_type")))


def close(estimated, exact, keys, names, share=0.15):
    """Estimated distinct counts replaced by whether they are as near to the exact ones as three standard
    errors of the sketch (5 % each), or within two."""
    other = exact.select(*keys, *[F.col(n).alias(f"_{n}") for n in names])
    near = {f"{n}_close": F.abs(F.col(n) - F.col(f"_{n}")) <= F.greatest(F.lit(2.0), F.col(f"_{n}") * share) for n in names}
    return estimated.join(other, keys, "left").withColumns(near).drop(*names, *[f"_{n}" for n in names])


def bounced(df):
    """The bounce rate turned back into sessions: it is taken over an estimated number, they are counted."""
    return df.withColumn("bounced", F.round(F.col("bounce_rate") * F.col("unique_sessions")).cast("bigint")).drop("bounce_rate")


def funnel_table(spark, folder):
    return funnels.funnels(visited(spark, folder), exact=True, as_of=NOW)


def bronze_table(spark, layout):
    return tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT)


# ---------------------------------------------------------------- sources and sinks


@query
def s2_jsonl_source(spark, folder):
    return ingest.parse_raw(raw.read_lines(spark, lake.lines_folder(spark, folder))).drop("raw_value")


@query
def s3_parse_json(spark, folder):
    return ingest.parse_raw(lines(spark, folder)).drop("raw_value")


@query
def s4_bronze_table(spark, folder):
    return bronze_table(spark, lake.bronze_lake(spark, folder))


@query
def s5_dead_letters(spark, folder):
    layout = lake.bronze_lake(spark, folder)
    return tables.read_table(spark, layout.dead_letter, schemas.DEAD_LETTER).select(
        "event_id", "event_type", "timestamp", "error_reason", "error_timestamp",
        F.col("raw_value").isNotNull().alias("has_raw"))


@query
def s6_silver_table(spark, folder):
    layout = lake.silver_lake(spark, folder)
    return tables.read_table(spark, layout.silver, schemas.SILVER_EVENT)


@query
def s7_quarantine_table(spark, folder):
    layout = lake.silver_lake(spark, folder)
    return tables.read_table(spark, layout.quarantine, schemas.QUARANTINE)


@query
def s8_gold_kpis_table(spark, folder):
    return tables.read_table(spark, lake.gold_lake(spark, folder, "kpis").kpis, schemas.KPI)


@query
def s8_gold_sessions_table(spark, folder):
    return tables.read_table(spark, lake.gold_lake(spark, folder, "sessions").sessions, schemas.SESSION)


@query
def s8_gold_funnels_table(spark, folder):
    return tables.read_table(spark, lake.gold_lake(spark, folder, "funnels").funnels, schemas.FUNNEL)


@query
def s8_gold_anomalies_table(spark, folder):
    return tables.read_table(spark, lake.gold_lake(spark, folder, "anomalies").anomalies, schemas.ANOMALY_SUMMARY)


@query
def s9_alert_sink(spark, folder):
    layout = lake.silver_lake(spark, folder)
    sent = spark.read.schema("key string, value string").json(layout.alerts)
    return sent.select("key", F.get_json_object("value", "$.event_id").alias("event_id"),
                       F.get_json_object("value", "$.message").alias("message"))


@query
def s10_read_bronze_date(spark, folder):
    layout = lake.bronze_lake(spark, folder)
    return tables.read_dates(spark, layout.bronze, schemas.CLEAN_EVENT, "2024-01-15", "2024-01-15")


@query
def s11_read_silver_range(spark, folder):
    return silver.read_silver(spark, lake.silver_lake(spark, folder), "2024-01-10", "2024-01-12")


@query
def s12_latest_date(spark, folder):
    layout = lake.bronze_lake(spark, folder)
    newest = tables.latest_date(spark, layout.bronze)
    return tables.between_dates(bronze_table(spark, layout), newest, newest)


@query
def s12_latest_date_of_frame(spark, folder):
    return tables.latest_date_of(clicks.events(spark, folder))


@query
def s13_missing_table(spark, folder):
    none = tables.read_table(spark, scratch_path(spark, "none"), schemas.SILVER_EVENT)
    return rollups.stage_counts({"events": clicks.events(spark, folder), "missing": none})


@query
def s14_create_table(spark, folder):
    path = scratch_path(spark, "created")
    tables.create_if_missing(spark, path, schemas.CLEAN_EVENT, ["event_date"])
    rows = schemas.conform(clicks.events(spark, folder), schemas.CLEAN_EVENT)
    tables.append_batch(rows, path, ["event_date"], "first")
    tables.create_if_missing(spark, path, schemas.CLEAN_EVENT, ["event_date"])
    return tables.read_table(spark, path, schemas.CLEAN_EVENT).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- columns and filters


@query
def p1_numeric_coercion(spark, folder):
    typed = ingest.coerce_types(ingest.parse_raw(lines(spark, folder)))
    return typed.select(
        "event_id", "amount", "error_code", "response_time_ms", "status_code")


@query
def p2_timestamp_coercion(spark, folder):
    typed = ingest.coerce_types(ingest.parse_raw(lines(spark, folder)))
    return typed.select("event_id", "timestamp")


@query
def p3_event_date(spark, folder):
    return clicks.events(spark, folder).select("event_id", fx.event_date(F.col("timestamp")).alias("event_date"))


@query
def p4_clean_split(spark, folder):
    clean, bad = ingest.split_malformed(ingest.coerce_types(ingest.parse_raw(lines(spark, folder))))
    return bad.groupBy("error_reason").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        clean.agg(F.lit("clean").alias("error_reason"), F.count(F.lit(1)).alias("rows")))


@query
def p5_p6_p7_enrichment(spark, folder):
    return events.enrich_columns(clicks.events(spark, folder)).select(
        "event_id", "hour_of_day", "day_of_week", "is_purchase_event", "is_error_event")


@query
def p8_traffic_source(spark, folder):
    return clicks.events(spark, folder).select(
        "event_id", "referrer_url", fx.traffic_source(F.col("referrer_url")).alias("traffic_source"))


@query
def p9_quality_score(spark, folder):
    scored = events.score_quality(dirty(spark, folder), NOW)
    return scored.select("event_id", "quality_score", "quality_flags")


@query
def p10_quality_split(spark, folder):
    passed, quarantined = events.split_quality(events.score_quality(dirty(spark, folder), NOW))
    return passed.select("event_id", F.lit("passed").alias("part")).unionByName(
        quarantined.select("event_id", F.lit("quarantined").alias("part")))


@query
def p11_p12_conform_and_stamp(spark, folder):
    rows = clicks.blemished(visited(spark, folder))
    enriched = events.number_events(events.enrich_columns(rows))
    scored = anomalies.no_anomalies(events.score_quality(enriched, NOW))
    return schemas.conform(events.stamp(scored, NOW), schemas.SILVER_EVENT)


@query
def p13_window_widths(spark, folder):
    rows = clicks.events(spark, folder)
    parts = []
    for text in ("5m", "15m", "30m", "1h", "6h", "24h", "2h", "90s"):
        seconds = window_seconds(text)
        parts.append(rows.select(tumbling("timestamp", seconds).alias("w")).agg(
            F.lit(window_label(seconds)).alias("label"), F.count_distinct("w").alias("windows")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---------------------------------------------------------------- windows and joins


@query
def w1_deduplicate(spark, folder):
    rows = clicks.repeated(clicks.events(spark, folder))
    return events.deduplicate(rows).select("event_id", "timestamp", "event_type")


@query
def w2_event_number(spark, folder):
    return events.number_events(dirty(spark, folder)).select("event_id", "session_id", "event_number_in_session")


@query
def w3_w4_first_and_last(spark, folder):
    return session_table(spark, folder).select(
        "session_id", "entry_page", "exit_page", "entry_traffic_source", "device_type", "browser", "os", "country",
        "user_id", "event_date")


@query
def w5_next_step(spark, folder):
    return funnels.funnels(gapped(spark, folder), exact=True, as_of=NOW).select(
        "window_start", "funnel_step", "unique_users", "conversion_to_next", "drop_off_count", "drop_off_rate")


@query
def w6_visits(spark, folder):
    return clicks.visited(spark, folder).select("event_id", "session_id")


@query
def w6_visits_half_hour(spark, folder):
    rows = clicks.events(spark, folder)
    return ordering.visits(rows).select("event_id", "session_id")


@query
def j1_bounced_events(spark, folder):
    return kpis.single_event_sessions(dirty(spark, folder), 3600).select(
        "window_start", F.col("_bounced").alias("bounce_count"))


# ---------------------------------------------------------------- aggregations


@query
def a1_kpis_hourly(spark, folder):
    return kpis.windowed_kpis(dirty(spark, folder), exact=True, as_of=NOW)


@query
def a1_kpis_five_minutes(spark, folder):
    return kpis.windowed_kpis(dirty(spark, folder), 300, exact=True, as_of=NOW)


@query
def a1_kpis_estimated(spark, folder):
    estimated = kpis.windowed_kpis(dirty(spark, folder), as_of=NOW)
    exact = kpis.windowed_kpis(dirty(spark, folder), exact=True, as_of=NOW)
    return close(bounced(estimated), exact, ["window_start"], ["unique_users", "unique_sessions"])


@query
def a2_sessions(spark, folder):
    return session_table(spark, folder)


@query
def a3_funnels_daily(spark, folder):
    return funnel_table(spark, folder)


@query
def a3_funnels_estimated(spark, folder):
    estimated = funnels.funnels(visited(spark, folder), as_of=NOW).select(
        "window_start", "funnel_step", "event_count", "unique_users")
    return close(estimated, funnel_table(spark, folder), ["window_start", "funnel_step"], ["unique_users"])


@query
def a4_anomaly_summary(spark, folder):
    return summaries.anomaly_summary(flagged(spark, folder), as_of=NOW)


@query
def a5_tumbling_windows(spark, folder):
    return clicks.events(spark, folder).groupBy(tumbling("timestamp", 25200).getField("start").alias("window_start")).agg(
        F.count(F.lit(1)).alias("events"))


@query
def a6_kpis_sliding(spark, folder):
    return kpis.windowed_kpis(dirty(spark, folder), 3600, slide_seconds=900, exact=True, as_of=NOW)


@query
def a6_kpis_by_panes(spark, folder):
    return panes.sliding_kpis(dirty(spark, folder), 3600, 900, as_of=NOW)


@query
def s8_kpis_rolled_up(spark, folder):
    """Hours from the stored table of five-minute panes. Estimates are replaced by whether they are near: the p95
    by whether it lies between the exact 92 % and 98 % of the hour."""
    path = scratch_path(spark, "panes")
    rows = dirty(spark, folder)
    panes.panes(rows).write.parquet(path)
    hours = bounced(panes.rolled_up(spark.read.parquet(path), as_of=NOW))
    exact = kpis.windowed_kpis(rows, exact=True, as_of=NOW)
    bounds = rows.groupBy(tumbling("timestamp", 3600).getField("start").alias("window_start")).agg(
        F.percentile_approx("response_time_ms", [0.92, 0.98]).alias("_near"))
    value = F.col("p95_response_time_ms")
    near = F.coalesce(value.between(F.col("_near")[0], F.col("_near")[1]), value.isNull() & F.col("_near").isNull())
    hours = hours.join(bounds, "window_start", "left").withColumn("p95_close", near).drop("_near", "p95_response_time_ms")
    return close(hours, exact, ["window_start"], ["unique_users", "unique_sessions"])


@query
def a7_a8_batch_stats(spark, folder):
    stats = anomalies.batch_stats(clicks.events(spark, folder))
    return stats.select(*[F.col(name).alias(name.lstrip("_")) for name in stats.columns])


# ---------------------------------------------------------------- anomalies and alerts


def _flags(df):
    return df.select("event_id", "is_anomaly", "anomaly_type", "anomaly_score")


@query
def d1_min_samples(spark, folder):
    return _flags(anomalies.flag_anomalies(clicks.events(spark, folder), min_samples=1_000_000_000))


@query
def d2_d4_error_spike(spark, folder):
    return _flags(anomalies.flag_anomalies(clicks.events(spark, folder)))


@query
def d3_d4_slow_response(spark, folder):
    return _flags(anomalies.flag_anomalies(clicks.events(spark, folder), error_rate_threshold=0.25))


@query
def d5_d6_alert_rows(spark, folder):
    return alert_table(spark, folder).drop("metadata")


@query
def d7_min_score(spark, folder):
    return alerts.at_least(alert_table(spark, folder), 1.5).select("alert_id", "anomaly_score")


@query
def d8_top_alerts(spark, folder):
    return alerts.top_alerts(alert_table(spark, folder)).select("alert_id", "anomaly_score")


@query
def d8_alerts_cut(spark, folder):
    return alerts.alerts_cut(alert_table(spark, folder))


@query
def d9_score_bands(spark, folder):
    return alerts.with_band(alert_table(spark, folder)).select("alert_id", "band")


@query
def d10_alert_digest(spark, folder):
    return alerts.digest(alert_table(spark, folder)).withColumn("messages", F.concat_ws("\n", "messages"))


@query
def d11_traffic_spikes(spark, folder):
    return anomalies.traffic_spikes(clicks.events(spark, folder))


@query
def d12_purchase_drops(spark, folder):
    return anomalies.purchase_drops(clicks.events(spark, folder))


@query
def d13_slow_windows(spark, folder):
    return anomalies.slow_windows(clicks.events(spark, folder))


def trend_lake(spark, folder):
    """The trend job over each half of the dates: the second half takes its history from the first."""
    own = lake.job_layout(spark, "trends", silver=lake.silver_lake(spark, folder).silver)
    first, last = lake.date_range(spark, folder)
    days = days_in(first, last)
    for start, end in ((days[0], days[len(days) // 2]), (days[len(days) // 2 + 1], days[-1])):
        gold.run_trends(spark, own, start=start, end=end, as_of=NOW)
    return own


@query
def d11_d13_trend_table(spark, folder):
    rows = tables.read_table(spark, trend_lake(spark, folder).trends, schemas.TREND)
    return rows.drop("processed_at")


@query
def d11_d13_trend_alerts(spark, folder):
    sent = spark.read.schema("key string, value string, event_date string").json(trend_lake(spark, folder).trend_alerts)
    fields = F.from_json("value", schemas.ALERT)
    return sent.select("key", "event_date", fields.alias("a")).select(
        "key", "event_date", "a.anomaly_type", "a.anomaly_score", "a.event_type", "a.timestamp", "a.response_time_ms", "a.message")


# ---------------------------------------------------------------- rollups


@query
def r1_overview(spark, folder):
    rows = visited(spark, folder)
    return rollups.overview_totals(rows, session_table(spark, folder))


@query
def r2_stage_counts(spark, folder):
    layout = lake.gold_lake(spark, folder, "kpis", "sessions")
    return rollups.stage_counts({
        "bronze": bronze_table(spark, layout),
        "silver": tables.read_table(spark, layout.silver, schemas.SILVER_EVENT),
        "quarantine": tables.read_table(spark, layout.quarantine, schemas.QUARANTINE),
        "gold_kpis": tables.read_table(spark, layout.kpis, schemas.KPI),
        "gold_sessions": tables.read_table(spark, layout.sessions, schemas.SESSION),
    })


@query
def r3_hourly_timeline(spark, folder):
    return rollups.hourly_timeline(clicks.events(spark, folder))


@query
def r4_event_types(spark, folder):
    return rollups.distribution(clicks.events(spark, folder), "event_type")


@query
def r5_kpi_trend(spark, folder):
    table = kpis.windowed_kpis(visited(spark, folder), exact=True)
    return rollups.kpi_trend(table, ["total_events", "unique_users", "error_rate", "revenue_total"])


@query
def r6_latest_window(spark, folder):
    return rollups.latest_window(kpis.windowed_kpis(visited(spark, folder), exact=True, as_of=NOW))


@query
def r7_response_histogram(spark, folder):
    return rollups.response_histogram(clicks.events(spark, folder))


@query
def r8_traffic_sources(spark, folder):
    return rollups.distribution(events.enrich_columns(clicks.events(spark, folder)), "traffic_source")


@query
def r9_session_summary(spark, folder):
    return rollups.session_summary(session_table(spark, folder))


@query
def r10_duration_histogram(spark, folder):
    return rollups.duration_histogram(session_table(spark, folder))


@query
def r11_session_devices(spark, folder):
    return rollups.distribution(session_table(spark, folder), "device_type", "sessions")


@query
def r12_activity_heatmap(spark, folder):
    return rollups.activity_heatmap(clicks.events(spark, folder))


@query
def r13_session_countries(spark, folder):
    return rollups.distribution(session_table(spark, folder), "country", "sessions")


@query
def r14_overall_funnel(spark, folder):
    return rollups.overall_funnel(funnel_table(spark, folder))


@query
def r15_overall_conversion(spark, folder):
    return rollups.overall_conversion(funnel_table(spark, folder))


@query
def r16_funnel_trend(spark, folder):
    return rollups.funnel_trend(funnel_table(spark, folder))


@query
def r17_alert_summary(spark, folder):
    return rollups.alert_summary(alert_counts(spark, folder))


@query
def r18_alerts_by_type(spark, folder):
    return rollups.alerts_by_type(alert_counts(spark, folder))


@query
def r19_alerts_by_severity(spark, folder):
    return rollups.alerts_by_severity(alert_counts(spark, folder))


@query
def r20_alert_timeline(spark, folder):
    return rollups.alert_timeline(feed(spark, folder))


@query
def r21_browse_events(spark, folder):
    return rollups.browse_events(
        visited(spark, folder), ["purchase", "error"], ["organic", "social"], ["US", "DE"], 100)


@query
def r22_column_profile(spark, folder):
    return rollups.column_profile(clicks.events(spark, folder).select(*schemas.CLEAN_EVENT.fieldNames()))


@query
def r23_numeric_histogram(spark, folder):
    return rollups.numeric_histogram(clicks.events(spark, folder), "amount")


@query
def r23_numeric_histogram_few_values(spark, folder):
    return rollups.numeric_histogram(clicks.events(spark, folder), "status_code")


@query
def r24_top_values(spark, folder):
    return rollups.top_values(clicks.events(spark, folder), "product_id")


@query
def r25_dashboard_kpis(spark, folder):
    return kpis.dashboard_kpis(visited(spark, folder))


@query
def r26_dashboard_sessions(spark, folder):
    return sessions.dashboard_sessions(visited(spark, folder))


@query
def r27_dashboard_funnels(spark, folder):
    return funnels.dashboard_funnels(gapped(spark, folder))


@query
def exact_quantiles_by_type(spark, folder):
    return quantiles.exact_quantiles(
        clicks.events(spark, folder), "response_time_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["event_type"]
    ).drop("lowest", "highest")


# ---------------------------------------------------------------- streams


@query
def t1_bronze_stream(spark, folder):
    layout = Layout(scratch_path(spark, "streamed"))
    source = raw.stream_lines(spark, lake.lines_folder(spark, folder))
    bronze.start_stream(source, layout, trigger={"availableNow": True}, as_of=NOW).awaitTermination()
    return bronze_table(spark, layout)


def closed(df):
    """Without the window of the event that closes all others."""
    return df.filter("window_start < '2090-01-01'")


@query
def t4_live_kpis(spark, folder):
    rows = live.live_kpis(lake.visited_stream(spark, folder), as_of=NOW, gap_seconds=clicks.GAP_SECONDS)
    exact = kpis.windowed_kpis(visited(spark, folder), exact=True, as_of=NOW)
    return close(bounced(closed(lake.drain(rows, "kpis"))), exact, ["window_start"], ["unique_users", "unique_sessions"])


@query
def t4_live_kpis_sliding(spark, folder):
    rows = live.live_kpis(
        lake.visited_stream(spark, folder), slide_seconds=900, as_of=NOW, gap_seconds=clicks.GAP_SECONDS)
    return closed(bounced(lake.drain(rows, "kpis"))).select("window_start", "window_end", "total_events", "bounced")


@query
def t4_live_flags(spark, folder):
    rows = lake.drain(live.live_flags(lake.visited_stream(spark, folder), DAY_SECONDS), "flags")
    return _flags(rows.filter("event_id <> '-1'"))


@query
def d2_d4_flags_by_window(spark, folder):
    return _flags(anomalies.flag_windows(visited(spark, folder), DAY_SECONDS))


@query
def t4_live_anomaly_summary(spark, folder):
    flagged_ = live.live_flags(lake.visited_stream(spark, folder), DAY_SECONDS)
    return lake.drain(live.live_anomaly_summary(flagged_, delay=None, as_of=NOW), "summary")


@query
def t4_live_funnels(spark, folder):
    return lake.drain(live.live_funnels(lake.visited_stream(spark, folder), as_of=NOW), "funnels")


@query
def t4_live_funnels_with_gap(spark, folder):
    late = (F.col("event_type") == "click") & (F.col("event_date") >= "2024-01-10")
    rows = lake.visited_stream(spark, folder).withColumn("event_type", F.when(late, "error").otherwise(F.col("event_type")))
    return lake.drain(live.live_funnels(rows, as_of=NOW), "funnels").select(
        "window_start", "funnel_step", "unique_users", "conversion_to_next", "drop_off_count", "drop_off_rate")


@query
def t4_live_dedup(spark, folder):
    rows = clicks.stream(spark, folder)
    twice = rows.unionByName(rows)
    return lake.drain(live.deduplicated(twice).select("event_id", "timestamp"), "dedup")


@query
def t4_live_scoring(spark, folder):
    rows = clicks.blemished(clicks.stream(spark, folder))
    return lake.drain(live.scored(rows, NOW).select("event_id", "traffic_source", "quality_score"), "scored")


@query
def t4_live_visits(spark, folder):
    return lake.drain(live.live_visits(clicks.stream(spark, folder, closing=True), clicks.GAP_SECONDS), "visits")


def live_lake(spark, folder):
    """Bronze in three parts, the last of which has late rows of the first dates, with live silver after each."""
    bronze_of = bronze_table(spark, lake.bronze_lake(spark, folder))
    layout = lake.job_layout(spark, "live")
    part = F.when(F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0, 2).when(F.col("event_date") < "2024-01-16", 0).otherwise(1)
    for n in range(3):
        tables.append_batch(bronze_of.filter(part == n), layout.bronze, bronze.BRONZE_PARTITIONS, f"part-{n}")
        live_plan.start_silver(spark, layout, trigger={"availableNow": True}, as_of=NOW).awaitTermination()
    return layout


@query
def t4_live_silver(spark, folder):
    return tables.read_table(spark, live_lake(spark, folder).silver, schemas.SILVER_EVENT)


# ---------------------------------------------------------------- jobs


@query
def b1_bronze_batch(spark, folder):
    layout = Layout(scratch_path(spark, "b1"))
    return lake.stats_row(spark, bronze.run_batch(spark, layout, lake.lines_folder(spark, folder), as_of=NOW))


@query
def b3_b6_silver_range(spark, folder):
    layout = lake.bronze_lake(spark, folder)
    own = Layout(scratch_path(spark, "b3"), bronze=layout.bronze)
    return lake.stats_row(spark, silver.run(spark, own, **lake.dates(spark, folder), as_of=NOW))


@query
def b4_b5_b6_gold_range(spark, folder):
    layout = lake.silver_lake(spark, folder)
    own = Layout(scratch_path(spark, "b5"), silver=layout.silver)
    return lake.stats_row(spark, gold.run_all(spark, own, **lake.dates(spark, folder), as_of=NOW))


def rerun_on_nothing(spark, folder):
    """Silver and gold of all dates, then again after the bronze rows of half of them are gone."""
    layout = lake.bronze_lake(spark, folder)
    first, last = lake.date_range(spark, folder)
    own = lake.job_layout(spark, "emptied", bronze=layout.bronze)
    silver.run(spark, own, start=first, end=last, as_of=NOW)
    gold.run_all(spark, own, start=first, end=last, as_of=NOW)
    bare = Layout(own.root, bronze=scratch_path(spark, "no-bronze"))
    tables.create_if_missing(spark, bare.bronze, schemas.CLEAN_EVENT, ["event_date"])
    silver.run(spark, bare, start=first, end=last, as_of=NOW)
    return bare, first, last


@query
def b3_emptied_date(spark, folder):
    layout, _, _ = rerun_on_nothing(spark, folder)
    parts = {"silver": (layout.silver, schemas.SILVER_EVENT), "quarantine": (layout.quarantine, schemas.QUARANTINE)}
    left = [tables.read_table(spark, *of).select(F.lit(name).alias("stage"), "event_id") for name, of in parts.items()]
    return left[0].unionByName(left[1])


@query
def b4_emptied_date(spark, folder):
    layout, first, last = rerun_on_nothing(spark, folder)
    gold.run_all(spark, layout, start=first, end=last, as_of=NOW)
    parts = {"kpis": (layout.kpis, schemas.KPI), "sessions": (layout.sessions, schemas.SESSION),
             "funnels": (layout.funnels, schemas.FUNNEL), "anomalies": (layout.anomalies, schemas.ANOMALY_SUMMARY)}
    left = [tables.read_table(spark, *of).select(F.lit(name).alias("stage"), "event_date") for name, of in parts.items()]
    return left[0].unionByName(left[1]).unionByName(left[2]).unionByName(left[3])


@query
def b7_rerun_skips(spark, folder):
    bronze_of = lake.bronze_lake(spark, folder)
    first, last = lake.date_range(spark, folder)
    own = lake.job_layout(spark, "skipped", bronze=bronze_of.bronze)
    for skip in (False, True):
        silver.run(spark, own, start=first, end=last, as_of=NOW, skip_anomalies=skip)
    return spark.read.schema("key string, value string, event_date string").json(own.alerts).select("key", "event_date")


@query
def b7_silver_without_anomalies(spark, folder):
    layout = lake.bronze_lake(spark, folder)
    own = Layout(scratch_path(spark, "b7"), bronze=layout.bronze)
    stats = silver.run(spark, own, **lake.dates(spark, folder), as_of=NOW, skip_anomalies=True)
    return lake.stats_row(spark, stats)
