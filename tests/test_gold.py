import pytest
from support import at, by, frame, silver_row
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import funnels, kpis, rollups, sessions, summaries

AS_OF = at("2026-05-30")


def types(schema):
    return [(f.name, f.dataType) for f in schema]


@pytest.mark.parametrize("exact", [True, False])
def test_kpis(silver_events, exact):
    got = kpis.windowed_kpis(silver_events, exact=exact, as_of=AS_OF)
    assert types(got.schema) == types(schemas.KPI)
    rows = {r.hour: r for r in got.collect()}
    assert sorted(rows) == [8, 9, 11]
    total = {name: sum(r[name] for r in rows.values()) for name in kpis.COUNTED}
    assert total == {"page_views": 4, "clicks": 2, "add_to_carts": 1, "purchases": 1, "logins": 1, "errors": 1,
                     "searches": 1}
    eight = rows[8]
    assert eight.total_events == 6 and eight.unique_users == 2 and eight.unique_sessions == 2
    assert eight.revenue_total == 30.0 and eight.revenue_avg == 30.0
    assert eight.error_rate == 0.0 and rows[9].error_rate == 0.25 and eight.conversion_rate == round(1 / 3, 4)
    assert eight.bounce_rate == 0.5 and eight.max_response_time_ms == 1200.0 and rows[9].max_response_time_ms == 6200.0
    assert eight.p95_response_time_ms == 1200.0 and eight.window_duration == "1h" and eight.event_date == "2026-05-29"
    assert rows[11].total_events == 1  # logout is not counted
    assert rows[11].revenue_avg is None and rows[11].revenue_total == 0.0


@pytest.mark.parametrize("exact", [True, False])
def test_p95_of_large_windows(spark, exact):
    """Of 9000 events an hour, in some parts, it is no neighbour by rank."""
    rows = spark.range(0, 180_000, 1, 12).selectExpr(
        "string(id) AS event_id", "'click' AS event_type", "'u' AS user_id", "string(id) AS session_id", "0.0D AS amount",
        "timestamp_seconds(1704067200 + 3600 * (id % 20)) AS timestamp", "int(pmod(xxhash64(id), 17000)) AS response_time_ms")
    got = {r.window_start: r.p95_response_time_ms for r in kpis.windowed_kpis(rows, exact=exact).collect()}
    values = {}
    for r in rows.select(F.date_trunc("hour", "timestamp").alias("w"), "response_time_ms").collect():
        values.setdefault(r.w, []).append(r.response_time_ms)
    assert got == {w: sorted(v)[-(-95 * len(v) // 100) - 1] for w, v in values.items()}


def test_window_of_uncounted_events_is_kept(spark):
    df = frame(spark, [silver_row("a", "logout", "2026-05-29 10:00:00", session_id=None)], schemas.SILVER_EVENT)
    row = kpis.windowed_kpis(df).first()
    assert (row.total_events, row.error_rate, row.bounce_rate, row.unique_sessions) == (0, 0.0, 0.0, 0)


def test_bounce_counts_sessions_over_the_whole_input(spark):
    rows = [silver_row("a", "click", "2026-05-29 10:59:00", session_id="x"),
            silver_row("b", "click", "2026-05-29 11:01:00", session_id="x"),
            silver_row("c", "click", "2026-05-29 11:02:00", session_id="y")]
    got = {r.hour: r.bounce_rate for r in kpis.windowed_kpis(frame(spark, rows, schemas.SILVER_EVENT)).collect()}
    assert got == {10: 0.0, 11: 0.5}


def test_sliding_windows(silver_events):
    got = kpis.windowed_kpis(silver_events, 3600, slide_seconds=1800, exact=True)
    starts = {str(r.window_start)[11:16]: r.page_views for r in got.collect()}
    assert starts == {"07:30": 2, "08:00": 3, "08:30": 2, "09:00": 1, "09:30": 0, "10:30": 0, "11:00": 0}


def test_sessions(silver_events):
    got = sessions.session_metrics(silver_events, as_of=AS_OF)
    assert types(got.schema) == types(schemas.SESSION)
    rows = by(got, "session_id")
    assert {k: r.event_count for k, r in rows.items()} == {
        "red": 5, "blue": 1, "green": 4, "grey": 2}
    red = rows["red"]
    assert red.session_duration_seconds == 600.0 and (red.entry_page, red.exit_page) == ("/home", "/paid")
    assert red.has_purchased and red.total_revenue == 30.0 and red.user_id == "u7" and red.purchase_count == 1
    assert [k for k, r in rows.items() if r.is_bounced] == ["blue"]
    assert rows["blue"].entry_traffic_source == "social" and rows["blue"].country == "JP"


def test_sessions_leave_out_rows_without_session_and_split_by_day(spark):
    rows = [silver_row("a", "click", "2026-05-29 23:59:00", session_id="x"),
            silver_row("b", "click", "2026-05-30 00:01:00", session_id="x"),
            silver_row("c", "click", "2026-05-30 00:01:00", session_id=None)]
    df = frame(spark, rows, schemas.SILVER_EVENT)
    assert [r.event_count for r in sessions.session_metrics(df).collect()] == [2]
    per_day = {r.event_date: r.event_count for r in sessions.session_metrics(df, per_day=True).collect()}
    assert per_day == {"2026-05-29": 1, "2026-05-30": 1}


@pytest.mark.parametrize("exact", [True, False])
def test_funnel(silver_events, exact):
    got = funnels.funnels(silver_events, exact=exact, as_of=AS_OF)
    assert types(got.schema) == types(schemas.FUNNEL)
    rows = by(got, "funnel_step")
    assert {k: r.unique_users for k, r in rows.items()} == {
        "page_view": 3, "click": 2, "add_to_cart": 1, "purchase": 1}
    assert rows["page_view"].conversion_to_next == 0.6667 and rows["page_view"].drop_off_count == 1
    assert rows["purchase"].conversion_to_next is None and rows["purchase"].drop_off_rate is None


def test_missing_step_is_not_skipped(spark, silver_events):
    df = silver_events.filter("event_type <> 'click'")
    assert by(funnels.funnels(df, exact=True), "funnel_step")["page_view"].conversion_to_next is None
    assert by(funnels.dashboard_funnels(df), "funnel_step")["page_view"].conversion_to_next == 0.3333
    own = funnels.funnels(silver_events, steps=["login", "logout"], exact=True)
    assert by(own, "funnel_step")["login"].conversion_to_next == 1.0


def test_anomaly_summary(spark, silver_events):
    empty = summaries.anomaly_summary(silver_events)
    assert empty.count() == 0 and types(empty.schema) == types(schemas.ANOMALY_SUMMARY)
    odd = silver_events.filter("event_id <= 'a05'").withColumns({
        "is_anomaly": F.lit(True), "anomaly_type": F.lit("slow_response"), "anomaly_score": F.lit(1.5)})
    (row,) = summaries.anomaly_summary(odd).collect()
    assert (row.anomaly_count, row.severity, row.triggering_metric) == (5, "low", "response_time_ms")
    assert (row.metric_value, row.metric_threshold) == (1200.0, 3.0)


@pytest.mark.parametrize("n, level", [(9, "low"), (10, "medium"), (49, "medium"), (50, "high"), (100, "critical")])
def test_severity(spark, n, level):
    assert spark.range(1).select(summaries.severity(F.lit(n))).first()[0] == level


def test_rollups(silver_events):
    table = sessions.session_metrics(silver_events)
    row = rollups.session_summary(table).first()
    assert (row.total_sessions, row.bounced, row.with_purchase, row.bounce_rate_pct) == (4, 1, 1, 25.0)
    totals = rollups.overview_totals(silver_events, table).first()
    assert (totals.total_events, totals.total_users, totals.conversion_rate_pct) == (12, 3, 25.0)
    hours = [(str(r.hour_start)[11:13], r.event_count) for r in rollups.hourly_timeline(
        silver_events).orderBy("hour_start").collect()]
    assert hours == [("08", 6), ("09", 4), ("10", 0), ("11", 2)]
    latest = rollups.latest_window(kpis.windowed_kpis(silver_events)).first()
    assert latest.hour == 11
    heat = rollups.activity_heatmap(silver_events).collect()
    assert len(heat) == 1 and (heat[0].day_name, heat[0].h08, heat[0].h00) == ("Friday", 6, 0)
    found = rollups.browse_events(silver_events, event_types=["click", "error"], rows=10).collect()
    assert [r.event_id for r in found] == ["a10", "a09", "a03"]
    with pytest.raises(ValueError):
        rollups.browse_events(silver_events, rows=5000)
    steps = rollups.overall_conversion(funnels.funnels(silver_events, exact=True)).orderBy("step_order").collect()
    assert [r.conversion_to_next_pct for r in steps] == [66.7, 50.0, 100.0, 0.0]
    profile = by(rollups.column_profile(silver_events, ["amount", "country"]), "column")
    assert (profile["amount"].nulls, profile["amount"].distinct, profile["amount"].median) == (10, 1, 30.0)
    assert profile["country"].type == "string" and profile["country"].mean is None
