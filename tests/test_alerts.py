import json

import pytest
from support import at, frame, silver_row
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import alerts, rollups, summaries

AS_OF = at("2026-05-30")


def flagged(spark, rows):
    made = [silver_row(name, "error", "2026-05-29 10:00:00", is_anomaly=True, anomaly_type=kind, anomaly_score=score,
                       response_time_ms=rt) for name, kind, score, rt in rows]
    return frame(spark, made + [silver_row("fine", "click", "2026-05-29 10:00:00")], schemas.SILVER_EVENT)


def test_rows_and_messages(spark):
    df = flagged(spark, [("e1", "error_rate_spike", 0.85, 10), ("e2", "slow_response", 1.5, None),
                         ("e3", "odd", 0.0, 10)])
    rows = {r.event_id: r for r in alerts.alert_rows(df, AS_OF).collect()}
    assert set(rows) == {"e1", "e2", "e3"}
    assert rows["e1"].alert_id == "alert-e1-1780099200" and rows["e1"].timestamp == "2026-05-29T10:00:00"
    assert rows["e1"].detected_at == "2026-05-30T00:00:00+00:00"
    assert rows["e1"].message == "Error rate spike detected: anomaly_score=0.85, event_type=error"
    assert rows["e2"].message == "Slow response detected: 0ms, anomaly_score=1.50, event_id=e2"
    assert rows["e3"].message == "Anomaly detected: type=odd, score=0.00, event_id=e3"
    assert rows["e3"].anomaly_score is None and rows["e3"].metadata == {}


def test_own_message_is_kept(spark):
    df = flagged(spark, [("e1", "odd", 0.5, 1)]).withColumn("message", F.lit("mine"))
    assert alerts.alert_rows(df, AS_OF).first().message == "mine"


def test_filter_cap_band_digest(spark):
    table = alerts.alert_rows(flagged(spark, [(f"e{i:02d}", "odd", i / 100, 1) for i in range(60)]), AS_OF)
    assert alerts.at_least(table, 0.5).count() == 10 and alerts.at_least(table).count() == 60
    top = [r.anomaly_score for r in alerts.top_alerts(table).collect()]
    assert len(top) == 50 and top[0] == 0.59
    bands = {r.event_id: r.band for r in alerts.with_band(table).collect()}
    assert bands["e50"] == "orange" and bands["e49"] == "yellow"
    digest = alerts.digest(table).first()
    assert digest.total == 60 and len(digest.messages) == 10 and digest.messages[0].startswith("alert-e59-")


@pytest.mark.parametrize("score, band", [(0.8, "red"), (0.79, "orange"), (0.5, "orange"), (0.49, "yellow")])
def test_bands(spark, score, band):
    assert spark.createDataFrame([(score,)], "anomaly_score double").select(alerts.score_band()).first()[0] == band


def test_messages_are_json(spark):
    row = alerts.alert_messages(alerts.alert_rows(flagged(spark, [("e1", "odd", 0.5, 7)]), AS_OF)).first()
    body = json.loads(row.value)
    assert row.key == body["alert_id"] and body["response_time_ms"] == 7


def test_feed(spark):
    df = flagged(spark, [(f"e{i}", "odd", 0.5, 1) for i in range(12)] + [("s", "slow_response", 2.0, 9)])
    feed = rollups.alert_feed(alerts.alert_rows(df, AS_OF), summaries.anomaly_summary(df))
    counts = rollups.alert_counts(alerts.alert_rows(df, AS_OF), summaries.anomaly_summary(df))
    total = rollups.alert_summary(counts).first()
    assert (total.active, total.total, total.critical, total.acknowledged) == (13, 13, 0, 0)
    levels = {r.severity: r["count"] for r in rollups.alerts_by_severity(counts).collect()}
    assert levels == {"low": 1, "medium": 12, "high": 0, "critical": 0}
    assert rollups.alert_timeline(feed).count() == 13
