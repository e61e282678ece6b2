import pytest
from support import at, by
from pyspark.sql import functions as F

from clickweir.functions import events as fx
from clickweir.functions.timing import window_label, window_seconds
from clickweir.operators import events

AS_OF = at("2026-05-30")


@pytest.mark.parametrize("url, source", [
    ("https://google.com/search", "organic"), ("https://facebook.com", "social"), ("https://twitter.com/x", "social"),
    ("https://www.linkedin.com", "social"), ("https://instagram.com", "social"),
    ("https://email.company.com/newsletter", "email"), ("https://news.co/newsletter", "email"),
    ("https://bing.com", "organic"), ("https://YAHOO.com", "organic"), ("https://email.google.com", "organic"),
    (None, "direct"), ("", "direct"), ("/", "direct"), ("None", "direct"), ("https://example.org", "referral"),
])
def test_traffic_source(spark, url, source):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(fx.traffic_source(F.col("u"))).first()[0] == source


QUALITY = "event_id string, event_type string, user_id string, session_id string, timestamp timestamp, " \
          "device_type string, response_time_ms int"


def scored(spark, **fields):
    row = {"event_id": "q1", "event_type": "page_view", "user_id": "u1", "session_id": "s1",
           "timestamp": at("2026-05-29 10:00:00"), "device_type": "desktop", "response_time_ms": 150, **fields}
    df = spark.createDataFrame([tuple(row.values())], QUALITY)
    result = events.score_quality(df, AS_OF).first()
    return result.quality_score, result.quality_flags


@pytest.mark.parametrize("fields, score, flags", [
    ({}, 1.0, None),
    ({"event_id": None, "user_id": None}, 0.7, "missing:user_id,event_id"),
    ({"user_id": ""}, 0.85, "missing:user_id"),
    ({"user_id": " \t  \n"}, 0.85, "missing:user_id"),
    ({"event_type": "weird"}, 0.8, "invalid_event_type:weird"),
    ({"event_type": ""}, 0.85, "missing:event_type"),
    ({"device_type": "smart_tv"}, 0.9, "invalid_device:smart_tv"),
    ({"device_type": None}, 1.0, None),
    ({"timestamp": at("2026-05-30 02:00:00")}, 0.9, "future_timestamp"),
    ({"timestamp": at("2026-05-20")}, 0.9, "stale_timestamp"),
    ({"timestamp": at("2026-05-23")}, 1.0, None),
    ({"timestamp": None}, 0.85, "missing:timestamp"),
    ({"response_time_ms": 60000}, 0.95, "high_response_time:60000ms"),
    ({"response_time_ms": 30000}, 1.0, None),
])
def test_quality_rules(spark, fields, score, flags):
    got = scored(spark, **fields)
    assert got[0] == pytest.approx(score) and got[1] == flags


def test_worst_case_is_zero(spark):
    score, flags = scored(spark, event_id=None, user_id=None, session_id=None, event_type="invalid",
                          timestamp=at("2026-06-19"), device_type="x", response_time_ms=60000)
    assert score == 0.0
    assert flags == ("missing:user_id,session_id,event_id,invalid_event_type:invalid,invalid_device:x,"
                     "future_timestamp,stale_timestamp,high_response_time:60000ms")


def test_the_last_bit_decides(spark):
    score, _ = scored(spark, user_id=None, session_id=None, event_type="bogus")
    assert score == 1.0 - 0.15 * 2 - 0.2 and score < 0.5


def test_text_timestamps(spark):
    rows = [("e", "click", "u", "s", text, "mobile", 1) for text in ("2026-05-29T10:00:00Z", "nonsense", "")]
    df = spark.createDataFrame(rows, QUALITY.replace("timestamp timestamp", "timestamp string"))
    got = [(r.quality_score, r.quality_flags) for r in events.score_quality(df, AS_OF).collect()]
    assert got == [(1.0, None), (0.85, "invalid_timestamp"), (0.85, "missing:timestamp")]


def test_split_is_complete(spark, bronze_events):
    damaged = bronze_events.withColumn("user_id", F.lit(None).cast("string")).withColumn(
        "event_type", F.when(F.col("event_id") < "b3", "bogus").otherwise(F.col("event_type"))
    ).withColumn("session_id", F.when(F.col("event_id") != "b1", F.col("session_id")))
    passed, quarantined = events.split_quality(events.score_quality(damaged, AS_OF))
    assert (passed.count(), quarantined.count()) == (5, 1)


def test_dedup_keeps_the_earliest(spark):
    rows = [("d1", at("2026-05-29 10:00:05"), "b"), ("d1", at("2026-05-29 10:00:00"), "a"),
            ("d2", at("2026-05-29 10:00:00"), "c")]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp, event_type string")
    got = by(events.deduplicate(df), "event_id")
    assert len(got) == 2 and got["d1"].event_type == "a"


def test_dedup_per_day(spark):
    rows = [("d1", at("2026-05-29 23:59:59"), "2026-05-29"), ("d1", at("2026-05-30 00:00:01"), "2026-05-30")]
    df = spark.createDataFrame(rows, "event_id string, timestamp timestamp, event_date string")
    assert events.deduplicate(df).count() == 1
    assert events.deduplicate(df, per_day=True).count() == 2


def test_enrichment(bronze_events):
    rows = by(events.enrich(bronze_events), "event_id")
    assert [rows[f"b{i}"].event_number_in_session for i in range(1, 7)] == [1, 2, 3, 1, 2, 4]
    first = rows["b1"]
    assert (first.hour_of_day, first.day_of_week) == (14, 6)  # a Friday
    assert first.traffic_source == "organic" and rows["b4"].traffic_source == "social"
    assert rows["b6"].is_purchase_event and rows["b5"].is_error_event and not first.is_error_event


@pytest.mark.parametrize("text, seconds, label", [
    ("5m", 300, "5m"), ("15m", 900, "15m"), ("30m", 1800, "30m"), ("1h", 3600, "1h"), ("6h", 21600, "6h"),
    ("24h", 86400, "24h"), (" 2H ", 7200, "2h"), ("90s", 90, "90s"), ("120", 120, "2m"), (3600, 3600, "1h"),
])
def test_window_widths(text, seconds, label):
    assert window_seconds(text) == seconds and window_label(seconds) == label
