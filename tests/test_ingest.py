import json

import pytest
from support import at, by, frame, raw_frame
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from clickweir import schemas
from clickweir.operators import ingest
from clickweir.sources import raw


def event(**fields):
    base = {"event_id": "evt-1", "event_type": "page_view", "user_id": "u", "session_id": "s",
            "timestamp": "2026-05-29T10:00:00+00:00", "amount": "49.99", "error_code": None,
            "response_time_ms": "150", "status_code": "200"}
    return {**base, **fields}


def test_parse_split_and_types(spark):
    parsed = ingest.parse_events(raw_frame(spark, [
        event(), event(event_id="evt-2", event_type="purchase", timestamp="2026-05-29T10:01:00Z"),
        event(event_id="evt-3", event_type="error", error_code="500", response_time_ms="4500"),
        event(event_id=None),
    ]))
    clean, dead = ingest.clean_events(parsed), ingest.dead_letters(parsed, at("2026-05-30"))
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in schemas.CLEAN_EVENT]
    rows = by(clean, "event_id")
    assert set(rows) == {"evt-1", "evt-2", "evt-3"}
    assert (rows["evt-3"].error_code, rows["evt-3"].response_time_ms) == (500, 4500)
    assert rows["evt-1"].amount == 49.99 and rows["evt-1"].event_date == "2026-05-29"
    (bad,) = dead.collect()
    assert bad.error_reason == "missing_event_id" and bad.error_timestamp == "2026-05-30T00:00:00+00:00"
    assert json.loads(bad.raw_value)["event_type"] == "page_view"


@pytest.mark.parametrize("text, number", [("49.99", 49.99), ("None", None), ("abc", None), ("", None), (None, None)])
def test_amount_coercion(spark, text, number):
    assert ingest.parse_events(raw_frame(spark, [event(amount=text)])).first().amount == number


@pytest.mark.parametrize("text, number", [("500", 500), (" 7 ", 7), ("500.0", None), ("xyz", None), ("", None)])
def test_integer_coercion(spark, text, number):
    assert ingest.parse_events(raw_frame(spark, [event(error_code=text)])).first().error_code == number


def test_native_numbers_are_read_too(spark):
    row = ingest.parse_events(raw_frame(spark, [event(amount=12.5, response_time_ms=245)])).first()
    assert (row.amount, row.response_time_ms) == (12.5, 245)


@pytest.mark.parametrize("fields, reason", [
    ({"event_id": None}, "missing_event_id"), ({"event_id": ""}, "missing_event_id"),
    ({"event_type": None}, "missing_event_type"), ({"event_type": ""}, "missing_event_type"),
    ({"timestamp": None}, "invalid_timestamp"), ({"timestamp": "not a time"}, "invalid_timestamp"),
    ({"event_id": "  "}, None),
])
def test_reject_reasons(spark, fields, reason):
    assert ingest.parse_events(raw_frame(spark, [event(**fields)])).first().error_reason == reason


def test_broken_line_is_a_dead_letter(spark):
    (row,) = ingest.dead_letters(ingest.parse_events(raw_frame(spark, ["{not json"]))).collect()
    assert row.raw_value == "{not json" and row.event_id is None


def test_split_typed_frame(spark):
    schema = StructType([StructField("event_id", StringType()), StructField("event_type", StringType()),
                         StructField("timestamp", TimestampType())])
    now = at("2026-05-29")
    rows = [("a", "click", now), (None, "click", now), ("", "click", now), ("b", None, now), ("c", "click", None)]
    clean, bad = ingest.split_malformed(spark.createDataFrame(rows, schema))
    assert [r.event_id for r in clean.collect()] == ["a"] and bad.count() == 4
    clean, bad = ingest.split_malformed(spark.createDataFrame([(None, None, None), ("", "", None)], schema))
    assert (clean.count(), bad.count()) == (0, 2)


def test_array_files(spark, tmp_path):
    events = [event(event_id=f"e{i}", amount=None, response_time_ms=12000 if i == 3 else 10) for i in range(8)]
    (tmp_path / "a.json").write_text(json.dumps(events, indent=2))
    parsed = ingest.parse_events(raw.read_array_files(spark, str(tmp_path)))
    rows = by(ingest.clean_events(parsed), "event_id")
    assert len(rows) == 8 and rows["e3"].response_time_ms == 12000


def test_conform_casts_and_orders(spark, bronze_events):
    shuffled = bronze_events.select(*reversed(bronze_events.columns)).withColumn("extra", bronze_events.event_id)
    assert schemas.conform(shuffled, schemas.CLEAN_EVENT).columns == schemas.CLEAN_EVENT.fieldNames()
    assert frame(spark, [], schemas.SILVER_EVENT).count() == 0
    assert len(schemas.CLEAN_EVENT) == 22 and len(schemas.SILVER_EVENT) == 35
    assert [len(s) for s in (schemas.KPI, schemas.SESSION, schemas.FUNNEL, schemas.ANOMALY_SUMMARY)] == [25, 23, 12, 13]
