"""Rows and frames that several tests build."""

import json
from datetime import datetime, timezone

TESTDATA = "/root/testdata/sf0.001"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def frame(spark, rows, schema):
    """Rows given as dicts; absent fields are NULL. The schema may be a list of fields."""
    names = schema.fieldNames()
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], loose)


def raw_frame(spark, events):
    return spark.createDataFrame([(e if isinstance(e, str) else json.dumps(e),) for e in events], "raw_value string")


CLEAN_DEFAULTS = {
    "user_id": "u1", "session_id": "s1", "page_url": "/list", "referrer_url": "https://google.com",
    "user_agent": "agent", "device_type": "desktop", "browser": "Firefox", "os": "Linux", "country": "NO",
    "city": "Oslo", "ip_address": "10.9.8.7", "status_code": 200, "response_time_ms": 110,
}


def clean_row(event_id, event_type, when, **fields):
    moment = at(when)
    return {**CLEAN_DEFAULTS, "event_id": event_id, "event_type": event_type, "timestamp": moment,
            "event_date": when[:10], **fields}


def silver_row(event_id, event_type, when, **fields):
    return {
        "is_purchase_event": event_type == "purchase", "is_error_event": event_type == "error",
        "traffic_source": "organic", "event_number_in_session": 1, "quality_score": 1.0, "is_anomaly": False,
        "processed_at": at(when), "silver_version": "1.0.0", **clean_row(event_id, event_type, when, **fields),
    }


def by(df, key):
    """Collected rows by one column."""
    return {row[key]: row for row in df.collect()}
