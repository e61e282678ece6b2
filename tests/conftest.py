import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from pyspark.sql import SparkSession  # noqa: E402

from clickweir import schemas  # noqa: E402
from support import clean_row, frame, silver_row  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bronze_events(spark):
    """Two sessions that overlap in time."""
    def row(event_id, kind, clock, session, **fields):
        return clean_row(event_id, kind, f"2026-05-29 {clock}", session_id=session, **fields)

    return frame(spark, [
        row("b1", "search", "14:10:05", "north", response_time_ms=90),
        row("b2", "page_view", "14:10:40", "north", response_time_ms=70),
        row("b3", "add_to_cart", "14:12:10", "north", amount=18.5, response_time_ms=310),
        row("b4", "page_view", "14:20:00", "south", referrer_url="https://instagram.com/p", device_type="mobile"),
        row("b5", "error", "14:21:30", "south", error_code=503, status_code=503, response_time_ms=900),
        row("b6", "purchase", "14:30:00", "north", amount=18.5),
    ], schemas.CLEAN_EVENT)


@pytest.fixture(scope="session")
def silver_events(spark):
    """Four sessions of three users: one buys, one bounces, one meets an error, one only searches."""
    sessions = {
        "red": ("u7", [
            ("08:15:00", "page_view", {"page_url": "/home", "response_time_ms": 140}),
            ("08:15:45", "page_view", {"page_url": "/shoes", "response_time_ms": 60}),
            ("08:16:30", "click", {"response_time_ms": 95}),
            ("08:20:00", "add_to_cart", {"amount": 30.0, "response_time_ms": 220}),
            ("08:25:00", "purchase", {"amount": 30.0, "page_url": "/paid", "response_time_ms": 1200})]),
        "blue": ("u8", [
            ("08:40:00", "page_view", {"device_type": "mobile", "country": "JP", "traffic_source": "social", "response_time_ms": 410})]),
        "green": ("u9", [
            ("09:05:00", "login", {"traffic_source": "direct", "response_time_ms": 350}),
            ("09:06:00", "page_view", {"response_time_ms": 180}),
            ("09:10:00", "click", {"response_time_ms": 75}),
            ("09:30:00", "error", {"error_code": 503, "response_time_ms": 6200})]),
        "grey": ("u7", [
            ("11:00:00", "search", {"traffic_source": "email", "response_time_ms": 2100}),
            ("11:02:00", "logout", {"traffic_source": "email", "response_time_ms": 40})]),
    }
    rows = [(session, user, *event) for session, (user, held) in sessions.items() for event in held]
    return frame(spark, [
        silver_row(f"a{n:02d}", kind, f"2026-05-29 {clock}", session_id=session, user_id=user, **fields)
        for n, (session, user, clock, kind, fields) in enumerate(rows, 1)
    ], schemas.SILVER_EVENT)
