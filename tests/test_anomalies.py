import pytest
from support import at, by

from clickweir.operators import anomalies

SCHEMA = "event_id string, event_type string, response_time_ms int, error_code int, timestamp timestamp"
WHEN = at("2026-05-29 10:00:00")


def batch(spark, rows):
    return spark.createDataFrame([(f"e{i}", kind, rt, None, WHEN) for i, (kind, rt) in enumerate(rows)], SCHEMA)


def flagged(df, **kw):
    return {r.event_id: r for r in anomalies.flag_anomalies(df, **kw).filter("is_anomaly").collect()}


def test_too_few_samples(spark):
    assert flagged(batch(spark, [("error", 10_000)] * 5)) == {}


def test_error_spike(spark):
    got = flagged(batch(spark, [("page_view", 100)] * 19 + [("error", 100)] * 3))
    assert set(got) == {"e19", "e20", "e21"}
    assert {r.anomaly_type for r in got.values()} == {"error_rate_spike"} and got["e19"].anomaly_score == 2.0


def test_slow_response(spark):
    got = flagged(batch(spark, [("page_view", 100)] * 19 + [("page_view", 10_000)]))
    assert set(got) == {"e19"} and got["e19"].anomaly_type == "slow_response"
    assert got["e19"].anomaly_score == pytest.approx(1.42)


def test_no_times_and_equal_times(spark):
    assert flagged(batch(spark, [("page_view", None)] * 20)) == {}
    assert flagged(batch(spark, [("page_view", 100)] * 20)) == {}


def test_error_rate_at_the_limit_is_no_spike(spark):
    assert flagged(batch(spark, [("page_view", 100)] * 19 + [("error", 100)])) == {}


def test_days_are_judged_alone(spark):
    rows = [(f"a{i}", "error", 10, None, WHEN, "2026-05-29") for i in range(3)]
    rows += [(f"b{i}", "error" if i < 2 else "click", 10, None, WHEN, "2026-05-30") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA + ", event_date string")
    assert set(flagged(df, per_day=True)) == {"b0", "b1"}


def test_trends(spark):
    def at_minute(m, kind="page_view"):
        return (f"{m}-{kind}", kind, 10, None, at(f"2026-05-29 {m // 60:02d}:{m % 60:02d}:00"))

    # Two events every five minutes of the first hour, then ten, then silence and one more.
    rows = [at_minute(m) for m in range(0, 60, 5)] + [at_minute(m + 1) for m in range(0, 60, 5)]
    rows += [at_minute(60) for _ in range(10)] + [at_minute(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {str(r.window_start)[11:16]: r for r in anomalies.traffic_spikes(df).collect()}
    assert got["00:00"].rolling_avg is None and not got["00:00"].is_spike
    assert got["01:00"].rolling_avg == 2.0 and got["01:00"].is_spike
    assert got["02:00"].rolling_avg == pytest.approx(10 / 12)

    rows = [at_minute(0, "purchase"), at_minute(1, "purchase"), at_minute(2, "purchase"), at_minute(5, "purchase"),
            at_minute(30)]
    drops = by(anomalies.purchase_drops(spark.createDataFrame(rows, SCHEMA)), "window_start")
    got = [(str(k)[11:16], r.purchases, r.previous_purchases, r.is_drop) for k, r in sorted(drops.items())]
    assert got == [("00:00", 3, 0, False), ("00:05", 1, 3, True), ("00:10", 0, 1, True)]

    slow = anomalies.slow_windows(batch(spark, [("click", 100)] * 99 + [("click", 9000)] * 2)).first()
    assert slow.p99_response_time_ms == 9000 and slow.is_slow


def test_no_rows_and_rows_without_date(spark):
    schema = "event_id string, event_type string, response_time_ms int, event_date string"
    empty = spark.createDataFrame([], schema)
    assert anomalies.flag_anomalies(empty).count() == 0
    assert anomalies.batch_stats(empty).first()["_rows"] == 0
    rows = spark.createDataFrame([("a", "error", 5, None), ("b", "click", 5, "2024-01-01")], schema)
    got = anomalies.flag_anomalies(rows, per_day=True, min_samples=1).collect()
    assert {(r.event_id, r.is_anomaly) for r in got} == {("a", False), ("b", False)}
