import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import anomalies, rollups, trends
from clickweir.plans import gold, main
from clickweir.plans.config import Layout
from clickweir.sources import tables
from support import at, frame, silver_row

AS_OF = "2026-06-01 00:00:00"
START = at("2026-05-28 22:00:00")


@pytest.fixture(scope="module")
def three_days(spark):
    """Calm traffic over two midnights, with silent stretches, bursts right after midnight and slow responses."""
    pick, found = random.Random(5), []
    for step in range(36 * 12):
        if step % 50 in (30, 31, 32):
            continue
        now = START + timedelta(minutes=5 * step)
        burst = 12 if (now.hour, now.minute) in ((0, 5), (13, 30)) else 1
        for n in range(pick.randint(1, 3) * burst):
            when = (now + timedelta(seconds=pick.randint(0, 299))).strftime("%Y-%m-%d %H:%M:%S")
            kind = pick.choice(["page_view", "purchase", "click"])
            slow = pick.choice([50, None, 7000 if step % 40 == 7 else 300])
            found.append(silver_row(f"{step}-{n}", kind, when, response_time_ms=slow))
    return frame(spark, found, schemas.SILVER_EVENT).coalesce(2)


def rows(df):
    return sorted(map(str, df.collect()))


def test_one_table_says_what_the_three_operators_say(three_days):
    table = trends.trends(three_days, as_of=AS_OF)
    def of(kind, *columns):
        return table.filter(F.col("trend_type") == kind).select("window_start", *columns, "is_triggered")
    traffic = anomalies.traffic_spikes(three_days).select(
        "window_start", F.col("event_count").cast("double"), "rolling_avg", "is_spike")
    assert rows(of("traffic_spike", "metric_value", "baseline").toDF(*traffic.columns)) == rows(traffic.toDF(*traffic.columns[:1], "event_count", *traffic.columns[2:]))
    drops = anomalies.purchase_drops(three_days).select(
        "window_start", F.col("purchases").cast("double").alias("p"), F.col("previous_purchases").cast("double").alias("q"), "is_drop")
    assert rows(of("purchase_drop", "metric_value", "baseline").toDF(*drops.columns)) == rows(drops)
    slow = anomalies.slow_windows(three_days).filter("is_slow IS NOT NULL").select(
        "window_start", F.col("p99_response_time_ms").cast("double").alias("p"), "is_slow")
    assert rows(of("slow_window", "metric_value").toDF(*slow.columns)) == rows(slow)
    hits = {r["trend_type"] for r in table.filter("is_triggered").collect()}
    assert hits == {"traffic_spike", "purchase_drop", "slow_window"}
    assert table.filter("trend_score > 2 OR (is_triggered AND trend_score < 1)").count() == 0


def test_range_equals_its_days_and_reruns(spark, three_days, tmp_path):
    silver = str(tmp_path / "silver")
    three_days.write.partitionBy("event_date").parquet(silver)
    days = ["2026-05-28", "2026-05-29", "2026-05-30"]
    ranged, daily = Layout(str(tmp_path / "r"), silver=silver), Layout(str(tmp_path / "d"), silver=silver)
    stats = gold.run_trends(spark, ranged, start=days[0], end=days[-1], as_of=AS_OF)
    singles = [gold.run_trends(spark, daily, event_date=day, as_of=AS_OF) for day in days]
    assert stats == {name: sum(s[name] for s in singles) for name in stats} and stats["trend_alerts_sent"] > 5
    whole = trends.trends(three_days, as_of=AS_OF)
    for layout in (ranged, daily):
        assert rows(tables.read_table(spark, layout.trends, schemas.TREND)) == rows(whole)
    sent = spark.read.json(daily.trend_alerts)
    assert sent.count() == sent.select("key").distinct().count() == stats["trend_alerts_sent"]
    # The burst after midnight is judged by the evening before.
    midnight = whole.filter("trend_type = 'traffic_spike' AND window_start = '2026-05-29 00:05:00'").first()
    assert midnight["is_triggered"] and midnight["baseline"] > 0
    gold.run_trends(spark, daily, event_date=days[1], as_of=AS_OF)
    assert rows(spark.read.json(daily.trend_alerts)) == rows(spark.read.json(ranged.trend_alerts))
    # Silver without these rows any more: the trends and alerts of the date go.
    bare = Layout(daily.root, silver=str(tmp_path / "none"))
    assert gold.run_trends(spark, bare, event_date=days[1], as_of=AS_OF)["trends_written"] == 0
    assert tables.read_dates(spark, bare.trends, schemas.TREND, days[1], days[1], "5m").count() == 0
    assert spark.read.json(daily.trend_alerts).filter(f"event_date = '{days[1]}'").count() == 0


def test_alerts_of_trends(spark):
    found = [silver_row(f"e{n}", "purchase", f"2026-05-29 10:00:{n:02d}", response_time_ms=8000) for n in range(4)]
    found += [silver_row("e9", "click", "2026-05-29 10:06:00", response_time_ms=None)]
    table = trends.trends(frame(spark, found, schemas.SILVER_EVENT), as_of=AS_OF)
    alerts = {r["anomaly_type"]: r for r in trends.trend_alerts(table, AS_OF).collect()}
    assert set(alerts) == {"purchase_drop", "slow_window"}
    drop, slow = alerts["purchase_drop"], alerts["slow_window"]
    assert (drop["anomaly_score"], drop["event_type"], drop["event_id"]) == (2.0, "purchase", None)
    assert drop["message"] == "Purchase drop detected: 0 purchases in 5m from 2026-05-29T10:05:00, 4 before"
    assert drop["metadata"] == {"window_duration": "5m", "metric_value": "0.0", "baseline": "4.0", "metric_threshold": "2.0"}
    assert (slow["response_time_ms"], slow["anomaly_score"]) == (8000, 1.6) and "baseline" not in slow["metadata"]
    assert drop["alert_id"].startswith("alert-purchase_drop-5m-")


def test_nothing_and_no_moves(spark, three_days):
    empty = three_days.limit(0)
    assert trends.trends(empty).collect() == [] and trends.trend_alerts(trends.trends(empty)).collect() == []
    plan = trends.trends(three_days, trends.span_of(three_days))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" in plan


def test_command_line(spark, three_days, tmp_path, capsys):
    three_days.write.partitionBy("event_date").parquet(f"{tmp_path}/silver/events_clean")
    stats = main.main(["--root", str(tmp_path), "gold", "--mode", "trends", "--date", "2026-05-29"])
    assert stats["trends_written"] > 0 and json.loads(capsys.readouterr().out.splitlines()[-1]) == stats


def test_bins_of_few_and_many_values(spark):
    few = spark.createDataFrame([(float(i % 7),) for i in range(200)] + [(None,), (float("nan"),), (-0.0,)], "x double")
    assert rollups.numeric_histogram(few, "x").count() == 7
    many = spark.range(100_000).selectExpr("CAST(id AS double) AS x")
    assert rollups.numeric_histogram(many, "x").count() == 50
    assert rollups.numeric_histogram(many, "x", 3000).count() == 3000
    assert rollups.numeric_histogram(few.limit(0), "x").count() == 0
    edge = spark.range(50).selectExpr("CAST(id AS double) AS x")
    assert rollups.numeric_histogram(edge, "x").count() == 50 == rollups.numeric_histogram(edge.filter("x < 49"), "x").count() + 1
