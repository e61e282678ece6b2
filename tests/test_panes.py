import random

import pytest
from pyspark.sql import functions as F
from support import at, frame, silver_row

from clickweir import schemas
from clickweir.operators import kpis, panes

AS_OF = at("2026-05-30")


@pytest.fixture(scope="module")
def events(spark):
    """Two days of events: a hot user and session, sessions of one event, NULL ids, amounts and times."""
    pick, rows = random.Random(5), []
    for i in range(1500):
        second = pick.randrange(2 * 86400) if i % 3 else 36000 + pick.randrange(900)
        rows.append(silver_row(
            f"e{i}", pick.choice([*kpis.COUNTED.values(), "logout"]),
            f"2026-05-{28 + second // 86400} {second % 86400 // 3600:02}:{second % 3600 // 60:02}:{second % 60:02}",
            session_id=pick.choice(["hot", f"s{i}", f"s{i % 90}", None]), user_id=pick.choice(["u", f"u{i % 200}", None]),
            response_time_ms=pick.choice([None, pick.randrange(5000)]), amount=pick.choice([None, 10.5, 20.25])))
    rows += rows[:40]  # repeated rows
    return frame(spark, rows, schemas.SILVER_EVENT)


def rows_of(df, *without):
    return sorted(tuple(r) for r in df.drop(*without).collect())


@pytest.mark.parametrize("width,slide", [(3600, 900), (3600, 2400), (5400, 5400)])
def test_sliding_kpis_equal_those_from_events(events, width, slide):
    """Also where the slide does not divide the width. (Spark refuses a slide longer than the width.)"""
    got = panes.sliding_kpis(events, width, slide, as_of=AS_OF)
    assert rows_of(got) == rows_of(kpis.windowed_kpis(events, width, slide, exact=True, as_of=AS_OF))


def test_events_are_not_copied_into_windows(events):
    """Every Expand or Generate over windows lies above an aggregation of its rows."""
    plan = panes.sliding_kpis(events, 3600, 900)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    for i, line in enumerate(plan):
        if "Expand" in line:
            below = []
            for other in plan[i + 1:]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            assert any("Aggregate" in other for other in below), line


@pytest.mark.parametrize("width,slide", [(3600, None), (86400, None), (3600, 900)])
def test_windows_from_the_stored_panes_alone(spark, events, tmp_path, width, slide):
    panes.panes(events).write.parquet(str(tmp_path / "panes"))
    table = spark.read.parquet(str(tmp_path / "panes"))
    estimated = ["unique_users", "unique_sessions", "p95_response_time_ms", "bounce_rate"]
    got = panes.rolled_up(table, width, slide, as_of=AS_OF)
    exact = kpis.windowed_kpis(events, width, slide, exact=True, as_of=AS_OF)
    assert got.dtypes == exact.dtypes
    assert rows_of(got, *estimated) == rows_of(exact, *estimated)
    pairs = got.alias("g").join(exact.alias("x"), "window_start")
    far = pairs.where(" OR ".join(f"abs(g.{n} - x.{n}) > greatest(1, 0.05 * x.{n})" for n in estimated[:2]))
    assert far.isEmpty()
    bounds = events.groupBy(F.window("timestamp", f"{width} seconds", f"{slide or width} seconds").start.alias("window_start")).agg(
        F.percentile_approx("response_time_ms", [0.92, 0.98]).alias("b"))
    off = got.join(bounds, "window_start").where("NOT coalesce(p95_response_time_ms BETWEEN b[0] AND b[1], p95_response_time_ms IS NULL AND b IS NULL)")
    assert off.isEmpty()


def test_nothing_gives_nothing(spark, events):
    none = events.limit(0)
    assert panes.sliding_kpis(none, 3600, 900).isEmpty() and panes.rolled_up(panes.panes(none)).isEmpty()


def test_windows_have_to_be_whole_panes(events):
    with pytest.raises(ValueError):
        panes.rolled_up(panes.panes(events), 3600, 400)
