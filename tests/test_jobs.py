import json

import pytest
from support import TESTDATA
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import anomalies, events
from clickweir.functions import timing
from clickweir.plans import bronze, gold, main, silver
from clickweir.plans.config import Layout
from clickweir.sources import clicks, session, tables

AS_OF = clicks.AS_OF


def rows(df):
    return sorted(map(str, df.collect()))


def write_lines(folder, name, events_):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events_) + "\n")


def event(event_id, when="2024-01-15T10:00:00Z", **fields):
    return {"event_id": event_id, "event_type": "page_view", "user_id": "u1", "session_id": "s1", "timestamp": when,
            "device_type": "mobile", "response_time_ms": "100", **fields}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """All given events through bronze and silver, days 1 to 31."""
    root = tmp_path_factory.mktemp("lake")
    lines = clicks.raw_lines(clicks.repeated(clicks.blemished(clicks.visited(spark, TESTDATA))))
    lines.write.text(f"{root}/lines")
    layout = Layout(f"{root}/tables")
    bronze.run_batch(spark, layout, f"{root}/lines", as_of=AS_OF)
    stats = silver.run(spark, layout, start="2024-01-01", end="2024-01-31", as_of=AS_OF)
    return layout, stats


def test_bronze_counts_and_replay(spark, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    write_lines(tmp_path / "in", "a.jsonl", [event("e1"), event(None)])
    path = str(tmp_path / "in")
    assert bronze.run_batch(spark, layout, path) == {"clean": 1, "dead_letter": 1}
    assert bronze.run_batch(spark, layout, path) == {"clean": 1, "dead_letter": 1}
    table = tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT)
    assert [r.event_date for r in table.collect()] == ["2024-01-15"]
    assert dict(table.dtypes)["event_date"] == "string"

    # Another batch for the same date adds to it; a changed one replaces only itself.
    write_lines(tmp_path / "in2", "b.jsonl", [event("e2"), event("e3", when="2024-01-16T00:00:00Z")])
    bronze.run_batch(spark, layout, str(tmp_path / "in2"))
    write_lines(tmp_path / "in2", "b.jsonl", [event("e2")])
    assert bronze.run_batch(spark, layout, str(tmp_path / "in2")) == {"clean": 1, "dead_letter": 0}
    assert {r.event_id for r in tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT).collect()} == {"e1", "e2"}


def test_json_array_batch(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([event(f"e{i}", amount=1.5) for i in range(8)], indent=1))
    stats = bronze.run_batch(spark, Layout(str(tmp_path / "t")), str(tmp_path / "a.json"), json_array=True)
    assert stats == {"clean": 8, "dead_letter": 0}


def test_silver_parts_add_up(spark, lake):
    layout, stats = lake
    assert stats["after_dedup"] == stats["passed_quality"] + stats["quarantined"]
    assert stats["bronze_read"] > stats["after_dedup"] and stats["quarantined"] > 0
    table = tables.read_table(spark, layout.silver, schemas.SILVER_EVENT)
    assert stats["anomalies"] == table.filter("is_anomaly").count() == stats["alerts_sent"] > 0
    held = tables.read_table(spark, layout.quarantine, schemas.QUARANTINE)
    assert held.filter("quality_score >= 0.5").count() == 0 and held.count() == stats["quarantined"]


def test_range_equals_its_days(spark, lake, tmp_path):
    layout, _ = lake
    own = Layout(str(tmp_path), bronze=layout.bronze)
    days = ["2024-01-14", "2024-01-15", "2024-01-16"]
    one_by_one = [silver.run(spark, own, event_date=d, as_of=AS_OF) for d in days]
    ranged = Layout(str(tmp_path / "r"), bronze=layout.bronze)
    stats = silver.run(spark, ranged, start=days[0], end=days[-1], as_of=AS_OF)
    assert stats == {k: sum(s[k] for s in one_by_one) for k in stats}
    for name, schema in (("silver", schemas.SILVER_EVENT), ("quarantine", schemas.QUARANTINE)):
        assert rows(tables.read_table(spark, getattr(own, name), schema)) == rows(
            tables.read_table(spark, getattr(ranged, name), schema))

    gold_days = [gold.run_all(spark, own, event_date=d, as_of=AS_OF) for d in days]
    gold_range = gold.run_all(spark, ranged, start=days[0], end=days[-1], as_of=AS_OF)
    assert gold_range["sessions_written"] == sum(s["sessions_written"] for s in gold_days)
    for name, schema in (("kpis", schemas.KPI), ("sessions", schemas.SESSION), ("funnels", schemas.FUNNEL),
                         ("anomalies", schemas.ANOMALY_SUMMARY)):
        assert rows(tables.read_table(spark, getattr(own, name), schema)) == rows(
            tables.read_table(spark, getattr(ranged, name), schema))


def test_runs_can_be_repeated(spark, lake, tmp_path):
    layout, _ = lake
    own = Layout(str(tmp_path), bronze=layout.bronze)
    first = silver.run(spark, own, event_date="2024-01-15", as_of=AS_OF)
    before = rows(tables.read_table(spark, own.silver, schemas.SILVER_EVENT))
    sent = spark.read.json(own.alerts).count()
    assert silver.run(spark, own, event_date="2024-01-15", as_of=AS_OF) == first
    assert rows(tables.read_table(spark, own.silver, schemas.SILVER_EVENT)) == before
    assert spark.read.json(own.alerts).count() == sent

    stats = gold.run_all(spark, own, event_date="2024-01-15", as_of=AS_OF)
    assert stats["modes_run"] == ["kpis", "sessions", "funnels", "anomaly_aggs"] and stats["windows"] > 0
    gold.run_kpis(spark, own, event_date="2024-01-15", window="6h", as_of=AS_OF)
    hourly = tables.read_table(spark, own.kpis, schemas.KPI).filter("window_duration = '1h'").count()
    again = gold.run_all(spark, own, event_date="2024-01-15", as_of=AS_OF)
    assert again == stats and hourly == stats["windows"]
    assert tables.read_table(spark, own.kpis, schemas.KPI).filter("window_duration = '6h'").count() > 0


def test_rerun_without_rows_clears_the_partition(spark, tmp_path):
    layout = Layout(str(tmp_path / "t"))
    odd = {"user_id": None, "session_id": None, "event_type": "odd"}
    write_lines(tmp_path / "in", "a.jsonl", [event("e1", **odd), event("e2")])
    bronze.run_batch(spark, layout, str(tmp_path / "in"))
    stats = silver.run(spark, layout, as_of=AS_OF)
    assert (stats["passed_quality"], stats["quarantined"]) == (1, 1)
    gold.run_sessions(spark, layout, as_of=AS_OF)
    write_lines(tmp_path / "in", "a.jsonl", [event("e2")])
    bronze.run_batch(spark, layout, str(tmp_path / "in"))
    assert silver.run(spark, layout, as_of=AS_OF)["quarantined"] == 0
    assert tables.read_table(spark, layout.quarantine, schemas.QUARANTINE).count() == 0

    # Everything fails quality now: silver is emptied, the quarantine is still written.
    write_lines(tmp_path / "in", "a.jsonl", [event("e1", **odd)])
    bronze.run_batch(spark, layout, str(tmp_path / "in"))
    stats = silver.run(spark, layout, as_of=AS_OF)
    assert (stats["silver_written"], stats["quarantined"]) == (0, 1)
    assert tables.read_table(spark, layout.silver, schemas.SILVER_EVENT).count() == 0


def test_emptied_dates_and_half_given_ranges(spark, lake, tmp_path):
    layout, _ = lake
    own = Layout(str(tmp_path / "t"), bronze=layout.bronze)
    silver.run(spark, own, event_date="2024-01-15", as_of=AS_OF)
    gold.run_all(spark, own, event_date="2024-01-15", as_of=AS_OF)
    bare = Layout(own.root, bronze=str(tmp_path / "none"))
    tables.create_if_missing(spark, bare.bronze, schemas.CLEAN_EVENT, ["event_date"])
    assert set(silver.run(spark, bare, event_date="2024-01-15", as_of=AS_OF).values()) == {0}
    assert gold.run_all(spark, bare, event_date="2024-01-15", as_of=AS_OF)["sessions_written"] == 0
    for path, schema in ((bare.silver, schemas.SILVER_EVENT), (bare.sessions, schemas.SESSION), (bare.kpis, schemas.KPI)):
        assert tables.read_table(spark, path, schema).count() == 0
    for given in ({"start": "2024-01-01"}, {"end": "2024-01-01"}, {"start": "2024-01-02", "end": "2024-01-01"}):
        with pytest.raises(ValueError):
            silver.run(spark, own, **given)


def test_widths():
    assert [timing.window_seconds(w) for w in ("5m", "2H", "90s", 3600, " 24h ")] == [300, 7200, 90, 3600, 86400]
    assert [timing.window_label(s) for s in (300, 7200, 90, 86400, 1)] == ["5m", "2h", "90s", "24h", "1s"]
    for bad in ("", "0m", "-5m", "m", "1d", "1.5h", 0):
        with pytest.raises(ValueError):
            timing.window_seconds(bad)


def test_skip_anomalies(spark, lake, tmp_path):
    layout, _ = lake
    own = Layout(str(tmp_path), bronze=layout.bronze)
    stats = silver.run(spark, own, event_date="2024-01-15", skip_anomalies=True, as_of=AS_OF)
    assert stats["anomalies"] == stats["alerts_sent"] == 0 and stats["silver_written"] > 0
    assert not tables.exists(spark, own.alerts)


def test_default_is_the_newest_date(spark, lake, tmp_path):
    layout, _ = lake
    assert tables.latest_date(spark, layout.bronze) == "2024-01-30"
    own = Layout(str(tmp_path), bronze=layout.bronze)
    silver.run(spark, own, as_of=AS_OF)
    dates = tables.read_table(spark, own.silver, schemas.SILVER_EVENT).select("event_date").distinct().collect()
    assert [d[0] for d in dates] == ["2024-01-30"]


def test_nothing_to_do(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert set(silver.run(spark, layout).values()) == {0}
    stats = gold.run_all(spark, layout)
    assert stats["silver_read"] == stats["kpis_written"] == stats["sessions_written"] == 0
    assert tables.read_table(spark, str(tmp_path / "none"), schemas.SILVER_EVENT).columns == (
        schemas.SILVER_EVENT.fieldNames())
    assert not tables.create_if_missing(spark, layout.silver, schemas.SILVER_EVENT)


def test_widths_that_span_dates_are_refused(spark, lake):
    with pytest.raises(ValueError):
        gold.run_kpis(spark, lake[0], event_date="2024-01-15", window="7h")


def test_command_line(spark, tmp_path):
    write_lines(tmp_path / "in", "a.jsonl", [event("e1"), event("e2", event_type="purchase", amount="5")])
    root = ["--root", str(tmp_path / "t")]
    assert main.main([*root, "bronze", "--mode", "batch", "--input", str(tmp_path / "in")])["clean"] == 2
    assert main.main([*root, "silver", "--date", "2024-01-15"])["after_dedup"] == 2
    assert main.main([*root, "gold", "--mode", "kpis", "--window", "5m"])["windows"] == 1
    assert main.main([*root, "gold"])["sessions_written"] == 1


class _Session:
    """A session with or without the setting, on or off a cluster."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId, self._folder = master, f"app-{master}", folder

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self._folder or default


def test_shared_folder():
    assert session.shared_folder(_Session("spark://host:7077", "/shared/")) == "/shared"
    assert session.shared_folder(_Session("local[2]", "/shared")) == "/shared"
    with pytest.raises(ValueError):
        session.shared_folder(_Session("spark://host:7077"))
    own = _Session("local[2]")
    assert session.shared_folder(own) == session.shared_folder(own)
    assert session.scratch_path(own, "x") != session.scratch_path(own, "x")


def test_shuffles_fit_the_input(spark):
    assert session.partitions_for(10_000, 8) == 8
    assert session.partitions_for(10 * 2**40, 200) == 327_680
    assert session.partitions_for(2**40, 200) == 32_768
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), session.sized_shuffles(spark, 2**40):
        assert spark.conf.get(name) == "32768"
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_a_third_of_the_rows_without_session(spark, tmp_path):
    """One hot group through the whole silver step equals the plain computation."""
    base = clicks.visited(spark, TESTDATA)
    hot = base.withColumn("session_id", F.when(F.col("k") > 33, F.col("session_id"))).withColumn(
        "event_id", F.when(F.col("k") < 66, F.col("event_id")).otherwise("same"))
    scored = silver.scored_events(schemas.conform(hot, schemas.CLEAN_EVENT), AS_OF)
    days = hot.filter("event_id = 'same'").select("event_date").distinct().count()
    assert scored.filter("event_id = 'same'").count() == days
    per_day = scored.filter("session_id is null").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_number_in_session").alias("top"),
        F.count_distinct("event_number_in_session").alias("distinct"))
    assert per_day.filter("n <> top or n <> distinct").count() == 0
    flags = anomalies.flag_anomalies(events.split_quality(scored)[0], per_day=True)
    assert flags.count() == events.split_quality(scored)[0].count()


def exactly(df):
    """Rows with sums of amounts to six digits: the last bits depend on the order they were added in."""
    return rows(df.withColumns({n: F.round(n, 6) for n in ("revenue_total", "revenue_avg", "avg_response_time_ms")}))


def test_kpis_from_stored_panes(spark, lake, tmp_path):
    """Hours and days of a range from its panes alone, run twice; a date without panes loses its rows."""
    own = Layout(str(tmp_path), silver=lake[0].silver)
    days = {"start": "2024-01-14", "end": "2024-01-16"}
    stats = gold.run_panes(spark, own, **days)
    assert stats["panes_written"] == tables.read_table(spark, own.panes, schemas.KPI_PANE).count() > 0
    blind = Layout(str(tmp_path), silver=str(tmp_path / "no-silver"))
    estimated = ["unique_users", "unique_sessions", "p95_response_time_ms", "bounce_rate"]
    for window in ("1h", "24h", "1h"):
        assert gold.run_rolled_up(spark, blind, window=window, as_of=AS_OF, **days)["panes_read"] == stats["panes_written"]
        exact = Layout(str(tmp_path / "exact"), silver=lake[0].silver)
        gold.run_kpis(spark, exact, window=window, as_of=AS_OF, exact=True, **days)
        got, want = (tables.read_dates(spark, x.kpis, schemas.KPI, *days.values(), window=window) for x in (own, exact))
        assert exactly(got.drop(*estimated)) == exactly(want.drop(*estimated))
    gold.run_panes(spark, Layout(str(tmp_path), silver=str(tmp_path / "no-silver")), event_date="2024-01-15")
    gold.run_rolled_up(spark, own, window="1h", as_of=AS_OF, **days)
    left = tables.read_dates(spark, own.kpis, schemas.KPI, *days.values(), window="1h").select("event_date").distinct()
    assert rows(left) == ["Row(event_date='2024-01-14')", "Row(event_date='2024-01-16')"]
