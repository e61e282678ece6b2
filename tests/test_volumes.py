"""What the jobs move: nothing that follows from other columns, and nothing that no one asks for."""

from support import TESTDATA, at, raw_frame

from checks import lake
from clickweir.operators import ingest
from clickweir.operators.ordering import number_in_group, slice_width
from clickweir.sources import clicks, raw, tables


def test_derived_fields_are_added_after_the_shuffles(spark):
    text = clicks.visited(spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert "AS page_url" in text and text.index("AS page_url") < text.index("Window")
    assert text.rindex("AS page_url") < text.index("Exchange")


def test_visits_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(clicks.events_path(TESTDATA)).filter("false").write.parquet(clicks.events_path(str(tmp_path)))
    empty = clicks.visited(spark, str(tmp_path))
    assert empty.count() == 0 and empty.columns == clicks.visited(spark, TESTDATA).columns


def test_lines_of_clean_rows_are_not_kept(spark):
    good = '{"event_id": "1", "event_type": "click", "timestamp": "2024-01-01T00:00:00Z"}'
    parsed = ingest.without_lines(ingest.parse_events(raw_frame(spark, [good, "{broken"])))
    assert {r.raw_value: r.error_reason for r in parsed.collect()} == {None: None, "{broken": "missing_event_id"}


def test_slices_are_as_wide_as_the_rows_allow(spark):
    assert slice_width(100_000, 86400, widest=86400) == 86400
    assert slice_width(60_000_000, 86400, widest=86400) == 8640
    rows = [(str(i), "s", at(f"2024-01-0{1 + i % 2} {i % 24:02d}:00:00")) for i in range(48)]
    df = spark.createDataFrame(rows, "event_id string, session_id string, timestamp timestamp")
    narrow, wide = ({r.event_id: r.n for r in number_in_group(df, ["session_id"], "n", slice_seconds=w).collect()} for w in (300, 86400))
    assert narrow == wide


def test_line_files_are_compressed_and_whole(spark):
    path = lake.lines_folder(spark, TESTDATA)
    names = [n for n in tables._children(spark, path) if n.startswith("part-")]
    assert names and all(name.endswith(".gz") for name in names)
    assert raw.read_lines(spark, path).count() == clicks.repeated(lake.visited(spark, TESTDATA)).count()


def test_gold_tables_are_made_as_they_are_asked_for(spark, monkeypatch):
    made = []
    monkeypatch.setattr(lake, "GOLD", {n: lambda *at, n=n, **given: made.append(n) or {} for n in lake.GOLD})
    monkeypatch.setattr(lake, "_BUILT", {})
    monkeypatch.setattr(lake, "silver_lake", lambda *at: None)
    monkeypatch.setattr(lake, "dates", lambda *at: {})
    for names in (("funnels",), ("kpis", "sessions"), ("funnels", "kpis")):
        lake.gold_lake(spark, TESTDATA, *names)
    assert made == ["funnels", "kpis", "sessions"]
