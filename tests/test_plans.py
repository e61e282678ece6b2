"""What the physical plans must and must not contain."""

import re

import pytest
from support import TESTDATA
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import anomalies, events, funnels, kpis, sessions, summaries
from clickweir.plans import silver
from clickweir.sources import clicks, tables


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "bronze")
    rows = schemas.conform(clicks.visited(spark, TESTDATA), schemas.CLEAN_EVENT)
    tables.append_batch(rows, path, ["event_date", "event_type"], "b")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_silver_and_gold(spark, table):
    bronze = tables.read_table(spark, table, schemas.CLEAN_EVENT)
    scored = silver.scored_events(bronze, clicks.AS_OF)
    flagged = anomalies.flag_anomalies(scored, per_day=True)
    for df in (flagged, kpis.windowed_kpis(flagged), sessions.session_metrics(flagged), funnels.funnels(flagged),
               summaries.anomaly_summary(flagged)):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text


def test_dates_prune_partitions(spark, table):
    pruned = tables.between_dates(tables.read_table(spark, table, schemas.CLEAN_EVENT), "2024-01-10", "2024-01-12")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan(pruned))
    listed = tables.read_dates(spark, table, schemas.CLEAN_EVENT, "2024-01-10", "2024-01-12")
    assert {f.split("event_date=")[1][:10] for f in listed.inputFiles()} == {"2024-01-10", "2024-01-11", "2024-01-12"}


def test_dedup_limits_groups_before_the_shuffle(spark, table):
    text = plan(events.deduplicate(tables.read_table(spark, table, schemas.CLEAN_EVENT)))
    assert text.count("WindowGroupLimit") == 2


def test_wide_rows_are_shuffled_once_for_numbering(spark, table):
    text = plan(events.number_events(tables.read_table(spark, table, schemas.CLEAN_EVENT)))
    main = text.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") == 1


def test_kpis_read_only_what_they_need(spark, table):
    text = plan(kpis.windowed_kpis(tables.read_table(spark, table, schemas.CLEAN_EVENT)))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert read and all("page_url" not in columns and "user_agent" not in columns for columns in read)


def test_sessions_take_one_shuffle(spark, table):
    df = tables.read_table(spark, table, schemas.CLEAN_EVENT).withColumn("traffic_source", F.lit("direct"))
    assert plan(sessions.session_metrics(df)).count("Exchange ") == 1


def test_funnel_steps_are_filtered_at_the_scan(spark, table):
    text = plan(funnels.funnels(tables.read_table(spark, table, schemas.CLEAN_EVENT)))
    assert re.search(r"PartitionFilters: \[[^\]]*event_type[#\d]* IN", text)


def test_silver_reads_bronze_once_where_days_are_small(spark, table, tmp_path, monkeypatch):
    """What the silver job stages scans bronze once; numbers of events are those of cut groups."""
    seen, real = [], tables.staged

    def noted(df, name):
        seen.append((plan(df), df))
        return real(df, name)

    monkeypatch.setattr(silver.tables, "staged", noted)
    first, last = "2024-01-01", "2024-01-30"
    silver.run(spark, silver.Layout(str(tmp_path), bronze=table), start=first, end=last, as_of=clicks.AS_OF)
    (text, df), = seen
    assert text.split("== Initial Plan ==")[-1].count("FileScan") == 1
    cut = silver.scored_events(tables.read_dates(spark, table, schemas.CLEAN_EVENT, first, last), clicks.AS_OF, 300)
    named = [d.select("event_id", "event_date", "event_number_in_session") for d in (df, cut)]
    assert named[0].exceptAll(named[1]).count() == named[1].exceptAll(named[0]).count() == 0 < named[0].count()
