import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clickweir import schemas
from clickweir.operators import anomalies, funnels, kpis, ordering, summaries
from clickweir.plans import bronze, gold, silver
from clickweir.plans import live as live_plan
from clickweir.plans.config import Layout
from clickweir.sources import clicks, raw, tables
from clickweir.streaming import live
from support import TESTDATA, at

HOUR = "1 hour"


def drain(stream, path):
    query = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", f"{path}/offsets").start(f"{path}/out"))
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


@pytest.fixture(scope="module")
def three_files(spark, tmp_path_factory):
    """The given events in three time-ordered files, and a last one far in the future that closes
    all windows. Read one file per trigger."""
    folder = str(tmp_path_factory.mktemp("stream"))
    events = clicks.events(spark, TESTDATA).drop("session_id")
    sessioned = ordering.visits(events, gap_seconds=clicks.GAP_SECONDS)
    cuts = [at("2024-01-01"), at("2024-01-11"), at("2024-01-21"), at("2024-02-01")]
    for start, end in zip(cuts, cuts[1:]):
        sessioned.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end)).coalesce(1).write.mode(
            "append").parquet(folder)
    sentinel = sessioned.limit(1).withColumns({
        "timestamp": F.lit(at("2024-06-01")), "event_id": F.lit("last"), "user_id": F.lit("last"),
        "event_type": F.lit("logout")})
    sentinel.write.mode("append").parquet(folder)

    def stream():
        return spark.readStream.schema(sessioned.schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return sessioned, stream


def closed(df):
    return df.filter("event_id <> 'last'" if "event_id" in df.columns else "window_start < '2024-06-01'")


def test_live_flags_equal_batch(spark, three_files, tmp_path):
    """Each event waits for its window; the day of the last event of a file goes on in the next one."""
    batch, stream = three_files
    got = closed(drain(live.live_flags(stream(), 86400), tmp_path))
    want = anomalies.flag_windows(batch, 86400)
    assert same(got.select(want.columns), want) and got.filter("is_anomaly").count() > 20


def test_flags_and_their_summary_in_one_query(spark, three_files, tmp_path):
    batch, stream = three_files
    flagged = live.live_flags(stream(), 86400)
    got = drain(live.live_anomaly_summary(flagged, delay=None, as_of=clicks.AS_OF), tmp_path)
    want = summaries.anomaly_summary(anomalies.flag_windows(batch, 86400), as_of=clicks.AS_OF)
    assert same(got, want) and want.count() > 20


@pytest.mark.parametrize("slide", [None, 900])
def test_live_bounce_rate_equals_batch(spark, three_files, tmp_path, slide):
    batch, stream = three_files
    rows = live.live_kpis(stream(), slide_seconds=slide, as_of=clicks.AS_OF, gap_seconds=clicks.GAP_SECONDS)
    want = kpis.windowed_kpis(batch, slide_seconds=slide, as_of=clicks.AS_OF)
    assert same(closed(drain(rows, tmp_path)).select(want.columns), want)
    assert want.filter("bounce_rate > 0").count() > 100


@pytest.mark.parametrize("gap", [False, True])
def test_live_funnels_equal_batch(spark, three_files, tmp_path, gap):
    """Exact users; with the gap some windows lack a step between two others."""
    batch, stream = three_files

    def rows(df):
        late = F.lit(gap) & (F.col("event_type") == "click") & (F.col("event_date") >= "2024-01-10")
        return df.withColumn("event_type", F.when(late, "error").otherwise(F.col("event_type")))

    got = closed(drain(live.live_funnels(rows(stream()), as_of=clicks.AS_OF), tmp_path))
    want = funnels.funnels(rows(batch), exact=True, as_of=clicks.AS_OF)
    assert same(got.select(want.columns), want)
    assert (want.filter("funnel_step = 'page_view' AND conversion_to_next IS NULL").count() > 0) == gap


def test_funnel_counts_events_without_a_user(spark, tmp_path):
    start = at("2024-01-01")
    rows = [("a", None, "page_view", start), ("b", "u", "page_view", start), ("c", "u", "page_view", start),
            ("d", None, "click", start), ("z", None, "logout", at("2024-02-01"))]
    schema = "event_id string, user_id string, event_type string, timestamp timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    got = drain(live.live_funnels(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")), tmp_path)
    names = ["funnel_step", "unique_users", "event_count", "conversion_to_next"]
    assert sorted(map(tuple, got.select(names).collect())) == [("click", 0, 1, None), ("page_view", 1, 3, 0.0)]


def test_spans():
    assert live_plan.spans([]) == []
    assert live_plan.spans(["2024-03-01", "2024-02-28", "2024-02-29", "2024-01-01", "2024-03-01"]) == [
        ("2024-01-01", "2024-01-01"), ("2024-02-28", "2024-03-01")]


def test_live_silver_with_late_rows_and_replay(spark, tmp_path):
    """Three bronze batches, the last with late rows: silver, quarantine and gold end as the batch jobs leave
    them, other dates are not written again, and a replayed epoch changes nothing."""
    layout, whole = Layout(str(tmp_path / "live")), Layout(str(tmp_path / "whole"))
    rows = clicks.blemished(clicks.visited(spark, TESTDATA)).filter("event_date < '2024-01-09'")
    late = F.pmod(F.xxhash64("event_id"), F.lit(7)) == 0
    early, last = F.col("event_date") < "2024-01-04", F.col("event_date").isin("2024-01-02", "2024-01-08")
    parts = [~(late & last) & early, ~(late & last) & ~early, late & last]

    def files(name):
        found = (tmp_path / "live" / name).rglob("*.parquet")
        return {f"{f.parent.name}/{f.name}" for f in found if f.parent.name.startswith("event_date")}

    def run():
        live_plan.start_silver(spark, layout, trigger={"availableNow": True}, as_of=clicks.AS_OF, with_gold=True).awaitTermination()

    for n, part in enumerate(parts):
        for table in (layout, whole):
            tables.append_batch(schemas.conform(rows.filter(part), schemas.CLEAN_EVENT), table.bronze, bronze.BRONZE_PARTITIONS, str(n))
        before = files("silver/events_clean")
        run()
        touched = {f.split("/")[0] for f in files("silver/events_clean") ^ before}
        if n == 2:
            assert touched == {"event_date=2024-01-02", "event_date=2024-01-08"}
    dates = {"start": "2024-01-01", "end": "2024-01-08", "as_of": clicks.AS_OF}
    silver.run(spark, whole, **dates)
    gold.run_all(spark, whole, **dates)

    def check():
        for name, schema in (("silver", schemas.SILVER_EVENT), ("quarantine", schemas.QUARANTINE), ("kpis", schemas.KPI),
                             ("sessions", schemas.SESSION), ("funnels", schemas.FUNNEL), ("anomalies", schemas.ANOMALY_SUMMARY)):
            got, want = (tables.read_table(spark, getattr(table, name), schema) for table in (layout, whole))
            assert same(got, want), name

    check()
    commits = sorted((tmp_path / "live" / "checkpoints" / "silver_live" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for entry in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        entry.unlink(missing_ok=True)
    run()
    check()


def test_an_epoch_keeps_its_clock(spark, tmp_path):
    layout = Layout(str(tmp_path))
    first = live_plan.moment_of(spark, layout, "q", 3)
    assert live_plan.moment_of(spark, layout, "q", 3) == first != live_plan.moment_of(spark, layout, "q", 4)
    assert live_plan.moment_of(spark, layout, "q", 3, clicks.AS_OF) == clicks.AS_OF


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_live_kpis_equal_batch(spark, three_files, tmp_path):
    batch, stream = three_files
    got = drain(live.live_kpis(stream(), as_of=clicks.AS_OF), tmp_path).filter("event_date < '2024-06-01'")
    want = kpis.windowed_kpis(batch, as_of=clicks.AS_OF)
    names = [c for c in want.columns if c != "bounce_rate"]
    assert same(got.select(names), want.select(names))


def test_live_summary_equals_batch(spark, three_files, tmp_path):
    batch, stream = three_files

    def mark(df):
        slow = F.col("response_time_ms") > 15000
        return df.withColumns({"is_anomaly": slow, "anomaly_type": F.when(slow, "slow_response"),
                               "anomaly_score": F.when(slow, F.lit(1.5))})

    got = drain(live.live_anomaly_summary(mark(stream()), as_of=clicks.AS_OF), tmp_path)
    assert same(got, summaries.anomaly_summary(mark(batch), as_of=clicks.AS_OF))


def test_live_visits_equal_batch(spark, three_files, tmp_path):
    batch, stream = three_files
    got = drain(live.live_visits(stream(), clicks.GAP_SECONDS), tmp_path).filter("user_id <> 'last'")
    want = batch.groupBy("session_id", "user_id").agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"))
    names = ["user_id", "session_start", "session_end", "event_count"]
    assert same(got.select(names), want.select(names))


def test_events_a_full_gap_apart_are_two_visits(spark, tmp_path):
    start = at("2024-01-01")
    times = [start, start + timedelta(seconds=1799), start + timedelta(seconds=1799 + 1800), at("2024-02-01")]
    rows = [(str(i), "u", "click", "/", t) for i, t in enumerate(times)]
    schema = "event_id string, user_id string, event_type string, page_url string, timestamp timestamp"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    got = drain(live.live_visits(stream), tmp_path).orderBy("session_start").collect()
    assert [r.event_count for r in got] == [2, 1]


def test_dedup_across_batches(spark, three_files, tmp_path):
    batch, stream = three_files
    twice = stream().unionByName(stream())
    got = drain(live.deduplicated(twice).select("event_id"), tmp_path)
    assert got.count() == batch.count() + 1


def test_scoring_needs_no_state(spark, three_files):
    _, stream = three_files
    scored = live.scored(stream(), clicks.AS_OF)
    assert scored.isStreaming and "quality_score" in scored.columns


def lines(folder, name, ids):
    folder.mkdir(exist_ok=True)
    body = [json.dumps({"event_id": i, "event_type": "click", "timestamp": "2024-01-15T10:00:00Z"}) for i in ids]
    (folder / name).write_text("\n".join([*body, "{broken"]) + "\n")


def test_bronze_stream_and_restart(spark, tmp_path):
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "in"

    def run():
        source = raw.stream_lines(spark, str(folder), files_per_trigger=1)
        query = bronze.start_stream(source, layout, trigger={"availableNow": True}, as_of=clicks.AS_OF)
        query.awaitTermination()
        return query

    lines(folder, "a.jsonl", ["e1", "e2"])
    lines(folder, "b.jsonl", ["e3"])
    assert run().name == "bronze_streaming"
    table = tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT)
    assert sorted(r.event_id for r in table.collect()) == ["e1", "e2", "e3"]
    lines(folder, "c.jsonl", ["e4"])
    run()
    run()
    table = tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT)
    assert sorted(r.event_id for r in table.collect()) == ["e1", "e2", "e3", "e4"]
    assert tables.read_table(spark, layout.dead_letter, schemas.DEAD_LETTER).count() == 3


def test_replayed_batch_writes_nothing_twice(spark, tmp_path):
    """A batch whose commit was lost is run again under the same epoch."""
    layout, folder = Layout(str(tmp_path / "t")), tmp_path / "in"
    lines(folder, "a.jsonl", ["e1", "e2"])

    def run():
        source = raw.stream_lines(spark, str(folder))
        bronze.start_stream(source, layout, trigger={"availableNow": True}).awaitTermination()

    run()
    commits = tmp_path / "t" / "checkpoints" / "bronze_streaming" / "commits"
    for entry in commits.iterdir():
        entry.unlink()
    run()
    assert tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT).count() == 2
    assert tables.read_table(spark, layout.dead_letter, schemas.DEAD_LETTER).count() == 1


def test_a_bronze_batch_is_not_parsed_by_one_task_first(spark, tmp_path, monkeypatch):
    """A question for one row of a micro-batch would have its whole first file parsed by one task, and all others wait."""
    lines = [json.dumps({"event_id": f"e{i}", "event_type": "click", "timestamp": "2026-05-29T10:00:00+00:00"}) for i in range(4)]
    for line in lines:
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / "lines"))
    asked = []
    for kind in {type(spark.range(1)), *type(spark.range(1)).__mro__[:-1]}:
        if "isEmpty" in vars(kind):
            monkeypatch.setattr(kind, "isEmpty", lambda self, f=vars(kind)["isEmpty"]: asked.append(1) or f(self))
    layout = Layout(str(tmp_path / "t"))
    bronze.start_stream(raw.stream_lines(spark, str(tmp_path / "lines")), layout, trigger={"availableNow": True}).awaitTermination()
    assert tables.read_table(spark, layout.bronze, schemas.CLEAN_EVENT).count() == 4 and not asked
