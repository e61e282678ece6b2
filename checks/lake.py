"""The three-stage tables, built by the jobs from the given events, once per session and folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.plans import bronze, gold, silver
from clickweir.plans.config import Layout
from clickweir.sources import clicks, tables
from clickweir.sources.session import scratch_path

_BUILT: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, stage: str, build):
    key = (spark.sparkContext.applicationId, folder, stage)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def visited(spark: SparkSession, folder: str) -> DataFrame:
    """The clean events with their sessions, as a table: what the later stages read is stored, not
    derived again by each query."""
    table, _ = _once(spark, folder, "visited", lambda: tables.staged(clicks.visited(spark, folder), "visited"))
    return table


def visited_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same table as a stream, and one event of nobody in the year 2100, which closes all windows."""
    table, path = _once(spark, folder, "visited", lambda: tables.staged(clicks.visited(spark, folder), "visited"))

    def closing() -> str:
        last = scratch_path(spark, "closing")
        late = {"timestamp": "TIMESTAMP '2100-01-01 00:00:00'", "event_id": "'-1'", "event_type": "'none'"}
        fields = [f"CAST({late.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in table.schema]
        spark.range(1).selectExpr(*fields).write.parquet(last)
        return last

    streams = [spark.readStream.schema(table.schema).parquet(p) for p in (path, closing())]
    return streams[0].unionByName(streams[1])


def lines_folder(spark: SparkSession, folder: str) -> str:
    """The events as JSON line files, compressed as such files are kept; none of them grows with the table."""
    rows = clicks.repeated(clicks.blemished(visited(spark, folder)))
    path = scratch_path(spark, "lines")
    clicks.raw_lines(rows).write.option("maxRecordsPerFile", 1_000_000).text(path, compression="gzip")
    return path


def job_layout(spark: SparkSession, name: str, **paths: str) -> Layout:
    """Tables of a job in a new folder, with compressed alert files."""
    return Layout(scratch_path(spark, name), alert_options={"compression": "gzip"}, **paths)


def bronze_lake(spark: SparkSession, folder: str) -> Layout:
    def build():
        layout = job_layout(spark, "lake")
        bronze.run_batch(spark, layout, lines_folder(spark, folder), as_of=clicks.AS_OF)
        return layout

    return _once(spark, folder, "bronze", build)


def date_range(spark: SparkSession, folder: str) -> tuple[str, str]:
    """The first and the last date that bronze has."""
    days = visited(spark, folder).agg(F.min("event_date").alias("a"), F.max("event_date").alias("b")).first()
    return days["a"], days["b"]


def dates(spark: SparkSession, folder: str) -> dict[str, str]:
    return dict(zip(("start", "end"), date_range(spark, folder)))


def silver_lake(spark: SparkSession, folder: str) -> Layout:
    def build():
        layout = bronze_lake(spark, folder)
        silver.run(spark, layout, **dates(spark, folder), as_of=clicks.AS_OF)
        return layout

    return _once(spark, folder, "silver", build)


GOLD = {
    "kpis": lambda *at, **given: gold.run_kpis(*at, exact=True, **given),
    "sessions": gold.run_sessions,
    "funnels": lambda *at, **given: gold.run_funnels(*at, exact=True, **given),
    "anomalies": gold.run_anomaly_aggs,
}


def gold_lake(spark: SparkSession, folder: str, *names: str) -> Layout:
    """With those gold tables that are named, each made once."""
    layout = silver_lake(spark, folder)
    for name in names:
        _once(spark, folder, f"gold-{name}", lambda: GOLD[name](spark, layout, **dates(spark, folder), as_of=clicks.AS_OF))
    return layout


def drain(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over all there is, into a table, and read it back."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", f"{path}-offsets").start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def stats_row(spark: SparkSession, stats: dict) -> DataFrame:
    """Job counters as one row."""
    numbers = {name: value for name, value in stats.items() if isinstance(value, int)}
    return spark.createDataFrame([tuple(numbers.values())], ", ".join(f"{name} bigint" for name in numbers))
