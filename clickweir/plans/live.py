"""Silver (and gold) that follow bronze as a stream, with the exact results of the batch jobs.

Dedup, event numbers and the statistics of a day need all of its rows, so no state of a stream could hold
them for ever. A micro-batch instead says which dates have new bronze rows, late ones among them, and the
batch jobs rebuild just these. What a date ends as depends only on its bronze rows: a batch that is
replayed, or one that brings the same rows again, changes nothing.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from clickweir.functions.timing import instant
from clickweir.plans import bronze, gold, silver
from clickweir.plans.config import Layout
from clickweir.schemas import CLEAN_EVENT
from clickweir.sources import tables
from clickweir.sources.session import use_utc


def spans(days: list[str]) -> list[tuple[str, str]]:
    """Dates as ranges without gaps, so that neighbours are rebuilt in one pass."""
    out: list[tuple[str, str]] = []
    for day in sorted(set(days)):
        follows = out and date.fromisoformat(out[-1][1]) + timedelta(days=1) == date.fromisoformat(day)
        out[-1:] = [(out[-1][0], day)] if follows else [*out[-1:], (day, day)]
    return out


def bronze_stream(spark: SparkSession, layout: Layout, files_per_trigger: int = 1000) -> DataFrame:
    """The dates of the rows that arrive in bronze. Only partition values are read, so a file that a replayed
    bronze batch has replaced in the meantime may be missing; its successor comes as a new one."""
    if layout.fmt != "parquet":
        rows = spark.readStream.format(layout.fmt).option("ignoreChanges", "true").load(layout.bronze)
        return rows.select("event_date")
    schema = StructType([*CLEAN_EVENT.fields, StructField("ingest_id", StringType())])
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
        .option("ignoreMissingFiles", "true").parquet(layout.bronze)
    )
    return rows.select("event_date")


def moment_of(spark: SparkSession, layout: Layout, name: str, epoch: int, as_of=None):
    """What an epoch counts as now: kept beside the checkpoint, so that a replay has the same clock."""
    if as_of is not None:
        return as_of
    path = f"{layout.checkpoints}/{name}-moments/{epoch}"
    if not tables.exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).coalesce(1).select(instant(None).alias("now")).write.mode("overwrite").parquet(path)
    return spark.read.schema("now timestamp").parquet(path).first()["now"]


def start_silver(
    spark: SparkSession,
    layout: Layout,
    name: str = "silver_live",
    trigger: dict | None = None,
    as_of=None,
    with_gold: bool = False,
    skip_anomalies: bool = False,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start a query that keeps silver and quarantine (``with_gold``: and gold) in step with bronze."""
    use_utc(spark)
    bronze.create_tables(spark, layout)

    def rebuild(batch: DataFrame, epoch: int) -> None:
        days = [r["event_date"] for r in batch.where("event_date IS NOT NULL").distinct().collect()]
        now = moment_of(spark, layout, name, epoch, as_of) if days else None
        for start, end in spans(days):
            silver.run(spark, layout, start=start, end=end, as_of=now, skip_anomalies=skip_anomalies)
            if with_gold:
                gold.run_all(spark, layout, start=start, end=end, as_of=now)

    return (
        bronze_stream(spark, layout, files_per_trigger)
        .writeStream.foreachBatch(rebuild)
        .queryName(name)
        .option("checkpointLocation", f"{layout.checkpoints}/{name}")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
