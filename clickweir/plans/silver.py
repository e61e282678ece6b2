"""Bronze to silver, quarantine and alerts for a date or a range of dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.functions.timing import DAY_SECONDS, instant
from clickweir.operators.alerts import alert_messages, alert_rows
from clickweir.operators.anomalies import flag_anomalies, no_anomalies
from clickweir.operators.events import deduplicate, enrich, score_quality, split_quality, stamp
from clickweir.operators.ordering import slice_width
from clickweir.plans.config import Layout
from clickweir.schemas import CLEAN_EVENT, QUARANTINE, SCORED_EVENT, SILVER_EVENT, conform
from clickweir.settings import SLICE_SECONDS
from clickweir.sources import tables
from clickweir.sources.session import sized_shuffles, use_utc

STATS = ["bronze_read", "after_dedup", "passed_quality", "quarantined", "anomalies", "alerts_sent", "silver_written"]


def create_tables(spark: SparkSession, layout: Layout) -> None:
    tables.create_if_missing(spark, layout.silver, SILVER_EVENT, ["event_date"], layout.fmt)
    tables.create_if_missing(spark, layout.quarantine, QUARANTINE, ["event_date"], layout.fmt)


def read_silver(spark: SparkSession, layout: Layout, start: str, end: str) -> DataFrame:
    return tables.read_dates(spark, layout.silver, SILVER_EVENT, start, end, fmt=layout.fmt)


def scored_events(bronze: DataFrame, as_of=None, slice_seconds: float | None = SLICE_SECONDS) -> DataFrame:
    """Deduplicated, enriched and scored events. Each day is on its own, so a range gives the same
    rows as its days one by one."""
    enriched = enrich(deduplicate(bronze, per_day=True), True, slice_seconds)
    return conform(score_quality(enriched, as_of), SCORED_EVENT)


def deliver(alerts: DataFrame, layout: Layout, path: str, start: str, end: str) -> int:
    """Write alerts as messages to the sink, from the executors; returns how many. A file sink holds one
    partition per date, so sending a date again replaces its messages."""
    if layout.alert_fmt == "kafka":
        alert_messages(alerts).write.format("kafka").options(**layout.alert_options).save()
    else:
        dated = alert_messages(alerts, event_date=F.substring("timestamp", 1, 10))
        # The rows come from a table that has its files by date, so they need not be grouped again.
        tables.replace_dates(dated, path, start, end, fmt=layout.alert_fmt, grouped=True, options=layout.alert_options)
    return alerts.count()


def send_alerts(silver: DataFrame, layout: Layout, start: str, end: str, as_of=None) -> int:
    """One message per anomaly."""
    return deliver(alert_rows(silver, as_of), layout, layout.alerts, start, end)


def run(
    spark: SparkSession,
    layout: Layout,
    event_date: str | None = None,
    start: str | None = None,
    end: str | None = None,
    skip_anomalies: bool = False,
    as_of=None,
) -> dict[str, int]:
    """Rebuild silver for the newest bronze date, one date, or a range in a single pass.

    The scored events are written once to the shared folder; the statistics, both tables and the
    counts read that, instead of repeating the dedup and the ordering for each of them.
    """
    use_utc(spark)
    create_tables(spark, layout)
    none = dict.fromkeys(STATS, 0)
    dates = tables.resolve_dates(spark, layout.bronze, event_date, start, end, layout.fmt)
    if dates is None:
        return none
    bronze = tables.read_dates(spark, layout.bronze, CLEAN_EVENT, *dates, fmt=layout.fmt)
    days = bronze.groupBy("event_date").count().agg(F.sum("count").alias("all"), F.max("count").alias("most")).first()
    bronze_read, fullest = days["all"] or 0, days["most"] or 0  # dates without rows are rebuilt too: what an earlier run left there goes
    if as_of is None:
        # One moment for the whole run; tasks that run again must see the same clock.
        as_of = spark.range(1).select(instant(None).alias("now")).first()["now"]

    stored = tables.stored_bytes(spark, *tables.date_folders(spark, layout.bronze, *dates))
    with sized_shuffles(spark, stored):
        return {"bronze_read": bronze_read, **_rebuild(spark, layout, bronze, fullest, dates, skip_anomalies, as_of)}


def _rebuild(spark, layout, bronze, fullest, dates, skip_anomalies, as_of) -> dict[str, int]:
    # Days are numbered apart, so a slice may be a whole day; the fullest one says how wide they can be. Groups that fit
    # into one slice are not cut at all: the dedup would be done a second time to count the rows of slices.
    width = slice_width(fullest, DAY_SECONDS, widest=DAY_SECONDS)
    scored, scratch = tables.staged(scored_events(bronze, as_of, None if width >= DAY_SECONDS else width), "scored")
    try:
        passed, quarantined = split_quality(scored)
        judged = no_anomalies(passed) if skip_anomalies else flag_anomalies(passed, per_day=True)
        tables.replace_dates(conform(stamp(judged, as_of), SILVER_EVENT), layout.silver, *dates, fmt=layout.fmt)
        tables.replace_dates(conform(stamp(quarantined, as_of), QUARANTINE), layout.quarantine, *dates, fmt=layout.fmt)
        silver = read_silver(spark, layout, *dates)
        after_dedup, written = scored.count(), silver.count()
        if skip_anomalies and not tables.exists(spark, layout.alerts):
            alerts = 0
        else:  # without anomalies this takes back what an earlier run has sent to files
            alerts = send_alerts(silver, layout, *dates, as_of=as_of)
        return {
            "after_dedup": after_dedup,
            "passed_quality": written,
            "quarantined": after_dedup - written,
            "anomalies": alerts,
            "alerts_sent": alerts,
            "silver_written": written,
        }
    finally:
        tables.remove(spark, scratch)
