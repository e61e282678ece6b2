"""Silver to the gold tables for a date or a range of dates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickweir.functions.timing import DAY_SECONDS, window_label, window_seconds
from clickweir.operators.funnels import funnels
from clickweir.operators.kpis import windowed_kpis
from clickweir.operators.panes import PANE_SECONDS, panes, rolled_up
from clickweir.operators.sessions import session_metrics
from clickweir.operators.summaries import anomaly_summary
from clickweir.operators.trends import span_of, trend_alerts, trends
from clickweir.plans.config import Layout
from clickweir.plans.silver import deliver, read_silver
from clickweir.schemas import ANOMALY_SUMMARY, FUNNEL, KPI, KPI_PANE, SESSION, TREND, conform
from clickweir.sources import tables
from clickweir.settings import TRAFFIC_HISTORY_WINDOWS
from clickweir.sources.session import sized_shuffles, use_utc

MODES = ["kpis", "sessions", "funnels", "anomaly_aggs"]


def create_tables(spark: SparkSession, layout: Layout) -> None:
    windowed = ["window_duration", "event_date"]
    tables.create_if_missing(spark, layout.kpis, KPI, windowed, layout.fmt)
    tables.create_if_missing(spark, layout.panes, KPI_PANE, windowed, layout.fmt)
    tables.create_if_missing(spark, layout.sessions, SESSION, ["event_date"], layout.fmt)
    tables.create_if_missing(spark, layout.funnels, FUNNEL, windowed, layout.fmt)
    tables.create_if_missing(spark, layout.anomalies, ANOMALY_SUMMARY, windowed, layout.fmt)
    tables.create_if_missing(spark, layout.trends, TREND, windowed, layout.fmt)


def _width(window: str) -> int:
    """Widths must divide a day: gold is replaced by date, so no window may span two."""
    seconds = window_seconds(window)
    if seconds <= 0 or DAY_SECONDS % seconds:
        raise ValueError(f"window {window} does not divide a day")
    return seconds


def _refresh(
    spark: SparkSession,
    layout: Layout,
    path: str,
    schema: StructType,
    compute: Callable[[DataFrame], DataFrame],
    names: tuple[str, ...],
    event_date: str | None,
    start: str | None,
    end: str | None,
    window: str | None = None,
    read: int | None = None,
) -> dict[str, int]:
    """Compute one gold table for the dates and replace them in it, also where silver has no rows (any
    more). ``read``: the number of silver rows, if the caller has counted them."""
    use_utc(spark)
    create_tables(spark, layout)
    dates = tables.resolve_dates(spark, layout.silver, event_date, start, end, layout.fmt)
    if not dates:
        return {"silver_read": 0, **dict.fromkeys(names, 0)}
    silver = read_silver(spark, layout, *dates)
    if read is None:
        read = silver.count()
    stored = tables.stored_bytes(spark, *tables.date_folders(spark, layout.silver, *dates))
    with sized_shuffles(spark, stored):
        tables.replace_dates(compute(silver), path, *dates, window=window, fmt=layout.fmt)
    written = tables.read_dates(spark, path, schema, *dates, window=window, fmt=layout.fmt).count()
    return {"silver_read": read, **dict.fromkeys(names, written)}


def run_kpis(spark, layout, event_date=None, window="1h", start=None, end=None, as_of=None, exact=False, read=None) -> dict:
    seconds = _width(window)
    return _refresh(
        spark, layout, layout.kpis, KPI,
        lambda df: windowed_kpis(df, seconds, exact=exact, per_day=True, as_of=as_of),
        ("windows", "kpis_written"), event_date, start, end, window_label(seconds), read,
    )


def run_panes(spark, layout, event_date=None, pane_seconds=PANE_SECONDS, start=None, end=None, read=None) -> dict:
    """The panes of the dates, from which ``run_rolled_up`` makes KPIs of any width."""
    label = window_label(_width(f"{pane_seconds}s"))

    def compute(df: DataFrame) -> DataFrame:
        dated = panes(df, pane_seconds, per_day=True).withColumns(
            {"window_duration": F.lit(label), "event_date": F.to_date("window_start").cast("string")})
        return conform(dated, KPI_PANE)

    return _refresh(spark, layout, layout.panes, KPI_PANE, compute, ("panes_written",), event_date, start, end, label, read)


def run_rolled_up(
    spark, layout, event_date=None, window="1h", start=None, end=None, as_of=None, pane_seconds=PANE_SECONDS
) -> dict[str, int]:
    """The KPIs of ``run_kpis`` from the stored panes of the dates; silver is not read."""
    use_utc(spark)
    create_tables(spark, layout)
    seconds, label = _width(window), window_label(pane_seconds)
    stored = f"{layout.panes}/window_duration={label}" if layout.fmt == "parquet" else layout.panes
    dates = tables.resolve_dates(spark, stored, event_date, start, end, layout.fmt)
    if not dates:
        return {"panes_read": 0, "kpis_written": 0}
    rows = tables.read_dates(spark, layout.panes, KPI_PANE, *dates, window=label, fmt=layout.fmt)
    name = window_label(seconds)
    tables.replace_dates(rolled_up(rows, seconds, None, pane_seconds, as_of), layout.kpis, *dates, window=name, fmt=layout.fmt)
    written = tables.read_dates(spark, layout.kpis, KPI, *dates, window=name, fmt=layout.fmt)
    return {"panes_read": rows.count(), "kpis_written": written.count()}


def run_sessions(spark, layout, event_date=None, start=None, end=None, as_of=None, read=None) -> dict:
    return _refresh(
        spark, layout, layout.sessions, SESSION,
        lambda df: session_metrics(df, per_day=True, as_of=as_of),
        ("sessions", "sessions_written"), event_date, start, end, None, read,
    )


def run_funnels(spark, layout, event_date=None, window="24h", start=None, end=None, as_of=None, exact=False, read=None) -> dict:
    seconds = _width(window)
    return _refresh(
        spark, layout, layout.funnels, FUNNEL,
        lambda df: funnels(df, seconds, exact=exact, as_of=as_of),
        ("funnel_rows", "funnels_written"), event_date, start, end, window_label(seconds), read,
    )


def run_anomaly_aggs(spark, layout, event_date=None, window="1h", start=None, end=None, as_of=None, read=None) -> dict:
    seconds = _width(window)
    return _refresh(
        spark, layout, layout.anomalies, ANOMALY_SUMMARY,
        lambda df: anomaly_summary(df, seconds, as_of=as_of),
        ("anomaly_rows", "anomalies_written"), event_date, start, end, window_label(seconds), read,
    )


def run_trends(
    spark, layout, event_date=None, window="5m", start=None, end=None, as_of=None, history=TRAFFIC_HISTORY_WINDOWS
) -> dict[str, int]:
    """Traffic, purchase and response trends of the dates, and an alert for each that is beyond its limit.

    The first windows of a date are judged by the last ones of the day before, so these are read too, and no more of
    it. Where all events begin and end is asked of the first and the last date of silver. So a range gives
    what its days give one by one."""
    use_utc(spark)
    create_tables(spark, layout)
    seconds = _width(window)
    dates = tables.resolve_dates(spark, layout.silver, event_date, start, end, layout.fmt)
    if not dates:
        return {"silver_read": 0, "trends_written": 0, "trend_alerts_sent": 0}
    halo = history * seconds
    earliest = (date.fromisoformat(dates[0]) - timedelta(days=-(-halo // DAY_SECONDS))).isoformat()
    opening = F.timestamp_seconds(F.unix_seconds(F.lit(dates[0]).cast("timestamp")) - halo)
    rows = read_silver(spark, layout, earliest, dates[1]).filter(F.col("timestamp") >= opening)
    ends = tables.date_bounds(spark, layout.silver, layout.fmt) or dates
    span = span_of(read_silver(spark, layout, ends[0], ends[0]).unionByName(read_silver(spark, layout, ends[1], ends[1])))
    label = window_label(seconds)
    stored = tables.stored_bytes(spark, *tables.date_folders(spark, layout.silver, *dates))
    with sized_shuffles(spark, stored):
        found = trends(rows, span, seconds, history=history, as_of=as_of)
        tables.replace_dates(
            tables.between_dates(found, *dates), layout.trends, *dates, window=label, fmt=layout.fmt)
    written = tables.read_dates(spark, layout.trends, TREND, *dates, window=label, fmt=layout.fmt)
    return {
        "silver_read": read_silver(spark, layout, *dates).count(),
        "trends_written": written.count(),
        "trend_alerts_sent": deliver(trend_alerts(written, as_of), layout, layout.trend_alerts, *dates),
    }


def run_all(
    spark, layout, event_date=None, kpi_window="1h", funnel_window="24h", start=None, end=None, as_of=None
) -> dict:
    """All four tables; the stats of each, and which modes ran. Silver is counted once."""
    dates = {"event_date": event_date, "start": start, "end": end, "as_of": as_of}
    first = run_kpis(spark, layout, window=kpi_window, **dates)
    dates["read"] = first["silver_read"]
    stats = {
        **first,
        **run_sessions(spark, layout, **dates),
        **run_funnels(spark, layout, window=funnel_window, **dates),
        **run_anomaly_aggs(spark, layout, window=kpi_window, **dates),
    }
    return {**stats, "modes_run": list(MODES)}
