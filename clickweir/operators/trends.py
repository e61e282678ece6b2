"""Trends of short windows in one table: traffic against the hour before, purchases against the window
before, slow responses; and the alerts they raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import instant, iso_text, tumbling, window_label
from clickweir.operators.quantiles import discrete_quantile
from clickweir.schemas import ALERT, TREND, conform


def span_of(df: DataFrame) -> DataFrame:
    """One row: the first and the last event."""
    return df.agg(F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event"))


def _marks(df: DataFrame, window_seconds: int) -> DataFrame:
    return df.groupBy(tumbling("timestamp", window_seconds).getField("start").alias("window_start")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        discrete_quantile("response_time_ms", 0.99).alias("p99"),
    )


def _entry(kind: str, value, baseline, limit, triggered, score):
    """One trend of a window. Against a limit of zero there is no ratio, so what is above it scores 2."""
    score = F.when(limit > 0, F.least(score, F.lit(2.0))).when(triggered, 2.0)
    return F.struct(
        F.lit(kind).alias("trend_type"), value.cast("double").alias("metric_value"),
        baseline.cast("double").alias("baseline"), limit.cast("double").alias("metric_threshold"),
        score.alias("trend_score"), F.coalesce(triggered, F.lit(False)).alias("is_triggered"),
    )


def trends(
    df: DataFrame,
    span: DataFrame | None = None,
    window_seconds: int = settings.TREND_WINDOW_SECONDS,
    factor: float = settings.TRAFFIC_SPIKE_FACTOR,
    history: int = settings.TRAFFIC_HISTORY_WINDOWS,
    fraction: float = settings.PURCHASE_DROP_FRACTION,
    threshold_ms: int = settings.P99_RESPONSE_MS,
    as_of=None,
) -> DataFrame:
    """The rows of ``traffic_spikes``, ``purchase_drops`` and ``slow_windows`` as one table.

    Events are read and shuffled once, as one row of counts per window. Each window hands its row to
    itself and to the next ``history`` windows, so silent windows need not be built and nothing is joined. ``span`` (one
    row, as of ``span_of``) says where the events begin and end when ``df`` is only a part of them: before
    the first event there is no history, and after the last one no silence.
    """
    step, ago = F.col("_step"), F.col("_step") > 0
    at = F.col("_at")
    handed = _marks(df, window_seconds).select("*", F.explode(F.sequence(F.lit(0), F.lit(history))).alias("_step"))
    windows = handed.groupBy((F.unix_seconds("window_start") + step * window_seconds).alias("_at")).agg(
        F.sum(F.when(step == 0, F.col("events"))).alias("events"),
        F.coalesce(F.sum(F.when(step == 0, F.col("purchases"))), F.lit(0)).alias("purchases"),
        F.max(F.when(step == 0, F.col("p99"))).alias("p99"),
        F.coalesce(F.sum(F.when(step == 1, F.col("purchases"))), F.lit(0)).alias("previous"),
        F.coalesce(F.sum(F.when(ago, F.col("events"))), F.lit(0)).alias("past"),
    )
    bounds = F.broadcast(span_of(df) if span is None else span)  # one row
    first, last = F.unix_seconds("first_event"), F.unix_seconds("last_event")
    opening = first - F.pmod(first, F.lit(window_seconds))
    before = F.least(((at - opening) / F.lit(window_seconds)).cast("bigint"), F.lit(history))
    average = F.when(before > 0, F.col("past") / before)
    busy, kept = average * F.lit(factor), F.col("previous") * F.lit(1 - fraction)
    drop = F.when(F.col("previous") > 0, 1 - F.col("purchases") / F.col("previous"))
    limit = F.lit(float(threshold_ms))
    buying = ((F.col("purchases") > 0) | (F.col("previous") > 0)) & (at <= last)
    entries = F.array(
        F.when(F.col("events").isNotNull(), _entry(
            "traffic_spike", F.col("events"), average, busy, F.col("events") > busy,
            F.try_divide(F.col("events").cast("double"), busy))),
        F.when(buying, _entry(
            "purchase_drop", F.col("purchases"), F.col("previous"), kept, drop > fraction, drop / F.lit(fraction))),
        F.when(F.col("p99").isNotNull(), _entry(
            "slow_window", F.col("p99"), F.lit(None), limit, F.col("p99") > limit, F.col("p99") / limit)),
    )
    rows = windows.crossJoin(bounds).select(
        "_at", F.explode(F.filter(entries, lambda entry: entry.isNotNull())).alias("_trend"))
    dated = rows.select("_at", "_trend.*").withColumns(
        {
            "window_start": F.timestamp_seconds("_at"),
            "window_end": F.timestamp_seconds(at + window_seconds),
            "window_duration": F.lit(window_label(window_seconds)),
            "event_date": F.to_date(F.timestamp_seconds("_at")).cast("string"),
            "processed_at": instant(as_of),
        }
    )
    return conform(dated, TREND)


def trend_alerts(rows: DataFrame, as_of=None) -> DataFrame:
    """One alert per trend beyond its limit, with the columns of the alerts of events. There is no event to
    name; the numbers behind the trend are in ``metadata``."""
    now, kind, value = instant(as_of), F.col("trend_type"), F.col("metric_value")
    since = iso_text(F.col("window_start"))
    message = (
        F.when(kind == "traffic_spike", F.format_string(
            "Traffic spike detected: %.0f events in %s from %s, on average %.1f before", value, "window_duration", since, "baseline"))
        .when(kind == "purchase_drop", F.format_string(
            "Purchase drop detected: %.0f purchases in %s from %s, %.0f before", value, "window_duration", since, "baseline"))
        .otherwise(F.format_string(
            "Slow responses detected: 99th percentile %.0fms in %s from %s", value, "window_duration", since))
    )
    facts = F.create_map(*[
        part for name in ("window_duration", "metric_value", "baseline", "metric_threshold")
        for part in (F.lit(name), F.col(name).cast("string"))])
    alerts = rows.filter("is_triggered").withColumns(
        {
            "alert_id": F.concat_ws(
                "-", F.lit("alert"), kind, "window_duration", F.unix_seconds("window_start").cast("string"),
                F.unix_seconds(now).cast("string")),
            "event_id": F.lit(None).cast("string"),
            "anomaly_type": kind,
            "anomaly_score": F.col("trend_score"),
            "event_type": F.when(kind == "purchase_drop", "purchase"),
            "timestamp": since,
            "detected_at": iso_text(now, "+00:00"),
            "response_time_ms": F.when(kind == "slow_window", value).cast("int"),
            "error_code": F.lit(None).cast("int"),
            "message": message,
            "metadata": F.map_filter(facts, lambda _, fact: fact.isNotNull()),
        }
    )
    return conform(alerts, ALERT)
