"""Windowed KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.timing import instant, tumbling, window_label
from clickweir.operators.quantiles import discrete_quantile, exact_quantiles
from clickweir.schemas import KPI, conform

# KPI column -> the event type it counts.
COUNTED = {
    "page_views": "page_view",
    "clicks": "click",
    "add_to_carts": "add_to_cart",
    "purchases": "purchase",
    "logins": "login",
    "errors": "error",
    "searches": "search",
}


def count_of(event_type: str):
    return F.count_if(F.col("event_type") == event_type)


def ratio(part, whole, digits: int = 4):
    """``part / whole`` rounded, 0 where there is nothing to divide by."""
    return F.round(F.when(whole > 0, part / whole).otherwise(0.0), digits)


def distinct(name: str, exact: bool):
    return F.count_distinct(name) if exact else F.approx_count_distinct(name)


def single_event_sessions(df: DataFrame, window_seconds: int, slide_seconds=None, per_day=False) -> DataFrame:
    """Bounced sessions per window.

    A session of one event bounces in the window of that event, so sessions are counted down to
    ``(count, timestamp)`` and only the single ones are put into windows; the events themselves are
    never joined to their session. Sessions are counted over the whole input, not per window.
    """
    keys = ["event_date", "session_id"] if per_day else ["session_id"]
    return (
        df.filter(F.col("session_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count("event_id").alias("_events"), F.min("timestamp").alias("timestamp"))
        .filter(F.col("_events") <= 1)
        .groupBy(tumbling("timestamp", window_seconds, slide_seconds).alias("_window"))
        .agg(F.count(F.lit(1)).alias("_bounced"))
        .select(F.col("_window.start").alias("window_start"), "_bounced")
    )


def _per_window(df: DataFrame, window_seconds: int, slide_seconds: int | None, measures: list) -> DataFrame:
    return (
        df.groupBy(tumbling("timestamp", window_seconds, slide_seconds).alias("_window"))
        .agg(*measures)
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


def measures_of(exact: bool) -> tuple[list, list]:
    """The aggregates of a window: plain ones, and distinct counts. Only the latter may be estimates."""
    purchase_amount = F.when(F.col("event_type") == "purchase", F.col("amount"))
    revenue = F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(0.0)
    measures = [
        *[count_of(kind).alias(name) for name, kind in COUNTED.items()],
        F.avg("response_time_ms").alias("avg_response_time_ms"),
        discrete_quantile("response_time_ms", 0.95).alias("p95_response_time_ms"),
        F.max("response_time_ms").alias("max_response_time_ms"),
        F.sum(revenue).alias("revenue_total"),
        F.avg(purchase_amount).alias("revenue_avg"),
    ]
    return measures, [distinct("user_id", exact).alias("unique_users"), distinct("session_id", exact).alias("unique_sessions")]


def window_measures(
    df: DataFrame, window_seconds: int, slide_seconds: int | None = None, exact: bool = False
) -> DataFrame:
    """Counts, distinct counts, response times and revenue per window. When not ``exact`` it is one
    aggregation, which also runs on a watermarked stream."""
    measures, distincts = measures_of(exact)
    if not exact:
        return _per_window(df, window_seconds, slide_seconds, measures + distincts)
    # Exact distinct counts keep one row per window and id until the end. They go on their own, so
    # that those rows carry no quantile sketch; the results meet again as one row per window.
    counted = _per_window(df, window_seconds, slide_seconds, distincts).drop("window_end")
    return _per_window(df, window_seconds, slide_seconds, measures).join(counted, "window_start")


def finish_kpis(measures: DataFrame, window_seconds: int, bounced, as_of=None) -> DataFrame:
    """Rates and labels over the measures of a window. ``total_events`` sums the seven counted
    types, so logout and unknown types are not in it."""
    total = sum((F.col(name) for name in COUNTED), F.lit(0))
    return conform(
        measures.withColumn("total_events", total).withColumns(
            {
                "error_rate": ratio(F.col("errors"), F.col("total_events")),
                "purchase_rate": ratio(F.col("purchases"), F.col("total_events")),
                "conversion_rate": ratio(F.col("purchases"), F.col("page_views")),
                "bounce_rate": ratio(bounced, F.col("unique_sessions")),
                "window_duration": F.lit(window_label(window_seconds)),
                "event_date": F.to_date("window_start").cast("string"),
                "hour": F.hour("window_start"),
                "processed_at": instant(as_of),
            }
        ),
        KPI,
    )


def windowed_kpis(
    df: DataFrame,
    window_seconds: int = 3600,
    slide_seconds: int | None = None,
    exact: bool = False,
    per_day: bool = False,
    as_of=None,
) -> DataFrame:
    """KPIs per tumbling window, or sliding when ``slide_seconds`` is given. Distinct users and
    sessions are HyperLogLog estimates unless ``exact``."""
    measures = window_measures(df, window_seconds, slide_seconds, exact)
    bounces = single_event_sessions(df, window_seconds, slide_seconds, per_day)
    joined = measures.join(bounces, "window_start", "left")
    return finish_kpis(joined, window_seconds, F.coalesce(F.col("_bounced"), F.lit(0)), as_of)


def dashboard_kpis(df: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """The dashboard's KPIs: every row counts, distinct counts are exact, p95 is interpolated, and
    the average revenue is the total over purchases (at least 1)."""
    start = tumbling("timestamp", window_seconds).getField("start")
    rows = df.withColumn("window_start", start)
    p95 = exact_quantiles(rows, "response_time_ms", {"response_time_p95": 0.95}, ["window_start"]).select(
        "window_start", "response_time_p95")
    counted = (
        rows.groupBy("window_start")
        .agg(
            F.count("event_id").alias("total_events"),
            *[count_of(kind).alias(name) for name, kind in COUNTED.items()],
            F.count_distinct("user_id").alias("unique_users"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.avg("response_time_ms").alias("avg_response_time_ms"),
            F.max("response_time_ms").cast("double").alias("max_response_time_ms"),
            F.sum(F.coalesce("amount", F.lit(0.0))).alias("revenue_total"),
        )
        .join(p95, "window_start", "left")
    )
    purchases = F.greatest(F.col("purchases"), F.lit(1))
    return counted.withColumns(
        {
            "error_rate": ratio(F.col("errors"), F.col("total_events")),
            "purchase_rate": ratio(F.col("purchases"), F.col("total_events")),
            "conversion_rate": F.round(F.col("purchases") / F.greatest(F.col("page_views"), F.lit(1)), 4),
            # Six digits first: the last bits of a sum depend on the order it was taken in.
            "revenue_avg": F.round(F.round(F.col("revenue_total") / purchases, 6), 2),
        }
    )
