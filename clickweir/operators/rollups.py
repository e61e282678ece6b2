"""Rollups a dashboard reads: totals, distributions, histograms, timelines, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from clickweir import settings
from clickweir.functions.timing import tumbling
from clickweir.operators.quantiles import exact_quantiles

# ---------------------------------------------------------------- totals


def _percent(part, whole):
    return F.when(whole > 0, part / whole * 100).otherwise(0.0)


def overview_totals(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row of headline numbers; the bounce rate comes from the sessions given."""
    totals = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_if(F.col("event_type") == "purchase").alias("total_purchases"),
        F.count_if(F.col("event_type") == "page_view").alias("_views"),
        F.count_if(F.col("event_type") == "error").alias("_errors"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_revenue"),
        F.avg("response_time_ms").alias("avg_response_time_ms"),
    )
    p95 = exact_quantiles(events, "response_time_ms", {"p95_response_time_ms": 0.95}).select("p95_response_time_ms")
    bounces = sessions.agg(
        (F.coalesce(F.avg(F.col("is_bounced").cast("int")), F.lit(0.0)) * 100).alias("bounce_rate_pct"))
    events_n, sessions_n = F.col("total_events"), F.greatest(F.col("total_sessions"), F.lit(1))
    return (
        totals.crossJoin(F.broadcast(p95))
        .crossJoin(F.broadcast(bounces))
        .select(
            "total_events", "total_users", "total_sessions", "total_purchases", "total_revenue",
            _percent(F.col("total_purchases"), F.col("_views")).alias("conversion_rate_pct"),
            (events_n / sessions_n).alias("avg_events_per_session"),
            "bounce_rate_pct",
            _percent(F.col("_errors"), events_n).alias("error_rate_pct"),
            "avg_response_time_ms", "p95_response_time_ms",
        )
    )


def stage_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and how many rows it has."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
              for name, df in tables.items()]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def session_summary(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if("is_bounced").alias("bounced"),
        F.count_if("has_purchased").alias("with_purchase"),
        F.avg("session_duration_seconds").alias("avg_duration_seconds"),
        F.avg("event_count").alias("avg_events"),
        (F.avg(F.col("is_bounced").cast("int")) * 100).alias("bounce_rate_pct"),
    )


# ---------------------------------------------------------------- distributions


def distribution(df: DataFrame, column: str, counted: str = "count") -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(counted))
        .orderBy(F.desc(counted), column)
    )


def top_values(df: DataFrame, column: str, limit: int = 20) -> DataFrame:
    return distribution(df, column).limit(limit)


def activity_heatmap(events: DataFrame) -> DataFrame:
    """Events per weekday (Monday first, days with events only) and hour ``h00`` to ``h23``."""
    weekday = F.pmod(F.dayofweek("timestamp") + 5, F.lit(7)) + 1
    hours = [f"h{h:02d}" for h in range(24)]
    return (
        events.select(
            weekday.alias("weekday"),
            F.date_format("timestamp", "EEEE").alias("day_name"),
            F.date_format("timestamp", "'h'HH").alias("_hour"),
        )
        .groupBy("weekday", "day_name")
        .pivot("_hour", hours)
        .count()
        .na.fill(0, hours)
        .orderBy("weekday")
    )


# ---------------------------------------------------------------- timelines


def hourly_timeline(events: DataFrame) -> DataFrame:
    """Events and revenue per hour from the first to the last, empty hours as zero."""
    hourly = events.groupBy(tumbling("timestamp", 3600).getField("start").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("revenue"),
    )
    # Days first, hours second: one stray timestamp centuries away makes no giant array.
    one_day = F.expr("interval 1 day")
    spine = (
        hourly.agg(F.min("hour_start").alias("_first"), F.max("hour_start").alias("_last"))
        .select("_first", "_last", F.explode(F.sequence(
            F.date_trunc("day", "_first"), F.date_trunc("day", "_last"), one_day)).alias("_day"))
        .select("_first", "_last", F.explode(F.transform(
            F.sequence(F.lit(0), F.lit(23)),
            lambda h: F.timestamp_seconds(F.unix_seconds("_day") + h * 3600))).alias("hour_start"))
        .filter(F.col("hour_start").between(F.col("_first"), F.col("_last")))
        .select("hour_start")
    )
    return spine.join(hourly, "hour_start", "left").na.fill(0, ["event_count"]).na.fill(0.0, ["revenue"])


def kpi_trend(kpis: DataFrame, metrics: list[str]) -> DataFrame:
    """Chosen KPIs in long form: one row per window and metric."""
    values = [F.col(name).cast("double").alias(name) for name in metrics]
    return kpis.select("window_start", *values).unpivot("window_start", metrics, "metric", "value")


def latest_window(kpis: DataFrame) -> DataFrame:
    return kpis.agg(F.max_by(F.struct("*"), "window_start").alias("_row")).filter("_row is not null").select("_row.*")


# ---------------------------------------------------------------- histograms


def _binned(values: DataFrame, edges: DataFrame) -> DataFrame:
    """Counts of ``_v`` in equal-width bins, empty ones included. ``edges`` is one row with ``_lo``,
    ``_hi``, ``_bins`` and whatever each bin's row shall carry besides. The maximum, and anything
    above it, falls into the last bin; a single value falls into the first."""
    carried = [name for name in edges.columns if not name.startswith("_")]
    place = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.width_bucket("_v", "_lo", "_hi", "_bins"), F.col("_bins").cast("bigint")))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    # One row with a map of the non-empty bins, at most as many as there are bins.
    counts = (
        values.crossJoin(F.broadcast(edges))
        .groupBy(*edges.columns, place.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*edges.columns)
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "_n"))).alias("_counts"))
    )
    return counts.select("*", F.explode(F.sequence(F.lit(1), F.col("_bins"))).alias("bin")).select(
        "bin",
        (F.col("_lo") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("_lo") + width * F.col("bin")).alias("bin_end"),
        F.coalesce(F.try_element_at("_counts", "bin"), F.lit(0)).alias("count"),
        *carried,
    )


def _numbers(df: DataFrame, column: str) -> DataFrame:
    """Values as doubles with one zero; NULL and NaN are no values."""
    number = F.col(column).cast("double") + F.lit(0.0)
    return df.select(number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def histogram(df: DataFrame, column: str, bins: int, bin_limit: DataFrame | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum. ``bin_limit`` is a one-row frame whose ``bins``
    replaces the fixed number."""
    values = _numbers(df, column)
    edges = values.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    edges = edges.withColumn("_bins", F.lit(bins)) if bin_limit is None else edges.crossJoin(
        F.broadcast(bin_limit.select(F.col("bins").cast("int").alias("_bins"))))
    return _binned(values, edges)


def response_histogram(events: DataFrame, bins: int = 50) -> DataFrame:
    """Response times in bins, with their median and 95th percentile on each row."""
    marks = exact_quantiles(events, "response_time_ms", {"median": 0.5, "p95": 0.95})
    edges = marks.select(
        F.col("lowest").alias("_lo"), F.col("highest").alias("_hi"), F.lit(bins).alias("_bins"), "median", "p95")
    return _binned(_numbers(events, "response_time_ms"), edges)


def duration_histogram(sessions: DataFrame, bins: int = 40) -> DataFrame:
    """Session durations in bins, cut at the 99th percentile, with the median on each row."""
    marks = exact_quantiles(sessions, "session_duration_seconds", {"median": 0.5, "cap": 0.99})
    edges = marks.select(
        F.col("lowest").alias("_lo"), F.col("cap").alias("_hi"), F.lit(bins).alias("_bins"), "median", "cap")
    # Values above the cap belong to its bin, the last one, where the binning puts them anyway.
    return _binned(_numbers(sessions, "session_duration_seconds"), edges)


def numeric_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """As many bins as there are distinct values, at most ``bins``.

    The values are counted in a sketch per task. Up to its size, which is well above ``bins``, a theta sketch
    holds each distinct value and counts exactly; beyond, the limit applies. So no task sends more than a sketch.
    """
    size = min(26, max(12, (2 * bins).bit_length()))
    distinct = F.theta_sketch_estimate(F.theta_sketch_agg("_v", size))
    return histogram(df, column, bins, _numbers(df, column).agg(
        F.least(F.coalesce(distinct, F.lit(0)), F.lit(bins)).cast("bigint").alias("bins")))


# ---------------------------------------------------------------- funnels


def overall_funnel(funnels: DataFrame) -> DataFrame:
    """Users and events per step, summed over all windows."""
    return funnels.groupBy("funnel_step", "step_order").agg(
        F.sum("unique_users").alias("unique_users"), F.sum("event_count").alias("event_count"))


def overall_conversion(funnels: DataFrame) -> DataFrame:
    """Conversion of the overall funnel to the next step present; the window holds the few steps."""
    following = F.lead("unique_users").over(Window.partitionBy(F.lit(0)).orderBy("step_order"))
    users = F.col("unique_users")
    return overall_funnel(funnels).withColumn("_next", following).select(
        "funnel_step", "step_order", "unique_users", "event_count",
        F.coalesce(F.round(F.when(users > 0, F.col("_next") / users * 100), 1), F.lit(0.0))
        .alias("conversion_to_next_pct"),
        F.coalesce(users - F.col("_next"), F.lit(0)).alias("drop_off"),
    )


def funnel_trend(funnels: DataFrame, steps: list[str] = settings.FUNNEL_STEPS) -> DataFrame:
    """Users per window, one column per step."""
    return (
        funnels.groupBy("window_start").pivot("funnel_step", steps)
        .agg(F.sum("unique_users")).na.fill(0, steps)
    )


# ---------------------------------------------------------------- alerts


def alert_feed(alerts: DataFrame, summary: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """Alerts with the severity of their window and type; ``acknowledged`` is false if absent.

    The join key has few values and hot ones, so it is left to run-time sizes: the summary has one
    row per window and type and is broadcast when that proves small, else skewed parts are split.
    """
    return _windowed_alerts(alerts, window_seconds).join(
        summary.select("window_start", "anomaly_type", "severity"), ["window_start", "anomaly_type"], "left")


def _windowed_alerts(alerts: DataFrame, window_seconds: int) -> DataFrame:
    seen = F.to_timestamp("timestamp")
    acknowledged = F.col("acknowledged") if "acknowledged" in alerts.columns else F.lit(False)
    return alerts.withColumns({
        "acknowledged": F.coalesce(acknowledged, F.lit(False)),
        "window_start": F.timestamp_seconds(F.floor(F.unix_seconds(seen) / window_seconds) * window_seconds),
    })


def alert_counts(alerts: DataFrame, summary: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """Alerts per window, type and acknowledgement (``alerts``), with their severity. They are counted
    before they meet the summary, so the join has a few rows per window."""
    keys = ["window_start", "anomaly_type"]
    counts = _windowed_alerts(alerts, window_seconds).groupBy(*keys, "acknowledged").agg(F.count(F.lit(1)).alias("alerts"))
    return counts.join(summary.select(*keys, "severity"), keys, "left")


def alert_summary(counts: DataFrame) -> DataFrame:
    """Headline numbers from ``alert_counts``."""
    def those(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("alerts"))), F.lit(0))
    return counts.agg(
        those(~F.col("acknowledged")).alias("active"),
        those(F.lit(True)).alias("total"),
        those(F.col("severity") == "critical").alias("critical"),
        those(F.col("acknowledged")).alias("acknowledged"),
    )


def alerts_by_type(counts: DataFrame) -> DataFrame:
    """Alerts per type from ``alert_counts``, most frequent first."""
    return (
        counts.filter(F.col("anomaly_type").isNotNull()).groupBy("anomaly_type")
        .agg(F.sum("alerts").alias("count")).orderBy(F.desc("count"), "anomaly_type")
    )


def alerts_by_severity(counts: DataFrame) -> DataFrame:
    """One row per severity from ``alert_counts``, zero where there is none."""
    spine = counts.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(s) for s in settings.SEVERITIES])).alias("rank", "severity"))
    counts = counts.groupBy("severity").agg(F.sum("alerts").alias("count"))
    return spine.join(counts, "severity", "left").na.fill(0, ["count"]).select("severity", "rank", "count")


def alert_timeline(feed: DataFrame) -> DataFrame:
    """Newest first."""
    return feed.select(
        "timestamp", "alert_id", "anomaly_type", "severity", "message", "anomaly_score", "acknowledged"
    ).orderBy(F.desc("timestamp"), "alert_id")


# ---------------------------------------------------------------- explorer

# The columns the event browser shows.
BROWSER_COLUMNS = [
    "event_id", "event_type", "user_id", "session_id", "timestamp", "country", "device_type",
    "traffic_source", "response_time_ms", "amount", "error_code",
]


def browse_events(
    events: DataFrame,
    event_types: list[str] = (),
    sources: list[str] = (),
    countries: list[str] = (),
    rows: int = 50,
) -> DataFrame:
    """The newest events that match the filters; an empty filter matches all."""
    if not 10 <= rows <= 200:
        raise ValueError("rows must be between 10 and 200")
    for column, wanted in (("event_type", event_types), ("traffic_source", sources), ("country", countries)):
        if wanted:
            events = events.filter(F.col(column).isin(list(wanted)))
    return events.select(*BROWSER_COLUMNS).orderBy(F.desc("timestamp"), "event_id").limit(rows)


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: type, NULLs, distinct values, and numeric statistics.

    All columns go through one ``(column, value)`` aggregation with map-side counts, instead of a
    distinct aggregate per column, which would multiply every row inside one stage.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    names = [f.name for f in fields]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    types = F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    floating = {f.name for f in fields if isinstance(f.dataType, (DoubleType, FloatType))}
    # NaN counts as missing and both zeros as one, as in the statistics.
    known = {c: F.nullif(F.col(c) + F.lit(0.0), F.lit(float("nan"))) if c in floating else F.col(c) for c in names}
    values = df.select([known[c].cast("string").alias(c) for c in names]).unpivot([], names, "column", "_v")
    counts = (
        values.groupBy("column", "_v").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("column")
        .agg(
            F.sum("_n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
            F.count("_v").alias("distinct"),
        )
        .select(
            "column", types[F.col("column")].alias("type"), "rows", "nulls",
            (F.col("nulls") / F.col("rows") * 100).alias("null_pct"), "distinct",
        )
    )
    if not numeric:
        empty = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "max", "median")]
        return counts.select("*", *empty)
    numbers = df.select([known[c].cast("double").alias(c) for c in numeric]).unpivot([], numeric, "column", "_v")
    stats = numbers.groupBy("column").agg(
        F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"),
    )
    medians = exact_quantiles(numbers, "_v", {"median": 0.5}, ["column"], few_keys=True).select("column", "median")
    return counts.join(F.broadcast(stats), "column", "left").join(F.broadcast(medians), "column", "left")
