"""Silver and gold operators on streams.

All take a streaming frame with a ``timestamp`` event time and bound their state by a watermark. Results
of a window come out when the watermark has passed it. Operators that need several steps chain their
aggregations and joins in one query, each of which holds its rows until the one before has closed them.
Row numbers need all rows of a day; ``plans.live`` rebuilds the days that a batch touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import seconds_between, tumbling
from clickweir.operators import anomalies, funnels, kpis
from clickweir.operators.events import enrich_columns, score_quality
from clickweir.operators.summaries import summarise

DELAY = "1 hour"


def deduplicated(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """First arrival of each event id within the watermark."""
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def scored(events: DataFrame, as_of=None) -> DataFrame:
    """Row-wise enrichment and quality; nothing here needs state."""
    return score_quality(enrich_columns(events), as_of)


def _after_watermark(events: DataFrame, condition: Column) -> DataFrame:
    """Filter without holding the watermark back. Spark moves a filter ahead of the watermark unless
    it reads the event time; then only matching events would advance it, and windows close late."""
    return events.filter(F.when(condition, F.col("timestamp")).isNotNull())


def live_kpis(
    events: DataFrame,
    window_seconds: int = 3600,
    slide_seconds: int | None = None,
    delay: str = DELAY,
    as_of=None,
    gap_seconds: int | None = None,
) -> DataFrame:
    """Windowed KPIs. With ``gap_seconds`` a session is over after so much silence, and the bounce rate counts
    sessions of one event; without it the rate is NULL, as a session may go on for ever."""
    if gap_seconds is None:
        measures = kpis.window_measures(events.withWatermark("timestamp", delay), window_seconds, slide_seconds)
        return kpis.finish_kpis(measures, window_seconds, F.lit(None).cast("bigint"), as_of)
    return kpis.finish_kpis(
        _with_bounces(events, window_seconds, slide_seconds, gap_seconds, delay), window_seconds, F.col("_bounced"), as_of)


def _with_bounces(events: DataFrame, window_seconds: int, slide_seconds: int | None, gap_seconds: int, delay: str) -> DataFrame:
    """Measures per window, and how many sessions of one event it has.

    A closed session of one event counts in the window of that event, but is known only when its silence
    is over. Both inputs of the windows are therefore dated that much later: an event when it would end
    its session, a session at its end (which is the same moment for a session of one event). The windows
    are moved by as much and moved back at the end."""
    gap = gap_seconds * 1_000_000 - 1  # events a full gap apart are two sessions
    shift = gap - 1  # the time of a closed window is its end less a microsecond
    dated = events.withColumn("_at", F.timestamp_micros(F.unix_micros("timestamp") + shift)).withWatermark("_at", delay)
    singles = (
        _after_watermark(events.withWatermark("timestamp", delay), F.col("session_id").isNotNull())
        .groupBy(F.session_window("timestamp", f"{gap} microseconds").alias("_session"), "session_id")
        .agg(F.count("event_id").alias("_events"))
        .filter("_events <= 1")
        .select(F.window_time("_session").alias("_at"), F.lit(1).alias("_bounce"))
    )
    measures, distincts = kpis.measures_of(exact=False)
    width = f"{window_seconds} seconds"
    slide = slide_seconds or window_seconds
    window = F.window("_at", width, f"{slide} seconds", f"{shift % (slide * 1_000_000)} microseconds")

    def back(end: str):
        return F.timestamp_micros(F.unix_micros(F.col(f"_window.{end}")) - shift)

    return (
        dated.withColumn("_bounce", F.lit(0))
        .unionByName(singles, allowMissingColumns=True)
        .groupBy(window.alias("_window"))
        .agg(*measures, *distincts, F.sum("_bounce").alias("_bounced"))
        .withColumns({"window_start": back("start"), "window_end": back("end")})
        .drop("_window")
    )


def live_flags(
    events: DataFrame,
    window_seconds: int = 3600,
    delay: str = DELAY,
    min_samples: int = settings.MIN_SAMPLES,
    error_rate_threshold: float = settings.ERROR_RATE_THRESHOLD,
    slow_response_z: float = settings.SLOW_RESPONSE_Z,
) -> DataFrame:
    """The events with anomaly flags, as ``anomalies.flag_windows`` sets them: each event waits in the state of a
    join until its window is closed, and meets the statistics of the window."""
    timed = events.withWatermark("timestamp", delay)
    stats = anomalies.window_stats(timed, window_seconds).select(
        F.window_time("_window").alias("_closed"), F.unix_micros("_window.start").alias("_start"),
        "_rows", "_error_rate", "_rt_mean", "_rt_dev")
    micros = F.unix_micros("timestamp")
    windowed = timed.withColumn("_start", micros - F.pmod(micros, F.lit(window_seconds * 1_000_000)))
    # Implied by the equal start; it tells Spark how long each side has to be kept.
    near = (F.col("timestamp") <= F.col("_closed")) & (F.col("_closed") < F.col("timestamp") + F.expr(f"INTERVAL {window_seconds} SECONDS"))
    joined = windowed.join(stats.withColumnRenamed("_start", "_begin"), (F.col("_start") == F.col("_begin")) & near)
    return anomalies.judged(joined, events.columns, min_samples, error_rate_threshold, slow_response_z)


def live_funnels(
    events: DataFrame,
    window_seconds: int = 86400,
    steps: list[str] = settings.FUNNEL_STEPS,
    delay: str = DELAY,
    as_of=None,
) -> DataFrame:
    """The funnel of each closed window with exact users.

    The first aggregation has a row per window, step and user; the second one per window, with the users
    and events of every step side by side, so that the next step is a column and no row has to be looked
    up. The result is one row per step that occurs."""
    per_user = (
        _after_watermark(events.withWatermark("timestamp", delay), F.col("event_type").isin(steps))
        .groupBy(tumbling("timestamp", window_seconds).alias("_window"), "event_type", "user_id")
        .agg(F.count("event_id").alias("_events"))
    )
    of = {step: F.col("event_type") == step for step in steps}
    per_window = per_user.groupBy(tumbling(F.window_time("_window"), window_seconds).alias("_window")).agg(
        *[F.struct(
            F.lit(step).alias("funnel_step"),
            F.lit(order).alias("step_order"),
            F.when(F.count_if(of[step]) > 0, F.count_if(of[step] & F.col("user_id").isNotNull())).alias("unique_users"),
            F.sum(F.when(of[step], F.col("_events"))).alias("event_count"),
        ).alias(f"_{order}") for order, step in enumerate(steps, 1)])
    following = [F.col(f"_{n + 1}.unique_users") for n in range(1, len(steps))] + [F.lit(None).cast("bigint")]
    rows = F.array(*[
        F.col(f"_{n}").withField("_next", after) for n, after in enumerate(following, 1)])
    counted = per_window.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), F.inline(rows)
    ).filter("unique_users IS NOT NULL")
    return funnels.finish_funnels(counted, window_seconds, as_of)


def live_anomaly_summary(events: DataFrame, window_seconds: int = 3600, delay: str | None = DELAY, as_of=None) -> DataFrame:
    """Anomalies per closed window and type. ``delay`` is None for what ``live_flags`` returns: those events come
    late by the window they waited in, and the watermark they carry allows for that; a new one would not."""
    timed = events if delay is None else events.withWatermark("timestamp", delay)
    return summarise(_after_watermark(timed, F.col("is_anomaly")), window_seconds, as_of)


def live_visits(
    events: DataFrame, gap_seconds: int = settings.SESSION_GAP_SECONDS, delay: str = DELAY
) -> DataFrame:
    """One row per user and visit. Spark's session window also joins events that are exactly the gap
    apart; a visit ends there, so the gap is a microsecond shorter."""
    gap = f"{gap_seconds * 1_000_000 - 1} microseconds"
    return (
        _after_watermark(events.withWatermark("timestamp", delay), F.col("user_id").isNotNull())
        .groupBy(F.session_window("timestamp", gap).alias("_visit"), "user_id")
        .agg(
            F.min("timestamp").alias("session_start"),
            F.max("timestamp").alias("session_end"),
            F.count("event_id").alias("event_count"),
            *[kpis.count_of(kind).alias(f"{kind}_count") for kind in settings.FUNNEL_STEPS + ["error"]],
            F.min_by("page_url", F.struct("timestamp", "event_id")).alias("entry_page"),
            F.max_by("page_url", F.struct("timestamp", "event_id")).alias("exit_page"),
        )
        .withColumns(
            {
                "session_duration_seconds": seconds_between(F.col("session_start"), F.col("session_end")),
                "is_bounced": F.col("event_count") <= 1,
                "has_purchased": F.col("purchase_count") > 0,
            }
        )
        .drop("_visit")
    )


