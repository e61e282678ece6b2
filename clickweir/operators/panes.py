"""KPIs put together from panes.

A pane is a short tumbling window that wider windows, sliding ones too, are whole numbers of. Events are
aggregated once, into panes; a window then adds up its panes. So an event is not copied into each window
it lies in, and windows of any width come from one table of panes, without the events.

Counts and sums of panes add up. Distinct ids do not: they are kept as sketches that can be merged
(``panes``), or as one row per pane and id where counts have to be exact (``sliding_kpis``).
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweir.functions.timing import tumbling
from clickweir.operators.kpis import COUNTED, count_of, finish_kpis, single_event_sessions

PANE_SECONDS = 300
_LOG_BUCKETS = 12  # of the sketches of ids: a relative standard error of 1.6 %
_IDS = {"user_id": "unique_users", "session_id": "unique_sessions"}


def _parts() -> list:
    """The measures of a pane that add up."""
    revenue = F.when(F.col("event_type") == "purchase", F.col("amount"))
    return [
        *[count_of(kind).alias(name) for name, kind in COUNTED.items()],
        F.sum("response_time_ms").alias("_response_sum"),
        F.count("response_time_ms").alias("_response_count"),
        F.max("response_time_ms").alias("max_response_time_ms"),
        F.sum(revenue.otherwise(0.0)).alias("revenue_total"),
        F.sum(revenue).alias("_revenue"),
        F.count(revenue).alias("_revenue_count"),
    ]


def _sums() -> list:
    """``_parts`` of several panes, in the columns of a window."""
    return [
        *[F.sum(name).alias(name) for name in COUNTED],
        (F.sum("_response_sum") / F.nullif(F.sum("_response_count"), F.lit(0))).alias("avg_response_time_ms"),
        F.max("max_response_time_ms").alias("max_response_time_ms"),
        F.sum("revenue_total").alias("revenue_total"),
        (F.sum("_revenue") / F.nullif(F.sum("_revenue_count"), F.lit(0))).alias("revenue_avg"),
        F.sum("_bounced").alias("_bounced"),
    ]


def _additive(df: DataFrame, pane_seconds: int, per_day: bool, more: list) -> DataFrame:
    """One row per pane: ``window_start``, ``_parts``, ``more`` and ``_bounced``."""
    counted = df.groupBy(_start(pane_seconds).alias("window_start")).agg(*_parts(), *more)
    bounces = single_event_sessions(df, pane_seconds, per_day=per_day)
    return counted.join(bounces, "window_start", "left").na.fill(0, ["_bounced"])


def _start(pane_seconds: int):
    return tumbling("timestamp", pane_seconds).getField("start")


def _windows(pieces: DataFrame, seconds: int, slide: int | None) -> DataFrame:
    """The pieces in each window that holds their pane; a pane lies in a window if its start does."""
    return pieces.withColumn("_window", tumbling("window_start", seconds, slide)).drop("window_start").withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}).drop("_window")


def panes(df: DataFrame, pane_seconds: int = PANE_SECONDS, per_day: bool = False) -> DataFrame:
    """A table of panes from which ``rolled_up`` makes KPIs: sums, sketches of user and session ids, a
    sketch of response times, and sessions of one event (counted over the whole input; ``per_day``: of
    each date). Rows without a timestamp are in no pane; an empty input gives no panes."""
    ids = [F.hll_sketch_agg(column, F.lit(_LOG_BUCKETS)).alias(f"_{column}s") for column in _IDS]
    times = F.kll_sketch_agg_bigint(F.col("response_time_ms").cast("long")).alias("_response_times")
    return _additive(df, pane_seconds, per_day, [*ids, times]).withColumn("pane_seconds", F.lit(pane_seconds))


def rolled_up(
    table: DataFrame, window_seconds: int = 3600, slide_seconds: int | None = None, pane_seconds: int = PANE_SECONDS, as_of=None
) -> DataFrame:
    """KPIs of windows that are whole numbers of the panes of ``table``, from that table alone. Distinct ids
    and the p95 are estimates, all else is exact. Only panes of ``pane_seconds`` are taken."""
    _whole(pane_seconds, window_seconds, slide_seconds)
    pieces = _windows(table.where(F.col("pane_seconds") == pane_seconds), window_seconds, slide_seconds)
    merged = pieces.groupBy("window_start", "window_end").agg(
        *_sums(),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"_{column}s")).alias(name) for column, name in _IDS.items()],
        F.sum("_response_count").alias("_response_count"),
        F.kll_merge_agg_bigint("_response_times").alias("_response_times"),
    )
    p95 = F.when(F.col("_response_count") > 0, F.kll_sketch_get_quantile_bigint("_response_times", F.lit(0.95)))
    return finish_kpis(merged.withColumn("p95_response_time_ms", p95), window_seconds, F.col("_bounced"), as_of)


def sliding_kpis(df: DataFrame, window_seconds: int, slide_seconds: int, per_day: bool = False, as_of=None) -> DataFrame:
    """The KPIs of ``kpis.windowed_kpis(..., exact=True)`` on sliding windows. What is copied into each window
    of a pane is one row of sums, one row per id, and one per response time, never the events."""
    pane_seconds = gcd(window_seconds, slide_seconds)
    sums = _windows(_additive(df, pane_seconds, per_day, []), window_seconds, slide_seconds)
    out = sums.groupBy("window_start", "window_end").agg(*_sums())
    for column, name in _IDS.items():
        seen = df.where(F.col(column).isNotNull()).select(_start(pane_seconds).alias("window_start"), column).distinct()
        counts = _windows(seen, window_seconds, slide_seconds).groupBy("window_start").agg(F.count_distinct(column).alias(name))
        out = out.join(counts, "window_start", "left").na.fill(0, [name])
    out = out.join(_p95(df, pane_seconds, window_seconds, slide_seconds), "window_start", "left")
    return finish_kpis(out, window_seconds, F.col("_bounced"), as_of)


def _p95(df: DataFrame, pane_seconds: int, window_seconds: int, slide_seconds: int) -> DataFrame:
    """The least response time of each window that 95 % of its events do not exceed, from how often each occurs."""
    value = F.col("response_time_ms")
    often = df.where(value.isNotNull()).groupBy(_start(pane_seconds).alias("window_start"), value).agg(F.count(F.lit(1)).alias("_n"))
    merged = _windows(often, window_seconds, slide_seconds).groupBy("window_start", value).agg(F.sum("_n").alias("_n"))
    window = Window.partitionBy("window_start")
    ranked = merged.select(
        "window_start", value, F.sum("_n").over(window.orderBy(value)).alias("_upto"), F.sum("_n").over(window).alias("_all"))
    return ranked.where(100 * F.col("_upto") >= 95 * F.col("_all")).groupBy("window_start").agg(
        F.min(value).alias("p95_response_time_ms"))


def _whole(pane_seconds: int, window_seconds: int, slide_seconds: int | None) -> None:
    if window_seconds % pane_seconds or (slide_seconds or 0) % pane_seconds:
        raise ValueError(f"windows of {window_seconds} s every {slide_seconds or window_seconds} s are not whole panes of {pane_seconds} s")
