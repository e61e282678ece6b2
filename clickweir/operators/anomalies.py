"""Event anomalies against batch statistics, and window trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import tumbling
from clickweir.operators.quantiles import discrete_quantile


def _stats_of(grouped) -> DataFrame:
    return grouped.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.try_divide(F.count_if(F.col("event_type") == "error"), F.count(F.lit(1))).alias("_error_rate"),
        F.coalesce(F.avg("response_time_ms"), F.lit(0.0)).alias("_rt_mean"),
        F.stddev_samp("response_time_ms").alias("_rt_dev"),
    ).withColumn("_rt_dev", F.when(F.col("_rt_dev") > 0, F.col("_rt_dev")).otherwise(1.0))


def batch_stats(df: DataFrame, per_day: bool = False) -> DataFrame:
    """Size, error rate, response-time mean and sample deviation: one row, or one per day."""
    return _stats_of(df.groupBy("event_date") if per_day else df.groupBy())


def window_stats(df: DataFrame, window_seconds: int) -> DataFrame:
    """The same per event-time window ``_window``; on a stream with a watermark, of closed windows."""
    return _stats_of(df.groupBy(tumbling("timestamp", window_seconds).alias("_window")))


def no_anomalies(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_anomaly": F.lit(False),
            "anomaly_type": F.lit(None).cast("string"),
            "anomaly_score": F.lit(None).cast("double"),
        }
    )


def flag_anomalies(
    df: DataFrame,
    per_day: bool = False,
    min_samples: int = settings.MIN_SAMPLES,
    error_rate_threshold: float = settings.ERROR_RATE_THRESHOLD,
    slow_response_z: float = settings.SLOW_RESPONSE_Z,
) -> DataFrame:
    """Mark error events of a batch with too many errors, and responses far above the mean.

    The statistics are one row (``per_day``: one row per date of the run), so they are broadcast
    and the events are not moved. Rows without a date belong to no day and are not flagged.
    """
    stats = F.broadcast(batch_stats(df, per_day))
    joined = df.join(stats, "event_date", "left") if per_day else df.crossJoin(stats)
    return judged(joined, df.columns, min_samples, error_rate_threshold, slow_response_z)


def flag_windows(
    df: DataFrame,
    window_seconds: int = 3600,
    min_samples: int = settings.MIN_SAMPLES,
    error_rate_threshold: float = settings.ERROR_RATE_THRESHOLD,
    slow_response_z: float = settings.SLOW_RESPONSE_Z,
) -> DataFrame:
    """As ``flag_anomalies``, with each event-time window as a batch of its own. Rows without a time are not
    flagged. The join is left to measured sizes: windows may be many."""
    windowed = df.withColumn("_window", tumbling("timestamp", window_seconds))
    joined = windowed.join(window_stats(df, window_seconds), "_window", "left")
    return judged(joined, df.columns, min_samples, error_rate_threshold, slow_response_z)


def judged(
    joined: DataFrame, columns: list[str], min_samples: int, error_rate_threshold: float, slow_response_z: float
) -> DataFrame:
    """``columns`` of events that stand beside the statistics of their batch, and the three anomaly columns."""
    z = (F.col("response_time_ms") - F.col("_rt_mean")) / F.col("_rt_dev")
    enough = F.coalesce(F.col("_rows") >= min_samples, F.lit(False))
    spike = enough & (F.col("event_type") == "error") & (F.col("_error_rate") > error_rate_threshold)
    slow = enough & (z > slow_response_z)
    spike_score = F.round(F.least(F.col("_error_rate") / F.lit(error_rate_threshold), F.lit(2.0)), 2)
    slow_score = F.round(
        (F.col("response_time_ms") - F.col("_rt_mean")) / (F.col("_rt_dev") * F.lit(slow_response_z)), 2
    )
    return (
        joined.withColumn("anomaly_type", F.when(spike, "error_rate_spike").when(slow, "slow_response"))
        .withColumn("is_anomaly", F.col("anomaly_type").isNotNull())
        .withColumn(
            "anomaly_score",
            F.when(F.col("anomaly_type") == "error_rate_spike", spike_score)
            .when(F.col("anomaly_type") == "slow_response", slow_score),
        )
        .select(*columns, "is_anomaly", "anomaly_type", "anomaly_score")
    )


def _window_counts(df: DataFrame, seconds: int, amount) -> DataFrame:
    return df.groupBy(tumbling("timestamp", seconds).getField("start").alias("window_start")).agg(amount)


def _later(seconds: int):
    return F.timestamp_seconds(F.unix_seconds("window_start") + seconds)


def traffic_spikes(
    df: DataFrame,
    window_seconds: int = settings.TREND_WINDOW_SECONDS,
    factor: float = settings.TRAFFIC_SPIKE_FACTOR,
    history: int = settings.TRAFFIC_HISTORY_WINDOWS,
) -> DataFrame:
    """Event count per window against the mean of the ``history`` windows before it.

    Empty windows count as zero, without building them: each window hands its count to the next
    ``history`` windows, and the mean divides by how many windows lie before (at most ``history``).
    One row per window that has events.
    """
    counts = _window_counts(df, window_seconds, F.count(F.lit(1)).alias("event_count"))
    first = F.broadcast(counts.agg(F.min("window_start").alias("_first")))
    past = (
        counts.select(
            F.explode(F.sequence(F.lit(1), F.lit(history))).alias("_step"), "window_start", "event_count")
        .groupBy(F.timestamp_seconds(F.unix_seconds("window_start") + F.col("_step") * window_seconds)
                 .alias("window_start"))
        .agg(F.sum("event_count").alias("_past"))
    )
    before = (F.unix_seconds("window_start") - F.unix_seconds("_first")) / F.lit(window_seconds)
    windows = F.least(before.cast("bigint"), F.lit(history))
    average = F.when(windows > 0, F.coalesce(F.col("_past"), F.lit(0)) / windows)
    return (
        counts.join(past, "window_start", "left")
        .crossJoin(first)
        .withColumn("rolling_avg", average)
        .select(
            "window_start", "event_count", "rolling_avg",
            F.coalesce(F.col("event_count") > F.col("rolling_avg") * factor, F.lit(False)).alias("is_spike"),
        )
    )


def purchase_drops(
    df: DataFrame,
    window_seconds: int = settings.TREND_WINDOW_SECONDS,
    fraction: float = settings.PURCHASE_DROP_FRACTION,
) -> DataFrame:
    """Purchases per window against the window before. One row per window, up to the last one with
    events, in which this or the previous window has purchases; a silent window counts as zero."""
    counts = _window_counts(
        df, window_seconds, F.count_if(F.col("event_type") == "purchase").alias("purchases"))
    last = F.broadcast(counts.agg(F.max("window_start").alias("_last")))
    active = counts.filter(F.col("purchases") > 0)
    previous = active.select(_later(window_seconds).alias("window_start"), F.col("purchases").alias("previous"))
    both = active.join(previous, "window_start", "full").na.fill(0, ["purchases", "previous"])
    return (
        both.crossJoin(last)
        .filter(F.col("window_start") <= F.col("_last"))
        .select(
            "window_start", "purchases", F.col("previous").alias("previous_purchases"),
            F.when(F.col("previous") > 0, 1 - F.col("purchases") / F.col("previous")).alias("drop_rate"),
        )
        .withColumn("is_drop", F.coalesce(F.col("drop_rate") > fraction, F.lit(False)))
    )


def slow_windows(
    df: DataFrame,
    window_seconds: int = settings.TREND_WINDOW_SECONDS,
    threshold_ms: int = settings.P99_RESPONSE_MS,
) -> DataFrame:
    """99th percentile of the response time per window, and whether it is above the limit."""
    return _window_counts(
        df.filter(F.col("response_time_ms").isNotNull()), window_seconds,
        discrete_quantile("response_time_ms", 0.99).cast("int").alias("p99_response_time_ms"),
    ).withColumn("is_slow", F.col("p99_response_time_ms") > threshold_ms)
