"""Anomaly summaries per window and type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import instant, tumbling, window_label
from clickweir.schemas import ANOMALY_SUMMARY, conform


def severity(count):
    return F.when(count >= 100, "critical").when(count >= 50, "high").when(count >= 10, "medium").otherwise("low")


def summarise(flagged: DataFrame, window_seconds: int = 3600, as_of=None) -> DataFrame:
    """Flagged events per window and type.

    ``metric_value`` is the slowest response (ms) for slow responses and the count otherwise, while
    ``metric_threshold`` is a rate, a z-score or 1: the two have different units by contract.
    """
    kind = F.col("anomaly_type")
    spike, slow = kind == "error_rate_spike", kind == "slow_response"
    return conform(
        flagged.groupBy(tumbling("timestamp", window_seconds).alias("_window"), "anomaly_type")
        .agg(
            F.count("event_id").alias("anomaly_count"),
            F.avg("anomaly_score").alias("avg_anomaly_score"),
            F.max("anomaly_score").alias("max_anomaly_score"),
            F.max("response_time_ms").alias("_slowest"),
        )
        .withColumns(
            {
                "window_start": F.col("_window.start"),
                "window_end": F.col("_window.end"),
                "window_duration": F.lit(window_label(window_seconds)),
                "severity": severity(F.col("anomaly_count")),
                "triggering_metric": F.when(spike, "error_rate").when(slow, "response_time_ms").otherwise(kind),
                "metric_value": F.when(slow, F.col("_slowest").cast("double")).otherwise(
                    F.col("anomaly_count").cast("double")),
                "metric_threshold": F.when(spike, settings.ERROR_RATE_THRESHOLD)
                .when(slow, settings.SLOW_RESPONSE_Z).otherwise(1.0),
                "processed_at": instant(as_of),
            }
        )
        .withColumn("event_date", F.to_date("window_start").cast("string")),
        ANOMALY_SUMMARY,
    )


def anomaly_summary(df: DataFrame, window_seconds: int = 3600, as_of=None) -> DataFrame:
    """The same from all events. No anomalies give an empty table of the same schema."""
    return summarise(df.filter("is_anomaly"), window_seconds, as_of)
