"""Alert rows from flagged events, and what is done with them before delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir import settings
from clickweir.functions.timing import instant, iso_text
from clickweir.schemas import ALERT, conform


def default_message():
    """Message text by anomaly type."""
    kind, score = F.col("anomaly_type"), F.coalesce(F.col("anomaly_score"), F.lit(0.0))
    response = F.coalesce(F.col("response_time_ms"), F.lit(0))
    # The three message formats.
    return (
        F.when(kind == "error_rate_spike", F.format_string(
            "Error rate spike detected: anomaly_score=%.2f, event_type=%s", score, "event_type"))
        .when(kind == "slow_response", F.format_string(
            "Slow response detected: %dms, anomaly_score=%.2f, event_id=%s", response, score, "event_id"))
        .otherwise(F.format_string(
            "Anomaly detected: type=%s, score=%.2f, event_id=%s", kind, score, "event_id"))
    )


def alert_rows(df: DataFrame, as_of=None) -> DataFrame:
    """One alert per flagged event. A score of 0 counts as none."""
    now = instant(as_of)
    alerts = df.filter("is_anomaly").withColumns(
        {
            "alert_id": F.concat(F.lit("alert-"), "event_id", F.lit("-"), F.unix_seconds(now).cast("string")),
            "anomaly_score": F.nullif(F.col("anomaly_score"), F.lit(0.0)),
            "timestamp": iso_text(F.col("timestamp")),
            "detected_at": iso_text(now, "+00:00"),
            "metadata": F.create_map().cast("map<string,string>"),
        }
    )
    known = F.col("message") if "message" in df.columns else F.lit(None).cast("string")
    return conform(alerts.withColumn("message", F.coalesce(F.nullif(known, F.lit("")), default_message())), ALERT)


def at_least(alerts: DataFrame, min_score: float = 0.0) -> DataFrame:
    """Alerts at or above a score; an alert without one counts as 0."""
    return alerts.filter(F.coalesce("anomaly_score", F.lit(0.0)) >= min_score)


def top_alerts(alerts: DataFrame, limit: int = settings.MAX_ALERTS_PER_BATCH) -> DataFrame:
    """The batch that is sent: the highest scores, then the smallest id."""
    return alerts.orderBy(F.col("anomaly_score").desc_nulls_last(), "alert_id").limit(limit)


def alerts_cut(alerts: DataFrame, limit: int = settings.MAX_ALERTS_PER_BATCH) -> DataFrame:
    """One row: how many alerts there are, and how many of them ``top_alerts`` leaves out."""
    total = F.count(F.lit(1))
    return alerts.agg(total.alias("total"), F.greatest(total - limit, F.lit(0)).alias("cut"))


def score_band(score="anomaly_score"):
    return F.when(F.col(score) >= 0.8, "red").when(F.col(score) >= 0.5, "orange").otherwise("yellow")


def with_band(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("band", score_band())


def digest(alerts: DataFrame, size: int = settings.DIGEST_SIZE) -> DataFrame:
    """One row: how many alerts there are, and the messages of the first ``size`` in sending order."""
    head = top_alerts(alerts, size).agg(
        F.sort_array(F.collect_list(F.struct(
            (-F.coalesce("anomaly_score", F.lit(0.0))).alias("rank"), "alert_id", "message"))).alias("_head")
    )
    total = alerts.agg(F.count(F.lit(1)).alias("total"))
    return total.crossJoin(F.broadcast(head)).select(
        "total",
        F.concat(F.col("total").cast("string"), F.lit(" Anomaly Alert(s) Detected")).alias("title"),
        F.transform("_head", lambda a: F.concat(a["alert_id"], F.lit(": "), a["message"])).alias("messages"),
    )


def alert_messages(alerts: DataFrame, **more: Column) -> DataFrame:
    """Key and JSON value per alert, as a message sink wants them, and what else is asked for."""
    value = F.to_json(F.struct(*alerts.columns))
    return alerts.select(F.col("alert_id").alias("key"), value.alias("value"), *[c.alias(n) for n, c in more.items()])
