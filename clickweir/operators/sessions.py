"""Session metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions.timing import instant, seconds_between
from clickweir.operators.kpis import count_of
from clickweir.schemas import SESSION, conform

COUNTED = {
    "page_view_count": "page_view",
    "click_count": "click",
    "add_to_cart_count": "add_to_cart",
    "purchase_count": "purchase",
    "error_count": "error",
}


def _common_measures() -> list:
    return [
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count("event_id").alias("event_count"),
        *[count_of(kind).alias(name) for name, kind in COUNTED.items()],
    ]


def _derived() -> dict:
    return {
        "session_duration_seconds": seconds_between(F.col("session_start"), F.col("session_end")),
        "has_purchased": F.col("purchase_count") > 0,
        "is_bounced": F.col("event_count") <= 1,
    }


def session_metrics(df: DataFrame, per_day: bool = False, as_of=None) -> DataFrame:
    """One row per session (per session and day, when ``per_day``), from one aggregation: the first
    and last event come along as ``min_by`` / ``max_by``, so a hot session is folded map-side.
    Rows without a session belong to none and are left out."""
    keys = ["event_date", "session_id"] if per_day else ["session_id"]
    moment = F.struct("timestamp", "event_id")
    first = F.struct(
        "user_id", F.col("page_url").alias("entry_page"), F.col("traffic_source").alias("entry_traffic_source"),
        "device_type", "browser", "os", "country", F.col("event_date").alias("first_date"),
    )
    revenue = F.when(F.col("event_type") == "purchase", F.col("amount")).otherwise(0.0)
    sessions = (
        df.filter(F.col("session_id").isNotNull())
        .groupBy(*keys)
        .agg(
            *_common_measures(),
            F.sum(revenue).alias("total_revenue"),
            F.min_by(first, moment).alias("_first"),
            F.max_by(F.col("page_url"), moment).alias("exit_page"),
        )
    )
    flat = sessions.select(
        *[name for name in sessions.columns if name not in ("_first", "event_date")],
        "_first.*",
    ).withColumnRenamed("first_date", "event_date")
    return conform(flat.withColumns({**_derived(), "processed_at": instant(as_of)}), SESSION)


def dashboard_sessions(df: DataFrame) -> DataFrame:
    """The dashboard's sessions: one row per session and user, revenue from every event, first
    known source, device, browser and country, and the overall bounce rate on each row."""
    moment = F.struct("timestamp", "event_id")

    def first_known(name):
        return F.min_by(F.col(name), F.when(F.col(name).isNotNull(), moment))

    sessions = (
        df.filter(F.col("session_id").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("session_id", "user_id")
        .agg(
            *_common_measures(),
            F.sum(F.coalesce("amount", F.lit(0.0))).alias("total_revenue"),
            first_known("traffic_source").alias("entry_traffic_source"),
            first_known("device_type").alias("device_type"),
            first_known("browser").alias("browser"),
            first_known("country").alias("country"),
        )
        .withColumns(_derived())
    )
    overall = sessions.agg(F.avg(F.col("is_bounced").cast("int")).alias("bounce_rate"))
    return sessions.crossJoin(F.broadcast(overall))
