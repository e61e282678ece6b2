"""Event-level steps between bronze and silver: dedup, enrichment, scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from clickweir.functions import events
from clickweir.functions.timing import instant
from clickweir.operators.ordering import number_in_group
from clickweir.settings import MIN_QUALITY_SCORE, SILVER_VERSION, SLICE_SECONDS


def deduplicate(df: DataFrame, per_day: bool = False) -> DataFrame:
    """Keep the earliest row of each ``event_id`` (of each day, when ``per_day``).

    Ties fall to the smallest remaining columns, so re-runs agree. Catalyst turns ``= 1`` into a
    group limit ahead of the shuffle: however often an id repeats, each map task sends one row.
    """
    keys = ["event_id", "event_date"] if per_day else ["event_id"]
    ties = [f.name for f in df.schema if f.name not in keys + ["timestamp"] and not isinstance(f.dataType, MapType)]
    first = Window.partitionBy(*keys).orderBy("timestamp", *ties)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def enrich_columns(df: DataFrame) -> DataFrame:
    """The enrichments that need one row only; these also run on a stream."""
    return df.withColumns(
        {
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": F.dayofweek("timestamp"),
            "is_purchase_event": F.col("event_type") == "purchase",
            "is_error_event": F.col("event_type") == "error",
            "traffic_source": events.traffic_source(F.col("referrer_url")),
        }
    )


def number_events(df: DataFrame, per_day: bool = False, slice_seconds: float | None = SLICE_SECONDS) -> DataFrame:
    """``event_number_in_session`` by timestamp, then event id."""
    group = ["session_id", "event_date"] if per_day else ["session_id"]
    return number_in_group(df, group, "event_number_in_session", slice_seconds=slice_seconds)


def enrich(df: DataFrame, per_day: bool = False, slice_seconds: float | None = SLICE_SECONDS) -> DataFrame:
    return enrich_columns(number_events(df, per_day, slice_seconds))


def score_quality(df: DataFrame, as_of=None) -> DataFrame:
    """Add ``quality_score`` and ``quality_flags``."""
    rules = events.QualityRules(instant(as_of), dict(df.dtypes)["timestamp"] == "string")
    return df.withColumns({"quality_score": rules.score(), "quality_flags": rules.flags()})


def split_quality(scored: DataFrame, min_score: float = MIN_QUALITY_SCORE) -> tuple[DataFrame, DataFrame]:
    """``(passed, quarantined)`` at the minimum score."""
    return scored.filter(F.col("quality_score") >= min_score), scored.filter(F.col("quality_score") < min_score)


def stamp(df: DataFrame, as_of=None) -> DataFrame:
    """Load metadata of the silver tables."""
    return df.withColumns({"processed_at": instant(as_of), "silver_version": F.lit(SILVER_VERSION)})
