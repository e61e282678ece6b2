"""Raw JSON to typed events, split into clean rows and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.functions import events
from clickweir.functions.timing import instant, iso_text
from clickweir.schemas import CLEAN_EVENT, DEAD_LETTER, RAW_EVENT, conform


def parse_raw(raw: DataFrame) -> DataFrame:
    """``raw_value`` to its fields, all text. A line that is no JSON gives all-NULL fields."""
    return raw.select("raw_value", F.from_json("raw_value", RAW_EVENT).alias("event")).select(
        "raw_value", "event.*"
    )


def coerce_types(parsed: DataFrame) -> DataFrame:
    """Text fields to numbers and a timestamp, plus the date; what cannot be read is NULL."""
    typed = {name: events.number(name) for name in events.NUMERIC_FIELDS}
    typed["timestamp"] = F.try_to_timestamp("timestamp")
    return parsed.withColumns(typed).withColumn("event_date", events.event_date(F.col("timestamp")))


def parse_events(raw: DataFrame) -> DataFrame:
    """Parse, coerce, and say why a row is to be rejected (``error_reason``, NULL when clean)."""
    return coerce_types(parse_raw(raw)).withColumn("error_reason", events.reject_reason())


def without_lines(parsed: DataFrame) -> DataFrame:
    """The line itself only where the row is rejected: no one asks for that of a clean row."""
    return parsed.withColumn("raw_value", F.when(F.col("error_reason").isNotNull(), F.col("raw_value")))


def clean_events(parsed: DataFrame) -> DataFrame:
    return conform(parsed.filter(F.col("error_reason").isNull()), CLEAN_EVENT)


def dead_letters(parsed: DataFrame, as_of=None) -> DataFrame:
    rejected = parsed.filter(F.col("error_reason").isNotNull())
    return conform(rejected.withColumn("error_timestamp", iso_text(instant(as_of), "+00:00")), DEAD_LETTER)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split any frame with ``event_id, event_type, timestamp`` into ``(clean, malformed)``."""
    judged = df.withColumn("error_reason", events.reject_reason())
    clean = judged.filter(F.col("error_reason").isNull()).drop("error_reason")
    return clean, judged.filter(F.col("error_reason").isNotNull())
