"""Column expressions over one event: coercion, enrichment, quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickweir import settings

NUMERIC_FIELDS = {
    "amount": "double",
    "error_code": "int",
    "response_time_ms": "int",
    "status_code": "int",
}

# Blank means empty after stripping any whitespace, including the ASCII separators.
_BLANK = r"(?U)\A[\s\x1C-\x1F]*\z"


def number(name: str) -> Column:
    """A numeric field from text; anything that is not such a number becomes NULL."""
    return F.col(name).try_cast(NUMERIC_FIELDS[name])


def event_date(ts: Column) -> Column:
    return F.to_date(ts).cast("string")


def reject_reason() -> Column:
    """Why a parsed event cannot be kept, or NULL if it can."""

    def absent(name):
        return F.col(name).isNull() | (F.col(name) == "")

    return (
        F.when(absent("event_id"), "missing_event_id")
        .when(absent("event_type"), "missing_event_type")
        .when(F.col("timestamp").isNull(), "invalid_timestamp")
    )


def traffic_source(url: Column) -> Column:
    """Category of a referrer: direct, a known source in fixed order, else referral."""
    text = F.lower(url)
    category = F.when(url.isNull() | url.isin(settings.DIRECT_REFERRERS), "direct")
    for piece, source in settings.REFERRER_SOURCES.items():
        category = category.when(text.contains(piece), source)
    return category.otherwise("referral")


def is_blank(value: Column) -> Column:
    return value.isNull() | value.rlike(_BLANK)


class QualityRules:
    """Score and flags of one event. All deductions are doubles taken in a fixed order, because
    the 0.5 cut-off depends on the last bit of the result."""

    def __init__(self, now: Column, timestamp_is_text: bool = False):
        ts = F.col("timestamp")
        moment = F.try_to_timestamp(ts) if timestamp_is_text else ts
        event_type, device = F.col("event_type"), F.col("device_type")
        response = F.col("response_time_ms")
        max_age = settings.MAX_AGE_DAYS * 86400 * 1_000_000

        def typed(name):
            return F.col(name).isNull() if name == "timestamp" and not timestamp_is_text else is_blank(F.col(name))

        self._gaps = [(name, typed(name)) for name in settings.CRITICAL_FIELDS]
        self._rules = [
            (0.2, (event_type != "") & ~event_type.isin(settings.EVENT_TYPES),
             F.concat(F.lit("invalid_event_type:"), event_type)),
            (0.1, (device != "") & ~device.isin(settings.DEVICE_TYPES),
             F.concat(F.lit("invalid_device:"), device)),
            (0.1, moment > now, F.lit("future_timestamp")),
            (0.1, F.abs(F.unix_micros(now) - F.unix_micros(moment)) > max_age, F.lit("stale_timestamp")),
            (0.05, response > settings.MAX_RESPONSE_TIME_MS,
             F.concat(F.lit("high_response_time:"), response.cast("string"), F.lit("ms"))),
        ]
        if timestamp_is_text:
            unparsed = (ts != "") & moment.isNull()
            self._rules.insert(2, (0.15, unparsed, F.lit("invalid_timestamp")))

    def score(self) -> Column:
        missing = F.lit(0)
        for _, absent in self._gaps:
            missing = missing + absent.cast("int")
        score = F.lit(1.0) - F.lit(0.15) * missing
        for points, broken, _ in self._rules:
            score = score - F.when(broken, F.lit(points)).otherwise(F.lit(0.0))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))

    def flags(self) -> Column:
        names = F.concat_ws(",", *[F.when(absent, name) for name, absent in self._gaps])
        missing = F.when(names != "", F.concat(F.lit("missing:"), names))
        broken = [F.when(broken, text) for _, broken, text in self._rules]
        return F.nullif(F.concat_ws(",", missing, *broken), F.lit(""))
