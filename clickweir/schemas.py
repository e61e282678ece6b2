"""Table contracts, and the one projection that makes a frame obey them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

_TYPES = {
    "string": StringType(), "timestamp": TimestampType(), "double": DoubleType(), "int": IntegerType(),
    "bigint": LongType(), "boolean": BooleanType(), "binary": BinaryType(),
}


def _fields(text: str) -> list[StructField]:
    """Fields from ``name type`` pairs; ``!`` after the type means never NULL."""
    pairs = (item.split() for item in text.split(","))
    return [StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")) for name, kind in pairs]


CLEAN_EVENT = StructType(_fields("""event_id string!, event_type string!, user_id string, session_id string,
    timestamp timestamp!, page_url string, referrer_url string, user_agent string,
    device_type string, browser string, os string, country string, city string, ip_address string,
    amount double, currency string, product_id string, category string, error_code int,
    response_time_ms int, status_code int, event_date string!"""))

# What arrives: the same fields, untyped, before a date is derived.
RAW_EVENT = StructType([StructField(f.name, StringType()) for f in CLEAN_EVENT if f.name != "event_date"])

DEAD_LETTER = StructType(
    [StructField(f.name, f.dataType) for f in CLEAN_EVENT]
    + _fields("raw_value string, error_reason string, error_timestamp string")
)

# Numbers within a session are 64-bit: a single session id can carry billions of rows.
ENRICHED_EVENT = StructType(
    CLEAN_EVENT.fields
    + _fields("""hour_of_day int, day_of_week int, is_purchase_event boolean!,
        is_error_event boolean!, traffic_source string, event_number_in_session bigint""")
)

SCORED_EVENT = StructType(
    ENRICHED_EVENT.fields
    + _fields("quality_score double!, quality_flags string")
)

_LOAD_FIELDS = _fields("processed_at timestamp!, silver_version string!")

SILVER_EVENT = StructType(
    SCORED_EVENT.fields
    + _fields("is_anomaly boolean!, anomaly_type string, anomaly_score double")
    + _LOAD_FIELDS
)

QUARANTINE = StructType(SCORED_EVENT.fields + _LOAD_FIELDS)

_WINDOW = """window_start timestamp!, window_end timestamp!,
    window_duration string!, event_date string"""

KPI = StructType(_fields(f"""{_WINDOW}, hour int, total_events bigint!, page_views bigint!,
    clicks bigint!, add_to_carts bigint!, purchases bigint!,
    logins bigint!, errors bigint!, searches bigint!,
    unique_users bigint!, unique_sessions bigint!, avg_response_time_ms double,
    p95_response_time_ms double, max_response_time_ms double, error_rate double,
    purchase_rate double, conversion_rate double, revenue_total double, revenue_avg double,
    bounce_rate double, processed_at timestamp!"""))

KPI_PANE = StructType(_fields("""window_start timestamp!, pane_seconds int!, page_views bigint!, clicks bigint!,
    add_to_carts bigint!, purchases bigint!, logins bigint!, errors bigint!, searches bigint!,
    _response_sum bigint, _response_count bigint!, max_response_time_ms int, revenue_total double, _revenue double,
    _revenue_count bigint!, _user_ids binary, _session_ids binary, _response_times binary, _bounced bigint!,
    window_duration string!, event_date string!"""))

SESSION = StructType(_fields("""session_id string!, user_id string, session_start timestamp!,
    session_end timestamp!, session_duration_seconds double!,
    event_count bigint!, page_view_count bigint!, click_count bigint!,
    add_to_cart_count bigint!, purchase_count bigint!, error_count bigint!,
    has_purchased boolean!, total_revenue double, entry_page string, exit_page string,
    entry_traffic_source string, device_type string, browser string, os string, country string,
    is_bounced boolean!, event_date string, processed_at timestamp!"""))

FUNNEL = StructType(_fields(f"""{_WINDOW}, funnel_step string!, step_order int!,
    unique_users bigint!, event_count bigint!, conversion_to_next double,
    drop_off_count bigint, drop_off_rate double, processed_at timestamp!"""))

ANOMALY_SUMMARY = StructType(_fields(f"""{_WINDOW}, anomaly_type string!, anomaly_count bigint!,
    avg_anomaly_score double, max_anomaly_score double, severity string, triggering_metric string,
    metric_value double, metric_threshold double, processed_at timestamp!"""))

TREND = StructType(_fields(f"""{_WINDOW}, trend_type string!, metric_value double!, baseline double,
    metric_threshold double, trend_score double, is_triggered boolean!, processed_at timestamp!"""))

ALERT = StructType(_fields("""alert_id string, event_id string, anomaly_type string, anomaly_score double,
    event_type string, timestamp string, detected_at string, response_time_ms int, error_code int,
    message string""") + [StructField("metadata", MapType(StringType(), StringType()))])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, its order, its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
