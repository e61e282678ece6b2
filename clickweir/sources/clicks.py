"""The given ``events`` table seen as clickstream events.

The table has ``event_id, ts, user_id, event_type, value, props``; every other clickstream field is
a fixed function of these. The expressions are plain SQL, so a checker can state them as well.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.functions.events import traffic_source
from clickweir.operators.ordering import slice_width, visits
from clickweir.schemas import CLEAN_EVENT, conform
from clickweir.sources.session import scratch_path, use_utc

# The moment that counts as now: the events end two days later, so some are stale, some to come.
AS_OF = datetime(2024, 1, 28)

# Median silence between a user's events is about 7 hours, so visits here are long.
GAP_SECONDS = 6 * 3600

# Clickstream column -> expression over the events table; k is props.k, 0 to 99.
FIELDS = {
    "event_id": "CAST(event_id AS STRING)",
    "event_type": "CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'add_to_cart' ELSE event_type END",
    "user_id": "CAST(user_id AS STRING)",
    "page_url": "'/page/' || CAST(k % 10 AS STRING)",
    "referrer_url": """CASE k % 7 WHEN 0 THEN 'https://www.google.com/search'
        WHEN 1 THEN 'https://m.facebook.com/post' WHEN 2 THEN 'https://news.example.org/newsletter'
        WHEN 3 THEN '/' WHEN 5 THEN 'https://blog.example.org' WHEN 6 THEN 'https://EMAIL.google.com/inbox' END""",
    "user_agent": "'agent-' || CAST(k % 3 AS STRING)",
    "device_type": "CASE k % 4 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' WHEN 2 THEN 'tablet' ELSE 'unknown' END",
    "browser": "CASE k % 3 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' ELSE 'Safari' END",
    "os": "CASE k % 5 WHEN 0 THEN 'Windows' WHEN 1 THEN 'macOS' WHEN 2 THEN 'Linux' WHEN 3 THEN 'iOS' ELSE 'Android' END",
    "country": "CASE k % 6 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE' WHEN 4 THEN 'FR' ELSE 'BR' END",
    "city": "'city-' || CAST(k % 6 AS STRING)",
    "ip_address": "'10.0.0.' || CAST(k AS STRING)",
    "amount": "CASE WHEN event_type = 'purchase' THEN value END",
    "currency": "CASE WHEN event_type = 'purchase' THEN 'USD' END",
    "product_id": "CASE WHEN event_type IN ('signup', 'purchase') THEN 'prod-' || CAST(k AS STRING) END",
    "category": "'cat-' || CAST(k % 5 AS STRING)",
    "error_code": "CASE WHEN event_type = 'error' THEN 500 END",
    "response_time_ms": "CAST(floor(value * 100) AS INT)",
    "status_code": "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END",
}


def _keyed(table: DataFrame) -> DataFrame:
    """The few columns that all fields follow from."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table.select("event_id", F.col("ts").cast("timestamp").alias("timestamp"), "user_id", "event_type", "value", k.alias("k"))


def _mapped(table: DataFrame) -> DataFrame:
    return _filled(_keyed(table))


def _filled(keyed: DataFrame, *more: str) -> DataFrame:
    fields = [f"{text} AS {name}" for name, text in FIELDS.items()]
    return keyed.selectExpr("timestamp", "k", *fields, *more)


def events_path(folder: str) -> str:
    return f"{folder}/events.parquet"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events without sessions, and ``k``."""
    use_utc(spark)
    mapped = _mapped(spark.read.parquet(events_path(folder)))
    return mapped.withColumns({
        "session_id": F.lit(None).cast("string"),
        "event_date": F.to_date("timestamp").cast("string"),
    })


def stream(spark: SparkSession, folder: str, closing: bool = False) -> DataFrame:
    """The same events as a file stream. ``closing`` adds one event of nobody in the year 2100, which moves
    the watermark past all others, so that every window of theirs is closed and comes out."""
    use_utc(spark)
    schema = spark.read.parquet(events_path(folder)).schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    if closing:
        last = scratch_path(spark, "closing")
        late = {"ts": "timestamp_ntz'2100-01-01 00:00:00'", "event_id": "-1", "event_type": "'none'"}
        fields = [f"CAST({late.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
        spark.range(1).selectExpr(*fields).write.parquet(last)
        files = files.unionByName(spark.readStream.schema(schema).parquet(last))
    return _mapped(files).withColumns({
        "session_id": F.lit(None).cast("string"),
        "event_date": F.to_date("timestamp").cast("string"),
    })


def visited(spark: SparkSession, folder: str) -> DataFrame:
    """Clean events with sessions by silence, and their traffic source. Visits are cut from the few columns of
    the table, and the fields are added to the result, so that they are not shuffled."""
    use_utc(spark)
    keyed = _keyed(spark.read.parquet(events_path(folder)))
    time = F.unix_seconds("timestamp")
    size = keyed.agg(F.count(F.lit(1)).alias("rows"), (F.max(time) - F.min(time)).alias("seconds")).first()
    span = (size["seconds"] or 0) + 1
    cut = visits(keyed, gap_seconds=GAP_SECONDS, slice_seconds=slice_width(size["rows"], span, widest=span))
    rows = _filled(cut, "session_id").withColumn("event_date", F.to_date("timestamp").cast("string"))
    return rows.withColumn("traffic_source", traffic_source(F.col("referrer_url")))


def blemished(df: DataFrame) -> DataFrame:
    """Some users and sessions missing, some types unknown."""
    k = F.col("k")
    return df.withColumns({
        "user_id": F.when(k % 11 != 0, F.col("user_id")),
        "session_id": F.when(k % 13 != 0, F.col("session_id")),
        "event_type": F.when(k % 17 == 0, "bogus").otherwise(F.col("event_type")),
    })


def repeated(df: DataFrame) -> DataFrame:
    """Every 50th event once more, a second later."""
    again = df.filter(F.col("event_id").cast("bigint") % 50 == 0)
    return df.unionByName(again.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 second")))


def raw_lines(df: DataFrame) -> DataFrame:
    """Clean events as JSON lines with text numbers. Every 97th event is spoilt, in four ways, and
    some response times are no numbers."""
    fields = [name for name in CLEAN_EVENT.fieldNames() if name != "event_date"]
    number = F.col("event_id").cast("bigint")
    way = F.when(number % 97 == 0, F.floor(number / 97) % 4)
    texts = {name: F.col(name).cast("string") for name in fields}
    texts["timestamp"] = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    texts["response_time_ms"] = F.when(number % 19 == 0, "n/a").otherwise(texts["response_time_ms"])
    texts["event_id"] = F.when(F.coalesce(way != 0, F.lit(True)), F.col("event_id"))
    texts["event_type"] = F.when(way == 1, "").otherwise(F.col("event_type"))
    texts["timestamp"] = F.when(way == 2, "not a time").otherwise(texts["timestamp"])
    line = F.to_json(F.struct(*[text.alias(name) for name, text in texts.items()]))
    broken = F.concat(F.lit("{broken "), number.cast("string"))
    return df.select(F.when(way == 3, broken).otherwise(line).alias("raw_value"))
