"""Where raw events come from: JSON files in batch, files or a broker as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickweir.schemas import RAW_EVENT


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON event per line."""
    return spark.read.text(path).withColumnRenamed("value", "raw_value")


def read_array_files(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON array of events, however it is laid out. Each such file is
    read by one task, as its format demands; large inputs belong in line files."""
    kept = F.to_json(F.struct(*RAW_EVENT.fieldNames()), {"ignoreNullFields": "false"})
    bad = StructField("_bad", StringType())
    parsed = spark.read.schema(StructType(RAW_EVENT.fields + [bad])).json(
        path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad")
    return parsed.select(F.coalesce("_bad", kept).alias("raw_value"))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """A folder of line files as a stream, a few files at a time."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
        .withColumnRenamed("value", "raw_value")
    )


def stream_topic(
    spark: SparkSession, servers: str, topic: str = "raw_events", offsets_per_trigger: int = 10_000
) -> DataFrame:
    """A Kafka topic as a stream: from the earliest offset, rate limited, going on after data loss.
    Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .option("failOnDataLoss", "false")
        .load()
        .select(F.col("value").cast("string").alias("raw_value"), F.col("timestamp").alias("kafka_timestamp"))
    )
