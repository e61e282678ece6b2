"""Raw events into the bronze and dead-letter tables, in batch and as a stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickweir.operators.ingest import clean_events, dead_letters, parse_events, without_lines
from clickweir.plans.config import Layout
from clickweir.schemas import CLEAN_EVENT, DEAD_LETTER
from clickweir.sources import raw, tables
from clickweir.sources.session import sized_shuffles, use_utc

BRONZE_PARTITIONS = ["event_date", "event_type"]


def create_tables(spark: SparkSession, layout: Layout) -> None:
    tables.create_if_missing(spark, layout.bronze, CLEAN_EVENT, BRONZE_PARTITIONS, layout.fmt)
    tables.create_if_missing(spark, layout.dead_letter, DEAD_LETTER, fmt=layout.fmt)


def _write(parsed: DataFrame, layout: Layout, batch_id: str, as_of, write=tables.append_batch) -> None:
    write(clean_events(parsed), layout.bronze, BRONZE_PARTITIONS, batch_id, layout.fmt)
    write(dead_letters(parsed, as_of), layout.dead_letter, [], batch_id, layout.fmt)


def run_batch(
    spark: SparkSession,
    layout: Layout,
    input_path: str,
    batch_id: str | None = None,
    json_array: bool = False,
    as_of=None,
) -> dict[str, int]:
    """Ingest line files (or files that hold one JSON array each). The batch id defaults to the
    input path, so ingesting the same path again replaces its rows."""
    use_utc(spark)
    create_tables(spark, layout)
    lines = raw.read_array_files(spark, input_path) if json_array else raw.read_lines(spark, input_path)
    batch_id = batch_id or hashlib.sha256(input_path.encode()).hexdigest()[:16]
    # Parsed once, into the shared folder; both tables are written from there.
    parsed, scratch = tables.staged(without_lines(parse_events(lines)), "parsed")
    try:
        with sized_shuffles(spark, tables.stored_bytes(spark, scratch)):  # the input may be compressed, this is not text
            _write(parsed, layout, batch_id, as_of, tables.replace_batch)
    finally:
        tables.remove(spark, scratch)
    # Counted in the tables, where retried tasks cannot inflate them.
    clean = tables.read_batch(spark, layout.bronze, CLEAN_EVENT, BRONZE_PARTITIONS, batch_id, layout.fmt)
    dead = tables.read_batch(spark, layout.dead_letter, DEAD_LETTER, [], batch_id, layout.fmt)
    return {"clean": clean.count(), "dead_letter": dead.count()}


def start_stream(
    events: DataFrame,
    layout: Layout,
    name: str = "bronze_streaming",
    trigger: dict | None = None,
    as_of=None,
) -> StreamingQuery:
    """Start a query that splits each micro-batch into the two tables.

    The batch is parsed once and kept while both tables are written. Its id is the query's name
    and the epoch, so a batch replayed after a failure overwrites itself in both tables.
    """
    spark = use_utc(events.sparkSession)
    create_tables(spark, layout)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        parsed = batch.persist()
        try:
            # Whether there are rows is not asked: one task would parse a whole file for that while all others wait.
            _write(parsed, layout, f"{name}-{epoch}", as_of)
        finally:
            parsed.unpersist()

    return (
        without_lines(parse_events(events))
        .writeStream.foreachBatch(write_batch)
        .queryName(name)
        .outputMode("update")
        .option("checkpointLocation", f"{layout.checkpoints}/{name}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
