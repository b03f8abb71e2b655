"""Stateless ingest pipeline and its file sink, plus duplicate removal within a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from solvind.functions.calendar import add_ingestion_partitions
from solvind.operators.messages import flatten_messages, parse_messages, split_malformed
from solvind.schemas import OBSERVATION_KEY

LANDING_PARTITIONS = ("topic", "year", "month", "day")


def landing_rows(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Messages -> flat rows with arrival-day partition columns; malformed messages are left out
    (`quarantine_rows` has them)."""
    good, _ = split_malformed(parse_messages(messages))
    return add_ingestion_partitions(flatten_messages(good, ingested_at))


def quarantine_rows(messages: DataFrame) -> DataFrame:
    """Messages that could not be read, as text, by topic."""
    _, bad = split_malformed(parse_messages(messages))
    return bad


def dedup_within_watermark(
    rows: DataFrame,
    event_time: str = "event_time",
    delay: str = "1 hour",
    keys: Sequence[str] = OBSERVATION_KEY,
) -> DataFrame:
    """Drop repeats of an observation that arrive within `delay`. State holds one entry per key and is
    dropped behind the watermark.

    A row older than the watermark is dropped even if it is the first of its observation: no bounded state can tell.
    Where late first deliveries count, land every row without this and let `consolidate` remove repeats."""
    if event_time not in rows.columns:
        rows = rows.withColumn(event_time, F.timestamp_seconds("dt"))
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def start_ingest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "1 minute",
    partition_by: Sequence[str] = LANDING_PARTITIONS,
    retention: str | None = None,
) -> StreamingQuery:
    """Append rows to the landing table, exactly once per checkpoint. `every=None` drains what is there
    and stops. `retention` ("30d") lets the sink forget files older than that.

    Read the table through Spark so that the sink's commit log decides which files count.
    """
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    if retention:
        writer = writer.option("retention", retention)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
