"""Message streams: the same two columns (`value`, `topic`) from Kafka or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from solvind.schemas import TOPIC_ROWS

KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}


def message_source(
    spark: SparkSession,
    kind: str,
    *,
    servers: str | None = None,
    topics: str | None = None,
    path: str | None = None,
    **options: str,
) -> DataFrame:
    """`kind="kafka"` subscribes to comma-separated `topics` (needs the spark-sql-kafka module);
    `kind="files"` follows Parquet files of `TOPIC_ROWS` under `path`.

    Bound a replay with `maxOffsetsPerTrigger` (Kafka) or `maxFilesPerTrigger` (files); split one hot
    Kafka partition over several tasks with `minPartitions`.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").options(**{**KAFKA_DEFAULTS, **options})
        raw = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topics).load()
    elif kind == "files":
        raw = spark.readStream.schema(TOPIC_ROWS).options(**options).parquet(path)
    else:
        raise ValueError(f"unknown message source: {kind}")
    return raw.select("value", "topic")
