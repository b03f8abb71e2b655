"""Structured Streaming runs that drain what is there and are read back as tables."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from acceptance.base import case, messages, over_weather, weather
from acceptance.rows import READABLE
from solvind.operators import compaction
from solvind.operators.messages import flatten_messages, parse_messages, split_malformed
from solvind.plans import jobs
from solvind.schemas import HISTORY_TABLE
from solvind.sources import message_source, read_table
from solvind.streaming import ingest
from solvind.workspace import fresh_path

SPLIT = 1_705_708_800  # 2024-01-20 00:00 UTC


def _arrival():
    """Five minutes after the observation, so that partitions do not depend on the clock."""
    return F.timestamp_seconds(F.col("data.dt") + 300)


def _publish(rows, topic_dir: str) -> None:
    """Put messages where the file stand-in for a topic looks for them."""
    messages(rows).write.mode("append").parquet(topic_dir)


def _drain(rows, path: str, checkpoint: str, partition_by=ingest.LANDING_PARTITIONS) -> None:
    query = ingest.start_ingest(rows, path, checkpoint, every=None, partition_by=partition_by)
    query.awaitTermination()


TOPIC = "'weather_' || lower(city) AS topic"


@case(over_weather(f"SELECT {TOPIC}, count(*) AS mensajes, count(*) FILTER ({READABLE}) AS legibles FROM weather GROUP BY ALL"))
def stream_kafka_shape(spark, sf_dir):
    """Messages as the source delivers them: binary value and topic."""
    topic_dir, path = fresh_path(spark, "topic"), fresh_path(spark, "raw")
    _publish(weather(spark, sf_dir), topic_dir)
    raw = message_source(spark, "files", path=topic_dir)
    _drain(raw, path, fresh_path(spark, "checkpoint"), partition_by=["topic"])
    text = F.col("value").cast("string")
    return (
        read_table(spark, path)
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("mensajes"), F.count_if(text.startswith("{\"")).alias("legibles"))
    )


@case(
    over_weather(
        f"""SELECT dt, lat, lon, temp, pressure, humidity, wind_speed, wind_deg, clouds, city AS city_name, {TOPIC}
        FROM weather WHERE {READABLE}"""
    )
)
def stream_parse_flatten(spark, sf_dir):
    topic_dir, path = fresh_path(spark, "topic"), fresh_path(spark, "flat")
    _publish(weather(spark, sf_dir), topic_dir)
    good, _ = split_malformed(parse_messages(message_source(spark, "files", path=topic_dir)))
    _drain(flatten_messages(good), path, fresh_path(spark, "checkpoint"), partition_by=["topic"])
    return read_table(spark, path).drop("ingestion_timestamp")


LANDED = f"""SELECT {TOPIC}, CAST(year(arrived) AS INTEGER) AS year, CAST(month(arrived) AS INTEGER) AS month,
  CAST(day(arrived) AS INTEGER) AS day, count(*) AS filas, min(dt) AS desde, max(dt) AS hasta,
  CAST(sum(wind_deg) AS BIGINT) AS grados
  FROM (SELECT *, make_timestamp((dt + 300) * 1000000) AS arrived FROM weather WHERE {READABLE}) GROUP BY ALL"""


def _landed_summary(spark, path: str):
    return (
        read_table(spark, path)
        .groupBy("topic", "year", "month", "day")
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.min("dt").alias("desde"),
            F.max("dt").alias("hasta"),
            F.sum("wind_deg").alias("grados"),
        )
    )


@case(over_weather(LANDED))
def stream_parquet_append(spark, sf_dir):
    topic_dir, path = fresh_path(spark, "topic"), fresh_path(spark, "landing")
    _publish(weather(spark, sf_dir), topic_dir)
    rows = ingest.landing_rows(message_source(spark, "files", path=topic_dir), _arrival())
    _drain(rows, path, fresh_path(spark, "checkpoint"))
    return _landed_summary(spark, path)


@case(over_weather(LANDED))
def stream_restart_exactly_once(spark, sf_dir):
    """Three runs on one checkpoint: first half, second half, nothing new."""
    topic_dir, path, checkpoint = (fresh_path(spark, name) for name in ("topic", "landing", "checkpoint"))
    rows = weather(spark, sf_dir)

    def run() -> None:
        source = message_source(spark, "files", path=topic_dir)
        _drain(ingest.landing_rows(source, _arrival()), path, checkpoint)

    _publish(rows.filter(F.col("dt") < SPLIT), topic_dir)
    run()
    _publish(rows.filter(F.col("dt") >= SPLIT), topic_dir)
    run()
    run()
    return _landed_summary(spark, path)


@case(over_weather(f"SELECT DISTINCT dt, lat, lon, {TOPIC} FROM weather WHERE {READABLE}"))
def stream_dedup_watermark(spark, sf_dir):
    """Every message arrives twice, then the topic is replayed: one row per observation remains."""
    topic_dir, path, checkpoint = (fresh_path(spark, name) for name in ("topic", "landing", "checkpoint"))
    rows = weather(spark, sf_dir)

    def run() -> None:
        landed = ingest.landing_rows(message_source(spark, "files", path=topic_dir), _arrival())
        unique = ingest.dedup_within_watermark(landed)
        _drain(unique, path, checkpoint)

    _publish(rows, topic_dir)
    _publish(rows, topic_dir)
    run()
    _publish(rows, topic_dir)
    run()
    return read_table(spark, path).select("dt", "lat", "lon", "topic")


@case(
    over_weather(
        f"""SELECT {TOPIC}, count(*) AS enviados, count(*) FILTER ({READABLE}) AS llegados,
        count(*) FILTER (NOT ({READABLE})) AS apartados FROM weather GROUP BY ALL"""
    )
)
def stream_quarantine(spark, sf_dir):
    """Landed and set aside add up to what was sent; messages with one bad field land."""
    topic_dir, path, checkpoint, aside = (fresh_path(spark, name) for name in ("topic", "landing", "checkpoint", "aside"))
    sent = messages(weather(spark, sf_dir))
    text = F.regexp_replace(F.col("value").cast("string"), '"humidity":[0-9]+', '"humidity":"n/a"')
    sent.withColumn("value", text.cast("binary")).write.parquet(topic_dir)
    source = message_source(spark, "files", path=topic_dir)
    jobs.ingest_messages(source, path, checkpoint, every=None, quarantine=aside, ingested_at=_arrival())
    for query in spark.streams.active:
        query.awaitTermination()
    landed = read_table(spark, path).groupBy("topic").agg(F.count(F.lit(1)).alias("llegados"), F.count("humidity").alias("con_humedad"))
    apart = read_table(spark, aside).groupBy("topic").agg(F.count(F.lit(1)).alias("apartados"))
    joined = sent.groupBy("topic").agg(F.count(F.lit(1)).alias("enviados")).join(landed.where("con_humedad = 0"), "topic").join(apart, "topic")
    return joined.select("topic", "enviados", "llegados", "apartados")


@case(over_weather(f"SELECT DISTINCT dt, lat, lon FROM weather WHERE {READABLE}"))
def stream_late_first_delivery(spark, sf_dir):
    """The later half of the messages arrives first. All land, and consolidation keeps one row per observation."""
    topic_dir, path, checkpoint, history = (fresh_path(spark, name) for name in ("topic", "landing", "checkpoint", "history"))
    rows = weather(spark, sf_dir)
    for part in (rows.filter(F.col("dt") >= SPLIT), rows.filter(F.col("dt") < SPLIT), rows.filter(F.col("dt") < SPLIT)):
        _publish(part, topic_dir)
        _drain(ingest.landing_rows(message_source(spark, "files", path=topic_dir), _arrival()), path, checkpoint)
    jobs.consolidate(jobs.landing_as_history(spark, path, "stream"), history)
    return read_table(spark, history, HISTORY_TABLE).select("dt", "lat", "lon")


BATCHES = 60


def _many_batches(spark, sf_dir, path: str, checkpoint: str, parts: int = BATCHES) -> None:
    """The messages as one file for each of many micro-batches, in the order of their time, drained one by one."""
    topic_dir = fresh_path(spark, "topic")
    messages(weather(spark, sf_dir).repartitionByRange(parts, "dt")).write.parquet(topic_dir)
    source = message_source(spark, "files", path=topic_dir, maxFilesPerTrigger="1")
    _drain(ingest.landing_rows(source, _arrival()), path, checkpoint)


@case(over_weather(f"SELECT *, CAST(1 AS BIGINT) AS archivos FROM ({LANDED})"))
def stream_compacted_landing(spark, sf_dir):
    """Sixty micro-batches, compacted: the same rows from one file a topic and arrival day."""
    path = fresh_path(spark, "landing")
    _many_batches(spark, sf_dir, path, fresh_path(spark, "checkpoint"))
    jobs.compact_landing(spark, path, grace=0)
    keys = ["topic", "year", "month", "day"]
    rows = compaction.read_landed(spark, path, with_file=True)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("filas"),
        F.min("dt").alias("desde"),
        F.max("dt").alias("hasta"),
        F.sum("wind_deg").alias("grados"),
        F.countDistinct("_file").alias("archivos"),
    )


class Killed(RuntimeError):
    """Stands for a lost driver."""


@case(over_weather(f"""SELECT dt, lat, lon, CAST(1 AS BIGINT) AS filas, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month
        FROM weather WHERE {READABLE} GROUP BY ALL"""))
def stream_consolidate_exactly_once(spark, sf_dir):
    """Landed files go to history as a stream. A run dies between a batch's write and its entry in the ledger; the next ones
    repeat that batch, take the rest, and find nothing new: each observation is there once."""
    path, history, checkpoint = (fresh_path(spark, name) for name in ("landing", "history", "checkpoint"))
    _many_batches(spark, sf_dir, path, fresh_path(spark, "ingest"), parts=6)
    files = len(spark.read.parquet(path).inputFiles())

    def die(batch_id, report):
        if batch_id == 1:
            raise Killed

    def run(on_written=None):
        jobs.consolidate_stream(spark, path, history, checkpoint, max_files=-(-files // 4), on_written=on_written).awaitTermination()

    try:
        run(die)
    except StreamingQueryException:
        pass
    run()
    run()
    return read_table(spark, history, HISTORY_TABLE).groupBy("dt", "lat", "lon", "year", "month").agg(F.count(F.lit(1)).alias("filas"))
