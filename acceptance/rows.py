"""Sources, projections, casts, message parsing, dedup and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.base import (
    CITIES,
    SILVER_LIST,
    case,
    documents,
    envelopes,
    messages,
    over_weather,
    silver,
    weather,
    with_more,
)
from solvind.functions.calendar import add_ingestion_partitions, add_time_parts
from solvind.operators import messages as topics
from solvind.operators import normalise as shapes
from solvind.operators import quality
from solvind.operators.dedup import dedup
from solvind.plans import jobs
from solvind.plans.reports import preview
from solvind.schemas import SILVER
from solvind.sources import read_json_history, read_landing, read_table
from solvind.workspace import fresh_path

# Events per history file: one array of at most this many documents.
ARRAY_SIZE = 5_000

# DuckDB twin of the malformed-message rule in `messages`.
READABLE = "event_id % 97 <> 0"


def write_history_arrays(spark, sf_dir) -> str:
    """One JSON array per file, `city=` folders: documents are grouped by bounded ranges of event ids."""
    root = fresh_path(spark, "history")
    nested = documents(weather(spark, sf_dir))
    fields = [name for name in nested.columns if name not in ("event_id", "city")]
    chunk = F.floor(F.col("event_id") / ARRAY_SIZE)
    arrays = nested.groupBy("city", chunk.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value")
    )
    writer = arrays.select("city", "value").write.partitionBy("city").option("maxRecordsPerFile", 1)
    writer.text(root)
    return root


@case(over_weather(f"SELECT {SILVER_LIST} FROM weather"))
def scan_json_multiline(spark, sf_dir):
    root = write_history_arrays(spark, sf_dir)
    frames = [shapes.normalise(read_json_history(spark, f"{root}/city={city}"), city) for city in CITIES]
    return shapes.union_sources(*frames)


@case(over_weather("SELECT dt, city, CAST(pressure AS INTEGER) AS pressure, CAST(humidity AS INTEGER) AS humidity, clouds FROM weather"))
def scan_json_fractions(spark, sf_dir):
    """Documents whose whole measures arrive with a fraction, and a broken file beside them that is set aside."""
    root, path, broken = (fresh_path(spark, name) for name in ("fractions", "silver", "quarantine"))
    nested = documents(weather(spark, sf_dir)).drop("event_id")
    part = lambda name: (F.col(f"main.{name}") + 0.25).alias(name)
    untidy = nested.withColumn("main", F.struct("main.temp", part("pressure"), part("humidity"), "main.temp_min", "main.temp_max"))
    untidy.write.partitionBy("city").json(root)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{root}/city={CITIES[0]}")
    report = jobs.build_silver(spark, [(f"{root}/city={city}", city) for city in CITIES], None, path, multiline=False, quarantine=broken)
    assert report["unreadable"] == 1 and read_table(spark, broken).first().text == "{broken"
    return read_table(spark, path, SILVER).select("dt", "city", "pressure", "humidity", "clouds")


@case(
    over_weather(
        """SELECT 'ab-' || event_id AS ab_id, dt * 1000 + event_id % 7 AS emitted_at, dt, lat, lon, temp,
        wind_deg, city AS name FROM weather"""
    )
)
def scan_json_lines(spark, sf_dir):
    path = fresh_path(spark, "landing")
    envelopes(weather(spark, sf_dir)).write.json(path)
    landed = read_landing(spark, path)
    return landed.select(
        F.col("_airbyte_ab_id").alias("ab_id"),
        F.col("_airbyte_emitted_at").alias("emitted_at"),
        "_airbyte_data.dt",
        "_airbyte_data.coord.lat",
        "_airbyte_data.coord.lon",
        "_airbyte_data.main.temp",
        F.col("_airbyte_data.wind.deg").cast("int").alias("wind_deg"),
        "_airbyte_data.name",
    )


@case(
    over_weather(
        """SELECT city, year, month, count(*) AS filas, min(dt) AS desde, max(dt) AS hasta, count(uv_index) AS con_uv
        FROM weather GROUP BY city, year, month""",
        two_years=True,
    )
)
def scan_parquet_partitioned(spark, sf_dir):
    path = fresh_path(spark, "silver")
    rows = add_time_parts(silver(spark, sf_dir, two_years=True)).select(*SILVER.fieldNames(), "year", "month")
    rows.hint("rebalance", "city", "year", "month").write.partitionBy("city", "year", "month").parquet(path)
    return (
        read_table(spark, path, rows.schema)
        .groupBy("city", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.min("dt").alias("desde"),
            F.max("dt").alias("hasta"),
            F.count("uv_index").alias("con_uv"),
        )
    )


@case(over_weather(f"SELECT {SILVER_LIST} FROM weather ORDER BY dt, lat, temp, humidity, clouds, wind_speed LIMIT 5"))
def preview_limit(spark, sf_dir):
    ordered = silver(spark, sf_dir).orderBy("dt", "lat", "temp", "humidity", "clouds", "wind_speed")
    return preview(ordered)


@case(over_weather(f"SELECT {SILVER_LIST} FROM weather"))
def normalise_weather(spark, sf_dir):
    nested = documents(weather(spark, sf_dir))
    return quality.require_fields(shapes.normalise(nested), SILVER)


@case(over_weather("SELECT event_id, 'weather_' || lower(city) AS topic, city FROM weather"))
def tag_city(spark, sf_dir):
    rows = weather(spark, sf_dir)
    routed = rows.select("event_id", F.concat(F.lit("weather_"), F.lower("city")).alias("topic"))
    return shapes.tag_city(routed)


@case(
    over_weather(
        """SELECT event_id, try_cast(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(humidity AS VARCHAR) END AS DOUBLE)
          AS humedad, try_cast(city AS DOUBLE) AS ciudad, CAST(dt AS BIGINT) AS dt,
        CAST(wind_deg AS VARCHAR) AS direccion FROM weather"""
    )
)
def safe_casts(spark, sf_dir):
    text = weather(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("humidity").cast("string")).alias("humedad"),
        F.col("city").alias("ciudad"),
        F.col("dt").cast("string").alias("dt"),
        F.col("wind_deg").alias("direccion"),
    )
    return shapes.safe_cast(text, {"humedad": "double", "ciudad": "double", "dt": "bigint", "direccion": "string"})


@case(
    over_weather(
        """SELECT epoch_ms(make_timestamp((dt * 1000 + event_id % 7) * 1000)) AS emitted_at, dt, lat, temp,
        humidity, wind_speed, clouds, city AS name FROM weather"""
    )
)
def unwrap_envelope(spark, sf_dir):
    opened = shapes.unwrap_envelope(envelopes(weather(spark, sf_dir)))
    return opened.select(
        F.unix_millis("ingestion_timestamp").alias("emitted_at"),
        "dt",
        "coord.lat",
        "main.temp",
        F.col("main.humidity").cast("int").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
        F.col("clouds.all").cast("int").alias("clouds"),
        "name",
    )


PARSED = """CASE WHEN {ok} THEN dt ELSE -1 END AS dt, CASE WHEN {ok} THEN lat END AS lat,
  CASE WHEN {ok} THEN temp END AS temp, CASE WHEN {ok} THEN humidity ELSE -1 END AS humidity,
  CASE WHEN {ok} THEN wind_deg ELSE -1 END AS wind_deg, CASE WHEN {ok} THEN city END AS name""".format(ok=READABLE)


@case(over_weather(f"SELECT 'weather_' || lower(city) AS topic, {PARSED} FROM weather"))
def parse_messages(spark, sf_dir):
    parsed = topics.parse_messages(messages(weather(spark, sf_dir)))
    absent = F.lit(-1)
    return parsed.select(
        "topic",
        F.coalesce("data.dt", absent).alias("dt"),
        "data.coord.lat",
        "data.main.temp",
        F.coalesce(F.col("data.main.humidity").cast("int"), absent).alias("humidity"),
        F.coalesce(F.col("data.wind.deg").cast("int"), absent).alias("wind_deg"),
        "data.name",
    )


@case(
    over_weather(
        f"""SELECT dt, lat, lon, temp, pressure, humidity, wind_speed, wind_deg, clouds, city AS city_name,
        'weather_' || lower(city) AS topic, dt + 300 AS ingested FROM weather WHERE {READABLE}"""
    )
)
def flatten_messages(spark, sf_dir):
    good, _ = topics.split_malformed(topics.parse_messages(messages(weather(spark, sf_dir))))
    flat = topics.flatten_messages(good, F.timestamp_seconds(F.col("data.dt") + 300))
    return flat.withColumn("ingested", F.unix_seconds("ingestion_timestamp")).drop("ingestion_timestamp")


@case(
    over_weather(
        f"""SELECT 'weather_' || lower(city) AS topic, CASE WHEN {READABLE} THEN 'leido' ELSE 'apartado' END AS estado,
        count(*) AS mensajes, count(DISTINCT CASE WHEN {READABLE} THEN NULL ELSE '{{bad' END) AS textos
        FROM weather GROUP BY ALL"""
    )
)
def quarantine_messages(spark, sf_dir):
    good, bad = topics.split_malformed(topics.parse_messages(messages(weather(spark, sf_dir))))
    read = good.select("topic", F.lit("leido").alias("estado"), F.lit(None).cast("string").alias("text"))
    aside = bad.select("topic", F.lit("apartado").alias("estado"), F.col("json_string").alias("text"))
    return (
        read.unionByName(aside)
        .groupBy("topic", "estado")
        .agg(F.count(F.lit(1)).alias("mensajes"), F.count_distinct("text").alias("textos"))
    )


@case(over_weather("SELECT event_id, year, month, day, hour, date, dt AS segundo FROM weather", two_years=True))
def time_parts(spark, sf_dir):
    rows = add_time_parts(weather(spark, sf_dir, two_years=True))
    return rows.select(
        "event_id", "year", "month", "day", "hour", "date", F.unix_seconds("timestamp").alias("segundo")
    )


@case(
    """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events"""
)
def ingestion_partitions(spark, sf_dir):
    rows = weather(spark, sf_dir).select("event_id", F.timestamp_seconds("dt").alias("ingestion_timestamp"))
    parts = add_ingestion_partitions(rows).drop("ingestion_timestamp")
    return parts.withColumn("ingestion_date", F.col("ingestion_date").cast("string"))


@case(
    over_weather(
        f"""SELECT {SILVER_LIST.replace("uv_index", "CASE WHEN city = 'Riohacha' THEN uv_index END AS uv_index")}
        FROM weather"""
    )
)
def union_sources(spark, sf_dir):
    """The second site's source lacks uv_index and has its columns in another order."""
    rows = silver(spark, sf_dir)
    first = rows.filter(F.col("city") == CITIES[0])
    second = rows.filter(F.col("city") == CITIES[1]).drop("uv_index")
    return shapes.union_sources(first, second.select(*reversed(second.columns)))


# Every observation is delivered twice, a minute apart; the tie order is that of `dedup`.
DELIVERED_TWICE = """deliveries AS (
  SELECT *, dt * 1000 + event_id % 7 AS emitted FROM weather
  UNION ALL SELECT *, dt * 1000 + event_id % 7 + 60000 AS emitted FROM weather
)"""
TIE_ORDER = """emitted DESC, dt_iso NULLS LAST, city, temp, temp_min, temp_max, feels_like, pressure, humidity, clouds,
  wind_speed, wind_deg, uv_index NULLS LAST"""


@case(
    with_more(
        f"""{DELIVERED_TWICE}, numbered AS (
          SELECT *, row_number() OVER (PARTITION BY dt, lat, lon ORDER BY {TIE_ORDER}) AS copy FROM deliveries
        )""",
        f"SELECT {SILVER_LIST}, emitted FROM numbered WHERE copy = 1",
    )
)
def dedup_observations(spark, sf_dir):
    rows = weather(spark, sf_dir)
    emitted = F.col("dt") * 1000 + F.col("event_id") % 7
    twice = rows.withColumn("emitted", emitted).unionByName(rows.withColumn("emitted", emitted + 60_000))
    deliveries = twice.withColumn("ingestion_timestamp", F.timestamp_millis("emitted"))
    unique = dedup(deliveries.select(*SILVER.fieldNames(), "ingestion_timestamp"))
    return unique.withColumn("emitted", F.unix_millis("ingestion_timestamp")).drop("ingestion_timestamp")


@case(over_weather("SELECT city, count(*) AS filas FROM weather GROUP BY city"))
def dq_gate(spark, sf_dir):
    checked = quality.require_rows(quality.require_fields(silver(spark, sf_dir), SILVER))
    return checked.groupBy("city").agg(F.count(F.lit(1)).alias("filas"))


# Late rows: the first coordinate and the text time are damaged on some events.
DAMAGED = """damaged AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE temp END AS temp, humidity, wind_speed, uv_index, dt,
    CASE WHEN event_id % 13 = 0 THEN '2023-01-01 00:00:00' ELSE dt_iso END AS dt_iso,
    CASE WHEN event_id % 17 = 0 THEN lat + 100 ELSE lat END AS lat, lon
  FROM weather
)"""


@case(
    with_more(
        f"""{DAMAGED}, counts AS (
          SELECT count(*) AS checked, count(*) FILTER (temp IS NULL) AS temp_missing,
            count(*) FILTER (humidity IS NULL) AS humidity_missing,
            count(*) FILTER (wind_speed IS NULL) AS wind_speed_missing,
            count(*) FILTER (uv_index IS NULL) AS uv_index_missing,
            count(*) FILTER (dt IS NULL OR dt <= 0) AS dt_not_epoch,
            count(*) FILTER (CAST(epoch(CAST(dt_iso AS TIMESTAMP)) AS BIGINT) <> dt) AS dt_iso_differs,
            count(*) FILTER (lat NOT BETWEEN -90 AND 90) AS latitude_out_of_range,
            count(*) FILTER (lon NOT BETWEEN -180 AND 180) AS longitude_out_of_range
          FROM damaged
        )""",
        """SELECT rule, violations, checked FROM counts UNPIVOT (violations FOR rule IN (temp_missing, humidity_missing,
          wind_speed_missing, uv_index_missing, dt_not_epoch, dt_iso_differs, latitude_out_of_range,
          longitude_out_of_range))""",
    )
)
def dq_report(spark, sf_dir):
    event = F.col("event_id")
    damaged = weather(spark, sf_dir).withColumns(
        {
            "temp": F.when(event % 11 != 0, F.col("temp")),
            "dt_iso": F.when(event % 13 == 0, "2023-01-01 00:00:00").otherwise(F.col("dt_iso")),
            "lat": F.when(event % 17 == 0, F.col("lat") + 100).otherwise(F.col("lat")),
        }
    )
    return quality.dq_report(damaged)
