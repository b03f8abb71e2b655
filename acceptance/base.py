"""Weather view over `events`, delivery shapes derived from it, and the registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.functions.calendar import epoch_to_timestamp
from solvind.schemas import SILVER
from solvind.session import use_utc

# The two sites with their coordinates and topics.
CITIES = ("Riohacha", "Patagonia")
RIOHACHA = (11.538415, -72.916784)
PATAGONIA = (-41.810147, -68.906269)
SECONDS_PER_LEAP_YEAR = 366 * 86_400


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None = None):
    """Register a query under its function name; without `sql` only its rows are checked."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(use_utc(spark), sf_dir)

        CASES[run.__name__] = Case(pinned, sql)
        return run

    return register


# --- Spark side -------------------------------------------------------------------------------------


def weather(spark: SparkSession, sf_dir: str, two_years: bool = False) -> DataFrame:
    """Silver columns plus event_id. `two_years` moves a quarter of the rows to the next year."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event, user = F.col("event_id"), F.col("user_id")
    north = event % 2 == 0
    dt = F.unix_timestamp(F.col("ts").cast("timestamp"))
    if two_years:
        dt = dt + F.when(event % 4 == 0, F.lit(SECONDS_PER_LEAP_YEAR)).otherwise(F.lit(0))
    temp = (event * 7 % 500) / F.lit(10.0) - F.lit(5.0)
    located = events.select(
        "event_id",
        dt.cast("bigint").alias("dt"),
        F.when(north, CITIES[0]).otherwise(CITIES[1]).alias("city"),
        F.when(north, RIOHACHA[0]).otherwise(PATAGONIA[0]).alias("lat"),
        F.when(north, RIOHACHA[1]).otherwise(PATAGONIA[1]).alias("lon"),
        temp.alias("temp"),
        (F.lit(980) + user % 50).cast("int").alias("pressure"),
        ((event * 13) % 101).cast("int").alias("humidity"),
        ((event * 37 + user) % 101).cast("int").alias("clouds"),
        ((event * 17 % 300) / F.lit(10.0)).alias("wind_speed"),
        ((event * 29) % 360).cast("int").alias("wind_deg"),
        F.when(user % 20 != 0, (event * 11 % 130) / F.lit(10.0)).alias("uv_index"),
    )
    return located.select(
        "event_id",
        "dt",
        F.date_format(epoch_to_timestamp(F.col("dt")), "yyyy-MM-dd HH:mm:ss").alias("dt_iso"),
        "city",
        "lat",
        "lon",
        "temp",
        (F.col("temp") - 2).alias("temp_min"),
        (F.col("temp") + 3).alias("temp_max"),
        (F.col("temp") - 1).alias("feels_like"),
        "pressure",
        "humidity",
        "clouds",
        "wind_speed",
        "wind_deg",
        "uv_index",
    )


def silver(spark: SparkSession, sf_dir: str, two_years: bool = False) -> DataFrame:
    return weather(spark, sf_dir, two_years).select(*SILVER.fieldNames())


def _main(*names: str):
    return F.struct(*names).alias("main")


def _wind():
    return F.struct(F.col("wind_speed").alias("speed"), F.col("wind_deg").alias("deg")).alias("wind")


def _clouds():
    return F.struct(F.col("clouds").alias("all")).alias("clouds")


MAIN_NAMES = ("temp", "temp_min", "temp_max", "feels_like", "pressure", "humidity")


def documents(df: DataFrame) -> DataFrame:
    """Nested history documents (plus city and event_id for routing)."""
    return df.select(
        "event_id", "city", "dt", "dt_iso", "lat", "lon", _main(*MAIN_NAMES), _clouds(), _wind(), "uv_index"
    )


def envelopes(df: DataFrame, delay_ms: int = 0) -> DataFrame:
    """Connector records; a later delivery has a larger `delay_ms`."""
    payload = F.struct(
        "dt",
        F.struct("lat", "lon").alias("coord"),
        _main(*MAIN_NAMES),
        _wind(),
        _clouds(),
        F.col("city").alias("name"),
    )
    return df.select(
        F.concat(F.lit("ab-"), F.col("event_id")).alias("_airbyte_ab_id"),
        (F.col("dt") * 1000 + F.col("event_id") % 7 + delay_ms).alias("_airbyte_emitted_at"),
        payload.alias("_airbyte_data"),
    )


def messages(df: DataFrame) -> DataFrame:
    """Topic rows; every 97th message is broken text."""
    body = F.struct(
        F.struct("lon", "lat").alias("coord"),
        _main("temp", "humidity", "pressure"),
        _wind(),
        _clouds(),
        "dt",
        F.col("city").alias("name"),
    )
    text = F.when(F.col("event_id") % 97 == 0, F.lit("{bad")).otherwise(F.to_json(body))
    return df.select(
        text.cast("binary").alias("value"), F.concat(F.lit("weather_"), F.lower("city")).alias("topic")
    )


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Sums of doubles depend on row order in the last digits."""
    return df.withColumns({name: F.round(name, places) for name, dtype in df.dtypes if dtype == "double"})


# --- SQL side ---------------------------------------------------------------------------------------


def r(expression: str, places: int = 6) -> str:
    """Half-up rounding on the shortest decimal form, as Spark's `round` does for doubles."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,20)), {places}) AS DOUBLE)"


def _weather_sql(two_years: bool) -> str:
    shift = f"CASE WHEN event_id % 4 = 0 THEN {SECONDS_PER_LEAP_YEAR} ELSE 0 END" if two_years else "0"
    return f"""
located AS (
  SELECT event_id,
    CAST(floor(epoch(ts)) AS BIGINT) + {shift} AS dt,
    CASE WHEN event_id % 2 = 0 THEN 'Riohacha' ELSE 'Patagonia' END AS city,
    CASE WHEN event_id % 2 = 0 THEN 11.538415E0 ELSE -41.810147E0 END AS lat,
    CASE WHEN event_id % 2 = 0 THEN -72.916784E0 ELSE -68.906269E0 END AS lon,
    (event_id*7 % 500)/10.0E0 - 5.0E0 AS temp,
    CAST(980 + user_id % 50 AS INTEGER) AS pressure,
    CAST((event_id*13) % 101 AS INTEGER) AS humidity,
    CAST((event_id*37 + user_id) % 101 AS INTEGER) AS clouds,
    (event_id*17 % 300)/10.0E0 AS wind_speed,
    CAST((event_id*29) % 360 AS INTEGER) AS wind_deg,
    CASE WHEN user_id % 20 = 0 THEN NULL ELSE (event_id*11 % 130)/10.0E0 END AS uv_index
  FROM events
),
weather AS (
  SELECT *, temp - 2 AS temp_min, temp + 3 AS temp_max, temp - 1 AS feels_like,
    strftime(stamp, '%Y-%m-%d %H:%M:%S') AS dt_iso,
    CAST(year(stamp) AS INTEGER) AS year, CAST(month(stamp) AS INTEGER) AS month,
    CAST(day(stamp) AS INTEGER) AS day, CAST(hour(stamp) AS INTEGER) AS hour,
    strftime(stamp, '%Y-%m-%d') AS date
  FROM (SELECT *, make_timestamp(dt * 1000000) AS stamp FROM located)
)"""


FACTOR = "CASE WHEN hour BETWEEN 6 AND 18 THEN 1.0E0 - abs(hour - 12)/12.0E0 ELSE 0.0E0 END"
SOLAR = r(f"uv_index*(1.0E0 - clouds/100.0E0)*({FACTOR})", 2)
DENSITY = "pressure*100.0E0/(287.05E0*(temp + 273.15E0))"
POWER = r(f"0.5E0*({DENSITY})*wind_speed*wind_speed*wind_speed", 2)
SOLAR_REASON = "CASE WHEN clouds > 80 THEN 'Alta nubosidad' WHEN uv_index < 2 THEN 'UV bajo' ELSE 'Normal' END"
WIND_REASON = (
    "CASE WHEN wind_speed < 3 THEN 'Viento insuficiente' "
    "WHEN wind_speed > 25 THEN 'Viento excesivo (peligro)' ELSE 'Normal' END"
)
ADVERSE = (
    "CASE WHEN humidity > 85 AND clouds > 80 THEN 'Lluvia probable' WHEN temp > 40 THEN 'Calor extremo' "
    "WHEN temp < 0 THEN 'Congelamiento' ELSE 'Normal' END"
)

# Gold tables, unrounded but for what the tables themselves round. Each may use those before it.
GOLD_SQL = f"""
potencial_solar AS (
  SELECT city, year, month, day, hour, avg({SOLAR}) AS potencial_solar_promedio,
    max({SOLAR}) AS potencial_solar_maximo, avg(uv_index) AS uv_index_promedio,
    avg(clouds) AS nubosidad_promedio, avg(temp) AS temperatura_promedio
  FROM weather GROUP BY city, year, month, day, hour
),
potencial_eolico AS (
  SELECT city, year, month, day, avg({POWER}) AS potencial_eolico_promedio_w,
    max({POWER}) AS potencial_eolico_maximo_w, avg(wind_speed) AS velocidad_viento_promedio,
    max(wind_speed) AS velocidad_viento_maxima_ms, avg(wind_deg) AS direccion_viento_promedio,
    count(*) AS mediciones
  FROM weather GROUP BY city, year, month, day
),
classified AS (
  SELECT *, {SOLAR_REASON} AS reduccion_solar, {WIND_REASON} AS reduccion_eolica,
    {ADVERSE} AS condicion_adversa
  FROM weather
),
condiciones_criticas AS (
  SELECT city, year, month, reduccion_solar, reduccion_eolica, condicion_adversa,
    count(*) AS ocurrencias, avg(temp) AS temperatura_promedio, avg(humidity) AS humedad_promedio,
    avg(clouds) AS nubosidad_promedio, avg(wind_speed) AS viento_promedio
  FROM classified
  WHERE reduccion_solar <> 'Normal' OR reduccion_eolica <> 'Normal' OR condicion_adversa <> 'Normal'
  GROUP BY ALL
),
analisis_comparativo AS (
  SELECT city, year, month, avg(uv_index*(1.0E0 - clouds/100.0E0)) AS potencial_solar_promedio,
    max(uv_index) AS uv_index_maximo, avg(clouds) AS nubosidad_promedio,
    avg(wind_speed*wind_speed*wind_speed/100.0E0) AS potencial_eolico_promedio,
    avg(wind_speed) AS velocidad_viento_promedio, max(wind_speed) AS velocidad_viento_maxima,
    avg(temp) AS temperatura_promedio, avg(humidity) AS humedad_promedio,
    avg(pressure) AS presion_promedio, count(*) AS total_mediciones
  FROM weather GROUP BY city, year, month
),
day_means AS (
  SELECT city, date, year, month, day, avg(uv_index) AS uv_promedio, avg(wind_speed) AS viento_promedio,
    avg(clouds) AS nubosidad_promedio, avg(temp) AS temperatura_promedio
  FROM weather GROUP BY city, date, year, month, day
),
parts AS (
  SELECT *, uv_promedio*(1.0E0 - nubosidad_promedio/100.0E0) AS score_solar,
    viento_promedio*viento_promedio/10.0E0 AS score_eolico
  FROM day_means
),
daily_scores AS (SELECT *, {r("score_solar + score_eolico", 2)} AS score_total FROM parts),
ranked AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY city ORDER BY score_total DESC NULLS LAST, date) AS INTEGER) AS rank_mejor,
    CAST(row_number() OVER (PARTITION BY city ORDER BY score_total NULLS FIRST, date DESC) AS INTEGER) AS rank_peor
  FROM daily_scores
),
ranking_dias AS (
  SELECT *, CASE WHEN rank_mejor <= 10 THEN 'Top 10 Mejores' ELSE 'Top 10 Peores' END AS tipo_dia
  FROM ranked WHERE rank_mejor <= 10 OR rank_peor <= 10
)"""


def over_weather(select: str, two_years: bool = False) -> str:
    return f"WITH {_weather_sql(two_years)} {select}"


def over_gold(select: str, two_years: bool = False) -> str:
    return f"WITH {_weather_sql(two_years)}, {GOLD_SQL} {select}"


def with_more(ctes: str, select: str, two_years: bool = False) -> str:
    """Weather, further named queries, and the final select."""
    return f"WITH {_weather_sql(two_years)}, {ctes} {select}"


SILVER_LIST = ", ".join(SILVER.fieldNames())
