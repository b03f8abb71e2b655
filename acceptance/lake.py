"""Round trips, catalog, consolidation, incremental refresh and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from acceptance.base import (
    CITIES,
    GOLD_SQL,
    case,
    envelopes,
    over_gold,
    over_weather,
    r,
    round_doubles,
    silver,
    weather,
    with_more,
)
from acceptance.rows import TIE_ORDER, write_history_arrays
from solvind.functions.calendar import add_ingestion_partitions, add_time_parts
from solvind.operators import retention
from solvind.operators.layout import write_table
from solvind.operators.normalise import normalise, union_sources
from solvind.plans import catalog, gold, jobs, refresh
from solvind.schemas import HISTORY_TABLE, SILVER
from solvind.sources import read_gold_normalised, read_table
from solvind.workspace import fresh_path

SILVER_SELECT = ", ".join(SILVER.fieldNames())
TABLE_NAMES = tuple(gold.GOLD_TABLES)

# One number per table and site that moves when any row of the table does.
CHECKED = {
    "potencial_solar": ("potencial_solar_promedio", "hour"),
    "potencial_eolico": ("potencial_eolico_promedio_w", "day"),
    "condiciones_criticas": ("viento_promedio", "ocurrencias"),
    "analisis_comparativo": ("potencial_eolico_promedio", "total_mediciones"),
    "ranking_dias": ("score_total", "rank_mejor"),
}
SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT '{table}' AS tabla, city, year, count(*) AS filas, {r(f"sum({mean})", 4)} AS suma,
    CAST(sum({number}) AS BIGINT) AS control FROM {table} GROUP BY city, year"""
    for table, (mean, number) in CHECKED.items()
)


def summary(spark, root: str):
    """Rows and control sums of the five tables under `root`, read back by name."""
    parts = []
    for table, (mean, number) in CHECKED.items():
        stored = read_table(spark, f"{root}/{table}")
        parts.append(
            stored.groupBy(F.lit(table).alias("tabla"), "city", "year").agg(
                F.count(F.lit(1)).alias("filas"),
                F.round(F.sum(mean), 4).alias("suma"),
                F.sum(number).cast("bigint").alias("control"),
            )
        )
    return union_sources(*parts)


@case(over_weather(f"SELECT {SILVER_SELECT} FROM weather"))
def sink_silver_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "silver")
    write_table(silver(spark, sf_dir), path, ["city"])
    return read_table(spark, path, SILVER).select(*SILVER.fieldNames())


@case(over_gold(SUMMARY_SQL, two_years=True))
def sink_gold_roundtrip(spark, sf_dir):
    root = fresh_path(spark, "gold")
    gold.write_gold(silver(spark, sf_dir, two_years=True), root)
    return summary(spark, root)


@case(
    over_gold(
        f"""SELECT city, year, month, day, hour, {r("potencial_solar_promedio")} AS potencial_solar_promedio,
        potencial_solar_maximo, {r("uv_index_promedio")} AS uv_index_promedio,
        {r("nubosidad_promedio")} AS nubosidad_promedio, {r("temperatura_promedio")} AS temperatura_promedio
        FROM potencial_solar"""
    )
)
def scan_gold_normalised(spark, sf_dir):
    """A table whose writer left spaces in a name and the hour as text."""
    path = fresh_path(spark, "gold")
    untidy = gold.potencial_solar(silver(spark, sf_dir)).withColumn("hour", F.col("hour").cast("string"))
    write_table(untidy.withColumnRenamed("uv_index_promedio", " uv_index_promedio "), path, ["city", "year", "month"])
    return round_doubles(read_gold_normalised(spark, path))


def registered_silver(spark, sf_dir, label: str) -> str:
    """Silver by site and month, registered in a database of its own; returns the table name."""
    base = fresh_path(spark, label)
    parts = ["city", "year", "month"]
    rows = add_time_parts(silver(spark, sf_dir, two_years=True)).select(*SILVER.fieldNames(), "year", "month")
    write_table(rows, f"{base}/weather_unified", parts)
    database = "silver_" + base.rsplit("-", 1)[-1]
    catalog.create_database(spark, database, f"{base}/db")
    catalog.register_table(spark, f"{database}.weather_unified", f"{base}/weather_unified", rows.schema, parts)
    return f"{database}.weather_unified"


@case(
    over_weather(
        """SELECT city, CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month FROM weather
        GROUP BY city, year, month""",
        two_years=True,
    )
)
def catalog_register(spark, sf_dir):
    """The partitions that registration discovered."""
    shown = spark.sql(f"SHOW PARTITIONS {registered_silver(spark, sf_dir, 'registered')}")
    found = F.str_to_map("partition", F.lit("/"), F.lit("="))
    return shown.select(*(found[name].alias(name) for name in ("city", "year", "month")))


@case(
    over_weather(
        f"""SELECT city, year, month, count(*) AS filas, {r("avg(temp)")} AS temp_promedio FROM weather
        GROUP BY city, year, month""",
        two_years=True,
    )
)
def catalog_table_scan(spark, sf_dir):
    table = read_table(spark, registered_silver(spark, sf_dir, "scanned"))
    return round_doubles(
        table.groupBy("city", "year", "month").agg(
            F.count(F.lit(1)).alias("filas"), F.avg("temp").alias("temp_promedio")
        )
    )


# First delivery: the observations before this moment. Second delivery, an hour later: everything.
SPLIT = 1_705_708_800  # 2024-01-20 00:00 UTC
HOUR_MS = 3_600_000


def _history_rows(spark, deliveries):
    path = fresh_path(spark, "landing")
    deliveries.write.json(path)
    return jobs.landing_as_history(spark, path, "json")


CONSOLIDATED = f"""deliveries AS (
  SELECT *, dt * 1000 + event_id % 7 AS emitted, 1 AS delivery FROM weather WHERE dt < {SPLIT}
  UNION ALL SELECT *, dt * 1000 + event_id % 7 + {HOUR_MS} AS emitted, 2 AS delivery FROM weather
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dt, lat, lon ORDER BY delivery, {TIE_ORDER}) AS copy FROM deliveries
)"""


@case(
    with_more(
        CONSOLIDATED,
        """SELECT dt, city, lat, lon, temp, temp_min, temp_max, feels_like, pressure, humidity, clouds, wind_speed,
        wind_deg, year, month, emitted FROM numbered WHERE copy = 1""",
    )
)
def consolidate_append(spark, sf_dir):
    """Two overlapping deliveries and a repeat of the second: history keeps the first copy it got."""
    history = fresh_path(spark, "history")
    rows = weather(spark, sf_dir)
    first = _history_rows(spark, envelopes(rows.filter(F.col("dt") < SPLIT)))
    second = _history_rows(spark, envelopes(rows, HOUR_MS))
    jobs.consolidate(first, history)
    jobs.consolidate(second, history)
    jobs.consolidate(second, history)
    stored = read_table(spark, history, HISTORY_TABLE)
    emitted = F.unix_millis("ingestion_timestamp").alias("emitted")
    kept = [name for name in HISTORY_TABLE.fieldNames() if name not in ("dt_iso", "uv_index", "ingestion_timestamp")]
    return stored.select(*kept, emitted)


@case(
    over_weather(
        """SELECT 2 * count(*) AS leidos, 2 * count(*) - count(DISTINCT (dt, lat, lon)) AS duplicados,
        count(DISTINCT (dt, lat, lon)) AS escritos FROM weather"""
    )
)
def run_metrics(spark, sf_dir):
    """Counts the consolidation reports: rows read, duplicates removed, rows written."""
    rows = weather(spark, sf_dir)
    twice = _history_rows(spark, envelopes(rows).unionByName(envelopes(rows, HOUR_MS)))
    counts = jobs.consolidate(twice, fresh_path(spark, "history"))
    values = (counts["read"], counts["read"] - counts["unique"], counts["rows"])
    return spark.createDataFrame([values], "leidos bigint, duplicados bigint, escritos bigint")


@case(over_gold(SUMMARY_SQL, two_years=True))
def gold_incremental(spark, sf_dir):
    """Gold of the first year, then a refresh with the second: equal to a full build over both."""
    root, stored = fresh_path(spark, "gold"), fresh_path(spark, "silver")
    rows = add_time_parts(silver(spark, sf_dir, two_years=True)).select(*SILVER.fieldNames(), "year", "month")
    layout = ["city", "year", "month"]
    write_table(rows.filter(F.col("year") == 2024), stored, layout)
    gold.write_gold(read_table(spark, stored, rows.schema), root)
    arrived = rows.filter(F.col("year") == 2025)
    write_table(arrived, stored, layout, mode="append")
    refresh.refresh_gold(read_table(spark, stored, rows.schema), root, refresh.touched_months(arrived))
    return summary(spark, root)


CUTOFF = dt.date(2024, 1, 16)
LANDED = f"""landed AS (
  SELECT *, 'weather_' || lower(city) AS topic, CAST(stamp AS DATE) < DATE '{CUTOFF}' AS old FROM weather
)"""


def _landing_table(spark, sf_dir) -> str:
    """Flat landing rows that arrived when they were observed, by topic and arrival day."""
    path = fresh_path(spark, "stream")
    rows = weather(spark, sf_dir).withColumns(
        {
            "topic": F.concat(F.lit("weather_"), F.lower("city")),
            "ingestion_timestamp": F.timestamp_seconds("dt"),
        }
    )
    landed = add_ingestion_partitions(rows.drop("city", "dt_iso"))
    write_table(landed, path, ["topic", "year", "month", "day"])
    return path


@case(
    with_more(
        LANDED,
        """SELECT topic, count(DISTINCT date) FILTER (old) AS expired_days, count(*) FILTER (old) AS expired_rows,
        count(*) FILTER (NOT old) AS kept_rows FROM landed GROUP BY topic""",
    )
)
def retention_report(spark, sf_dir):
    return retention.retention_report(read_table(spark, _landing_table(spark, sf_dir)), CUTOFF)


@case(
    with_more(
        LANDED,
        "SELECT event_id, topic, year, month, day, dt, temp, uv_index FROM landed WHERE NOT old",
    )
)
def retention_keep(spark, sf_dir):
    landed = read_table(spark, _landing_table(spark, sf_dir))
    return retention.keep(landed, CUTOFF).select("event_id", "topic", "year", "month", "day", "dt", "temp", "uv_index")


@case(with_more(LANDED, "SELECT DISTINCT topic, year, month, day, true AS con_datos FROM landed"))
def retention_files(spark, sf_dir):
    """Folders of the files written before tomorrow, with whether they hold data: sizes are the writer's business."""
    tomorrow = dt.datetime.now() + dt.timedelta(days=1)
    files = retention.expired_files(spark, _landing_table(spark, sf_dir), tomorrow)
    return files.groupBy("topic", "year", "month", "day").agg((F.sum("length") > 0).alias("con_datos"))


@case(with_more(LANDED, "SELECT event_id, topic, year, month, day FROM landed WHERE NOT old"))
def retention_expire_folder(spark, sf_dir):
    """The stream's own folder after its old arrival days have been deleted by path."""
    path = _landing_table(spark, sf_dir)
    jobs.expire_landing_folder(spark, path, CUTOFF + dt.timedelta(days=30), 30)
    return read_table(spark, path).select("event_id", "topic", "year", "month", "day")


ONE_COPY = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY dt, lat, lon ORDER BY {TIE_ORDER}) AS copy
  FROM (SELECT *, CASE WHEN dt < {SPLIT} THEN dt * 1000 + event_id % 7 END AS emitted FROM weather)
)"""


@case(with_more(ONE_COPY, "SELECT dt, city, lat, lon, temp, pressure, humidity, clouds, wind_speed, wind_deg FROM numbered WHERE copy = 1"))
def silver_job(spark, sf_dir):
    """History arrays of two sites, half of them also in consolidated history -> Silver job: one row per observation."""
    root, path, history = write_history_arrays(spark, sf_dir), fresh_path(spark, "silver"), fresh_path(spark, "history")
    jobs.consolidate(_history_rows(spark, envelopes(weather(spark, sf_dir).filter(F.col("dt") < SPLIT))), history)
    sources = [(f"{root}/city={city}", city) for city in CITIES]
    jobs.build_silver(spark, sources, history, path)
    stored = read_table(spark, path, SILVER)
    return stored.select("dt", "city", "lat", "lon", "temp", "pressure", "humidity", "clouds", "wind_speed", "wind_deg")


MANY_MONTHS = 2_000  # more months than any lake has, reached from each event by its id
DAYS_APART = 30


@case(
    with_more(
        f"spread AS (SELECT DISTINCT (event_id % {MANY_MONTHS}) * {DAYS_APART} * 86400 AS dt, lat, lon FROM weather)",
        "SELECT dt, lat, lon, CAST(year(make_timestamp(dt * 1000000)) AS INTEGER) AS year, CAST(month(make_timestamp(dt * 1000000)) AS INTEGER) AS month FROM spread",
    )
)
def consolidate_many_months(spark, sf_dir):
    """A batch that touches some two thousand months, delivered twice."""
    history = fresh_path(spark, "history")
    spread = weather(spark, sf_dir).withColumn("dt", (F.col("event_id") % MANY_MONTHS) * DAYS_APART * 86_400)
    rows = _history_rows(spark, envelopes(spread))
    jobs.consolidate(rows, history)
    jobs.consolidate(rows, history)
    return read_table(spark, history, HISTORY_TABLE).select("dt", "lat", "lon", "year", "month")


@case(over_weather("SELECT DISTINCT dt, lat, lon FROM weather WHERE event_id % 50 <> 7"))
def update_with_bad_epoch(spark, sf_dir):
    """Some deliveries carry milliseconds. The update ends well twice, and Silver holds the others."""
    history, path, root, aside = (fresh_path(spark, name) for name in ("history", "silver", "gold", "aside"))
    wrong = F.col("event_id") % 50 == 7
    rows = weather(spark, sf_dir).withColumn("dt", F.when(wrong, F.col("dt") * 1000).otherwise(F.col("dt")))
    for _ in range(2):
        report = jobs.update_from_landing(spark, _history_rows(spark, envelopes(rows)), history, path, root, aside)
    assert report["implausible"] == read_table(spark, aside).count() / 2
    return read_table(spark, path).select("dt", "lat", "lon")


CORRECTED = """corrected AS (
  SELECT * REPLACE (CASE WHEN fixed THEN 20.0E0 ELSE temp END AS temp, CASE WHEN fixed THEN 50 ELSE humidity END AS humidity,
    CASE WHEN fixed THEN 10 ELSE clouds END AS clouds, CASE WHEN fixed THEN 9.0E0 ELSE wind_speed END AS wind_speed,
    CASE WHEN fixed THEN 6.0E0 ELSE uv_index END AS uv_index)
  FROM (SELECT *, year = 2025 AND city = 'Patagonia' AS fixed FROM weather)
)"""


@case(
    with_more(
        CORRECTED + ", " + GOLD_SQL.replace("FROM weather", "FROM corrected"),
        f"""SELECT city, year, month, reduccion_solar, reduccion_eolica, condicion_adversa, ocurrencias,
        {r("temperatura_promedio")} AS temperatura_promedio, {r("humedad_promedio")} AS humedad_promedio,
        {r("nubosidad_promedio")} AS nubosidad_promedio, {r("viento_promedio")} AS viento_promedio
        FROM condiciones_criticas""",
        two_years=True,
    )
)
def gold_after_correction(spark, sf_dir):
    """All rows of one site's last year are corrected to normal weather: its folder of conditions must go."""
    root, stored = fresh_path(spark, "gold"), fresh_path(spark, "silver")
    rows = add_time_parts(silver(spark, sf_dir, two_years=True)).select(*SILVER.fieldNames(), "year", "month")
    layout = ["city", "year", "month"]
    write_table(rows, stored, layout)
    gold.write_gold(read_table(spark, stored, rows.schema), root)
    normal = {"temp": F.lit(20.0), "humidity": F.lit(50), "clouds": F.lit(10), "wind_speed": F.lit(9.0), "uv_index": F.lit(6.0)}
    corrected = rows.filter("city = 'Patagonia' and year = 2025").withColumns(normal)
    write_table(corrected, stored, layout)
    refresh.refresh_gold(read_table(spark, stored, rows.schema), root, refresh.touched_months(corrected))
    return round_doubles(read_table(spark, f"{root}/condiciones_criticas"))


LATEST = f"""deliveries AS (
  SELECT *, dt * 1000 + event_id % 7 AS emitted, 1 AS delivery FROM weather
  UNION ALL SELECT * REPLACE (temp + 1 AS temp), dt * 1000 + event_id % 7 + {HOUR_MS} AS emitted, 2 AS delivery
  FROM weather WHERE event_id % 10 = 3
), latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, lat, lon ORDER BY delivery DESC, {TIE_ORDER}) AS copy FROM deliveries)
  WHERE copy = 1
)"""


def _two_deliveries(spark, sf_dir):
    """All observations, then a tenth of them again with another temperature; the second delivery comes twice."""
    rows = weather(spark, sf_dir, two_years=True)
    fixed = rows.filter(F.col("event_id") % 10 == 3).withColumn("temp", F.col("temp") + 1)
    second = _history_rows(spark, envelopes(fixed, HOUR_MS))
    return _history_rows(spark, envelopes(rows)), second, second


@case(
    with_more(
        LATEST,
        "SELECT dt, city, lat, lon, temp, pressure, humidity, clouds, wind_speed, wind_deg, year, month, delivery FROM latest",
        two_years=True,
    )
)
def history_late_correction(spark, sf_dir):
    """History after corrections of a later delivery, and a repeat that changes nothing."""
    history = fresh_path(spark, "history")
    reports = [jobs.consolidate(delivered, history, corrections=True) for delivered in _two_deliveries(spark, sf_dir)]
    assert reports[1]["corrected"] > 0 and reports[2]["corrected"] == reports[2]["rows"] == 0
    names = ["dt", "city", "lat", "lon", "temp", "pressure", "humidity", "clouds", "wind_speed", "wind_deg", "year", "month"]
    later = F.unix_millis("ingestion_timestamp") - F.col("dt") * 1000 >= HOUR_MS
    return read_table(spark, history, HISTORY_TABLE).select(*names, F.when(later, 2).otherwise(1).alias("delivery"))


@case(
    with_more(
        LATEST,
        f"""SELECT city, year, month, {r("avg(temp)")} AS temperatura_promedio, count(*) AS total_mediciones FROM latest
        GROUP BY city, year, month""",
        two_years=True,
    )
)
def gold_late_correction(spark, sf_dir):
    """The same corrections in the monthly comparison, by way of Silver."""
    history, path, root = (fresh_path(spark, name) for name in ("history", "silver", "gold"))
    for delivered in _two_deliveries(spark, sf_dir)[:2]:
        jobs.update_from_landing(spark, delivered, history, path, root, corrections=True)
    found = read_table(spark, f"{root}/analisis_comparativo")
    return round_doubles(found.select("city", "year", "month", "temperatura_promedio", "total_mediciones"))
