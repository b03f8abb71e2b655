"""Reporting queries and documented SQL over Gold and Silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.base import CITIES, SILVER_LIST, case, over_gold, over_weather, r, round_doubles, silver
from acceptance.lake import registered_silver
from solvind.functions.calendar import add_time_parts
from solvind.plans import catalog, gold, reports
from solvind.schemas import SILVER

CITY = CITIES[0]


@case(
    over_gold(
        f"""SELECT (SELECT count(DISTINCT date) FROM ranking_dias) AS dias_en_ranking,
        (SELECT {r("avg(potencial_solar_promedio)")} FROM potencial_solar) AS solar_promedio,
        (SELECT {r("avg(velocidad_viento_promedio)")} FROM potencial_eolico) AS viento_promedio,
        (SELECT count(DISTINCT city) FROM potencial_solar) AS ubicaciones"""
    )
)
def bi_kpis(spark, sf_dir):
    rows = silver(spark, sf_dir)
    frames = gold.potencial_solar(rows), gold.potencial_eolico(rows), gold.ranking_dias(rows)
    return round_doubles(reports.kpis(*frames))


@case(
    over_gold(
        f"""SELECT 'city' AS selector, city AS valor FROM potencial_solar GROUP BY city
        UNION ALL SELECT 'month', CAST(month AS VARCHAR) FROM potencial_solar GROUP BY month
        UNION ALL SELECT 'ranking', city FROM ranking_dias GROUP BY city"""
    )
)
def bi_selectors(spark, sf_dir):
    rows = silver(spark, sf_dir)
    solar, ranking = gold.potencial_solar(rows), gold.ranking_dias(rows)
    boxes = {"city": (solar, "city"), "month": (solar, "month"), "ranking": (ranking, "city")}
    first, *others = (
        reports.selectors(frame, column).select(F.lit(name).alias("selector"), F.col(column).cast("string").alias("valor"))
        for name, (frame, column) in boxes.items()
    )
    for other in others:
        first = first.unionByName(other)
    return first


@case(
    over_gold(
        f"""SELECT hour, {r("avg(potencial_solar_promedio)")} AS potencial_solar_promedio FROM potencial_solar
        WHERE city = '{CITY}' AND month = 1 GROUP BY hour""",
        two_years=True,
    )
)
def bi_solar_by_hour(spark, sf_dir):
    return round_doubles(reports.solar_by_hour(gold.potencial_solar(silver(spark, sf_dir, two_years=True)), CITY, 1))


@case(
    over_gold(
        f"""SELECT city, month, {r("avg(velocidad_viento_promedio)")} AS velocidad_viento_promedio
        FROM potencial_eolico GROUP BY city, month""",
        two_years=True,
    )
)
def bi_wind_by_month(spark, sf_dir):
    return round_doubles(reports.wind_by_month(gold.potencial_eolico(silver(spark, sf_dir, two_years=True))))


@case(
    over_gold(
        f"""SELECT city, {r("min(velocidad_viento_promedio)")} AS minimo,
        {r("quantile_cont(velocidad_viento_promedio, 0.25)")} AS q1,
        {r("quantile_cont(velocidad_viento_promedio, 0.5)")} AS mediana,
        {r("quantile_cont(velocidad_viento_promedio, 0.75)")} AS q3,
        {r("max(velocidad_viento_promedio)")} AS maximo, count(velocidad_viento_promedio) AS dias
        FROM potencial_eolico GROUP BY city"""
    )
)
def bi_wind_box(spark, sf_dir):
    return round_doubles(reports.wind_box(gold.potencial_eolico(silver(spark, sf_dir))))


@case(
    over_gold(
        """SELECT city, month, reduccion_solar, CAST(sum(ocurrencias) AS BIGINT) AS ocurrencias
        FROM condiciones_criticas GROUP BY city, month, reduccion_solar""",
        two_years=True,
    )
)
def bi_critical_by_month(spark, sf_dir):
    return reports.critical_by_month(gold.condiciones_criticas(silver(spark, sf_dir, two_years=True)))


@case(
    over_gold(
        f"""SELECT city, year, month, {r("potencial_solar_promedio")} AS potencial_solar_promedio,
        {r("velocidad_viento_promedio")} AS velocidad_viento_promedio,
        {r("potencial_eolico_promedio")} AS potencial_eolico_promedio FROM analisis_comparativo""",
        two_years=True,
    )
)
def bi_city_comparison(spark, sf_dir):
    return round_doubles(reports.city_comparison(gold.analisis_comparativo(silver(spark, sf_dir, two_years=True))))


@case(over_gold(f"SELECT date, tipo_dia, score_total FROM ranking_dias WHERE city = '{CITY}'"))
def bi_ranking_city(spark, sf_dir):
    return reports.ranking_city(gold.ranking_dias(silver(spark, sf_dir)), CITY)


DETAIL_MEANS = ", ".join(
    f"{r(name)} AS {name}"
    for name in ("score_solar", "score_eolico", "uv_promedio", "viento_promedio", "nubosidad_promedio")
)


@case(over_gold(f"SELECT date, tipo_dia, score_total, {DETAIL_MEANS} FROM ranking_dias WHERE city = '{CITY}'"))
def bi_ranking_detail(spark, sf_dir):
    return round_doubles(reports.ranking_detail(gold.ranking_dias(silver(spark, sf_dir)), CITY))


SCATTER_ROWS = 500


@case(
    over_gold(
        f"""SELECT city, year, month, day, hour, {r("nubosidad_promedio")} AS nubosidad_promedio,
        {r("potencial_solar_promedio")} AS potencial_solar_promedio FROM potencial_solar
        ORDER BY md5(concat_ws('|', '1', city, year, month, day, hour)) LIMIT {SCATTER_ROWS}"""
    )
)
def bi_scatter_sample(spark, sf_dir):
    return round_doubles(reports.scatter_sample(gold.potencial_solar(silver(spark, sf_dir)), SCATTER_ROWS))


def _view(spark, sf_dir, name: str, two_years: bool = True) -> str:
    """Silver with its time parts, as the documented queries expect it."""
    rows = add_time_parts(silver(spark, sf_dir, two_years)).select(*SILVER.fieldNames(), "year", "month", "day")
    rows.createOrReplaceTempView(name)
    return name


@case(
    over_weather(
        f"SELECT city, {r('avg(temp)')} AS temp_promedio FROM weather WHERE year = 2025 AND month = 1 GROUP BY city",
        two_years=True,
    )
)
def sql_avg_temp_by_city(spark, sf_dir):
    return round_doubles(catalog.avg_temp_by_city(spark, registered_silver(spark, sf_dir, "averaged"), 2025, 1))


@case(over_weather("SELECT city, count(*) AS total FROM weather GROUP BY city"))
def sql_count_by_city(spark, sf_dir):
    return catalog.count_by_city(spark, _view(spark, sf_dir, "weather_for_count"))


SITE_MONTH = f"city = '{CITY}' AND year = 2025 AND month = 1"


@case(over_weather(f"SELECT {SILVER_LIST}, year, month FROM weather WHERE {SITE_MONTH}", two_years=True))
def sql_partition_filter(spark, sf_dir):
    return catalog.partition_rows(spark, registered_silver(spark, sf_dir, "filtered"), CITY, 2025, 1)


@case(
    over_weather(
        f"""SELECT {SILVER_LIST}, year, month FROM weather WHERE {SITE_MONTH}
        ORDER BY dt, lat, lon, temp, pressure, humidity, clouds, wind_speed, wind_deg, uv_index NULLS FIRST LIMIT 10""",
        two_years=True,
    )
)
def sql_partition_limit(spark, sf_dir):
    return catalog.partition_head(spark, registered_silver(spark, sf_dir, "headed"), CITY, 2025, 1)


@case(over_gold(f"SELECT city, score_total, date FROM ranking_dias WHERE city = '{CITY}'"))
def governed_view(spark, sf_dir):
    ranking = gold.ranking_dias(silver(spark, sf_dir))
    return catalog.governed_view(ranking, "ranking_riohacha", ["city", "score_total", "date"], F.col("city") == CITY)
