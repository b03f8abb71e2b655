"""Gold tables and the formulas behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.base import (
    ADVERSE,
    DENSITY,
    FACTOR,
    POWER,
    SOLAR,
    SOLAR_REASON,
    WIND_REASON,
    case,
    over_gold,
    over_weather,
    r,
    round_doubles,
    silver,
    weather,
    with_more,
)
from solvind.functions import energy
from solvind.functions.calendar import add_time_parts
from solvind.operators import ranking
from solvind.plans import gold as plans

SOLAR_COLUMNS = f"""city, year, month, day, hour, {r("potencial_solar_promedio")} AS potencial_solar_promedio,
  potencial_solar_maximo, {r("uv_index_promedio")} AS uv_index_promedio,
  {r("nubosidad_promedio")} AS nubosidad_promedio, {r("temperatura_promedio")} AS temperatura_promedio"""

RANKING_MEANS = ", ".join(
    f"{r(name)} AS {name}"
    for name in (
        "score_solar",
        "score_eolico",
        "uv_promedio",
        "viento_promedio",
        "nubosidad_promedio",
        "temperatura_promedio",
    )
)


@case(over_gold(f"SELECT {SOLAR_COLUMNS} FROM potencial_solar"))
def gold_potencial_solar(spark, sf_dir):
    return round_doubles(plans.potencial_solar(silver(spark, sf_dir)))


@case(
    over_gold(
        f"""SELECT city, year, month, day, {r("potencial_eolico_promedio_w")} AS potencial_eolico_promedio_w,
        potencial_eolico_maximo_w, {r("velocidad_viento_promedio")} AS velocidad_viento_promedio,
        velocidad_viento_maxima_ms, {r("direccion_viento_promedio")} AS direccion_viento_promedio, mediciones
        FROM potencial_eolico"""
    )
)
def gold_potencial_eolico(spark, sf_dir):
    return round_doubles(plans.potencial_eolico(silver(spark, sf_dir)))


@case(
    over_gold(
        f"""SELECT city, year, month, reduccion_solar, reduccion_eolica, condicion_adversa, ocurrencias,
        {r("temperatura_promedio")} AS temperatura_promedio, {r("humedad_promedio")} AS humedad_promedio,
        {r("nubosidad_promedio")} AS nubosidad_promedio, {r("viento_promedio")} AS viento_promedio
        FROM condiciones_criticas"""
    )
)
def gold_condiciones_criticas(spark, sf_dir):
    return round_doubles(plans.condiciones_criticas(silver(spark, sf_dir)))


COMPARISON_MEANS = ", ".join(
    f"{r(name)} AS {name}"
    for name in (
        "potencial_solar_promedio",
        "nubosidad_promedio",
        "potencial_eolico_promedio",
        "velocidad_viento_promedio",
        "temperatura_promedio",
        "humedad_promedio",
        "presion_promedio",
    )
)


@case(
    over_gold(
        f"""SELECT city, year, month, {COMPARISON_MEANS}, uv_index_maximo, velocidad_viento_maxima,
        total_mediciones FROM analisis_comparativo""",
        two_years=True,
    )
)
def gold_analisis_comparativo(spark, sf_dir):
    return round_doubles(plans.analisis_comparativo(silver(spark, sf_dir, two_years=True)))


@case(
    over_gold(
        f"""SELECT city, date, year, month, day, score_total, {RANKING_MEANS}, tipo_dia, rank_mejor, rank_peor
        FROM ranking_dias"""
    )
)
def gold_ranking_dias(spark, sf_dir):
    return round_doubles(plans.ranking_dias(silver(spark, sf_dir)))


@case(over_gold(f"SELECT city, date, year, month, day, score_total, {RANKING_MEANS} FROM daily_scores"))
def daily_scores(spark, sf_dir):
    return round_doubles(plans.daily_scores(silver(spark, sf_dir)))


@case(over_weather(f"SELECT event_id, hour, {FACTOR} AS factor FROM weather"))
def solar_hour_factor(spark, sf_dir):
    rows = add_time_parts(weather(spark, sf_dir))
    return rows.select("event_id", "hour", energy.hour_factor(F.col("hour")).alias("factor"))


@case(over_weather(f"SELECT event_id, {SOLAR} AS potencial FROM weather"))
def solar_potential(spark, sf_dir):
    rows = add_time_parts(weather(spark, sf_dir))
    potential = energy.solar_kwh(F.col("uv_index"), F.col("clouds"), F.col("hour"))
    return rows.select("event_id", potential.alias("potencial"))


@case(over_weather(f"SELECT event_id, {r(DENSITY)} AS densidad, {POWER} AS potencia FROM weather"))
def wind_power(spark, sf_dir):
    pressure, temp, speed = F.col("pressure"), F.col("temp"), F.col("wind_speed")
    return weather(spark, sf_dir).select(
        "event_id",
        F.round(energy.air_density(pressure, temp), 6).alias("densidad"),
        energy.wind_power(pressure, temp, speed).alias("potencia"),
    )


@case(
    over_weather(
        f"""SELECT city, year, month, day, {r("avg(wind_deg)")} AS direccion_viento_promedio,
        {r('''((degrees(atan2(avg(sin(radians(CAST(wind_deg AS DOUBLE)))),
          avg(cos(radians(CAST(wind_deg AS DOUBLE)))))) + 360.0E0) % 360.0E0)''')} AS direccion_viento_circular
        FROM weather GROUP BY city, year, month, day"""
    )
)
def wind_direction_circular(spark, sf_dir):
    return round_doubles(plans.wind_direction(silver(spark, sf_dir)))


@case(
    over_weather(
        f"""SELECT event_id, {SOLAR_REASON} AS reduccion_solar, {WIND_REASON} AS reduccion_eolica,
        {ADVERSE} AS condicion_adversa FROM weather"""
    )
)
def classify_conditions(spark, sf_dir):
    return plans.classify(weather(spark, sf_dir)).select("event_id", *plans.conditions.LABEL_COLUMNS)


@case(
    with_more(
        """readings AS (
          SELECT city, event_id, wind_speed,
            CAST(row_number() OVER (PARTITION BY city ORDER BY wind_speed DESC NULLS LAST, event_id) AS INTEGER)
              AS rank_mejor,
            CAST(row_number() OVER (PARTITION BY city ORDER BY wind_speed NULLS FIRST, event_id DESC) AS INTEGER)
              AS rank_peor
          FROM weather)""",
        "SELECT * FROM readings WHERE rank_mejor <= 10 OR rank_peor <= 10",
    )
)
def top_bottom_n(spark, sf_dir):
    readings = weather(spark, sf_dir).select("city", "event_id", "wind_speed")
    return ranking.top_bottom_n(readings, ["city"], "wind_speed", "event_id", 10)
