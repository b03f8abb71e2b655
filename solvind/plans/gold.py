"""The five published Gold tables. Column names are part of the contract with report readers.

No table is sorted before it is written: a partitioned write does not keep a global order. Sort on read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.functions import conditions, energy
from solvind.functions.calendar import epoch_to_timestamp, hour_of_day, hour_start, month_start, observed_day
from solvind.operators.layout import stage, write_table
from solvind.operators.ranking import LABELLED_DAYS, day_label, rank_both_ways
from solvind.plans.rollup import PERIOD, by_day, by_month, days_to_months, mean, period_columns

DAY = ("date", "year", "month", "day")
DAY_ROLLUP = "rollup_dias"
ROLLUP_PARTITIONS = ("year", "month")


def potencial_solar(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """Solar potential per site and hour."""
    start = hour_start(F.col("dt"), tz)
    potential = energy.solar_kwh(F.col("uv_index"), F.col("clouds"), hour_of_day(start))
    rows = silver.select("city", start.alias("_start"), potential.alias("_potential"), "uv_index", "clouds", "temp")
    hourly = rows.groupBy("city", "_start").agg(
        F.avg("_potential").alias("potencial_solar_promedio"),
        F.max("_potential").alias("potencial_solar_maximo"),
        F.avg("uv_index").alias("uv_index_promedio"),
        F.avg("clouds").alias("nubosidad_promedio"),
        F.avg("temp").alias("temperatura_promedio"),
    )
    day = epoch_to_timestamp(F.col("_start")).cast("date")
    return hourly.select(
        "city",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        hour_of_day(F.col("_start")).alias("hour"),
        "potencial_solar_promedio",
        "potencial_solar_maximo",
        "uv_index_promedio",
        "nubosidad_promedio",
        "temperatura_promedio",
    )


def wind_from_days(daily: DataFrame) -> DataFrame:
    return daily.select(
        *period_columns("year", "month", "day"),
        mean("power").alias("potencial_eolico_promedio_w"),
        F.col("max_power").alias("potencial_eolico_maximo_w"),
        mean("speed").alias("velocidad_viento_promedio"),
        F.col("max_speed").alias("velocidad_viento_maxima_ms"),
        mean("direction").alias("direccion_viento_promedio"),
        F.col("n_rows").alias("mediciones"),
    )


def potencial_eolico(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """Wind power per site and day. The direction is the arithmetic mean the published table has;
    `wind_direction` gives the circular one."""
    return wind_from_days(by_day(silver, tz))


def wind_direction(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """Circular mean wind direction per site and day, next to the arithmetic one."""
    angle = F.radians(F.col("wind_deg").cast("double"))
    day = observed_day(F.col("dt"), tz).alias(PERIOD)
    rows = silver.select("city", day, "wind_deg", F.sin(angle).alias("_sin"), F.cos(angle).alias("_cos"))
    means = rows.groupBy("city", PERIOD).agg(
        F.avg("wind_deg").alias("direccion_viento_promedio"), F.avg("_sin").alias("_sin"), F.avg("_cos").alias("_cos")
    )
    return means.select(
        *period_columns("year", "month", "day"),
        "direccion_viento_promedio",
        energy.circular_mean_degrees(F.col("_sin"), F.col("_cos")).alias("direccion_viento_circular"),
    )


def classify(silver: DataFrame) -> DataFrame:
    """Add the three condition labels."""
    clouds = F.col("clouds")
    labels = (
        conditions.solar_reason(clouds, F.col("uv_index")),
        conditions.wind_reason(F.col("wind_speed")),
        conditions.adverse(F.col("humidity"), clouds, F.col("temp")),
    )
    return silver.withColumns(dict(zip(conditions.LABEL_COLUMNS, labels)))


def condiciones_criticas(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """How often each combination of output-reducing conditions occurs per site and month."""
    labels = conditions.LABEL_COLUMNS
    rows = classify(silver).withColumn(PERIOD, month_start(observed_day(F.col("dt"), tz)))
    counted = rows.groupBy("city", PERIOD, *labels).agg(
        F.count(F.lit(1)).alias("ocurrencias"),
        F.avg("temp").alias("temperatura_promedio"),
        F.avg("humidity").alias("humedad_promedio"),
        F.avg("clouds").alias("nubosidad_promedio"),
        F.avg("wind_speed").alias("viento_promedio"),
    )
    reduced = counted.filter(conditions.any_reduction())
    return reduced.select(
        *period_columns("year", "month"),
        *labels,
        "ocurrencias",
        "temperatura_promedio",
        "humedad_promedio",
        "nubosidad_promedio",
        "viento_promedio",
    )


def _comparison(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        *period_columns("year", "month"),
        mean("solar_estimate").alias("potencial_solar_promedio"),
        F.col("max_uv").alias("uv_index_maximo"),
        mean("clouds").alias("nubosidad_promedio"),
        mean("wind_estimate").alias("potencial_eolico_promedio"),
        mean("speed").alias("velocidad_viento_promedio"),
        F.col("max_speed").alias("velocidad_viento_maxima"),
        mean("temp").alias("temperatura_promedio"),
        mean("humidity").alias("humedad_promedio"),
        mean("pressure").alias("presion_promedio"),
        F.col("n_rows").alias("total_mediciones"),
    )


def analisis_comparativo(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """Monthly comparison of sites."""
    return _comparison(by_month(silver, tz))


def comparison_from_days(daily: DataFrame) -> DataFrame:
    return _comparison(days_to_months(daily))


def _scores(daily: DataFrame) -> DataFrame:
    means = daily.select(
        *period_columns(*DAY),
        mean("uv").alias("uv_promedio"),
        mean("speed").alias("viento_promedio"),
        mean("clouds").alias("nubosidad_promedio"),
        mean("temp").alias("temperatura_promedio"),
    )
    solar = energy.clear_sky_uv(F.col("uv_promedio"), F.col("nubosidad_promedio"))
    wind = energy.wind_score(F.col("viento_promedio"))
    scored = means.withColumns({"score_solar": solar, "score_eolico": wind})
    return scored.withColumn("score_total", F.round(F.col("score_solar") + F.col("score_eolico"), 2))


def daily_scores(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    """Day means and the solar, wind and total score of each site and day."""
    return _scores(by_day(silver, tz))


def ranking_from_days(daily: DataFrame, n: int = LABELLED_DAYS, drop_null_scores: bool = False) -> DataFrame:
    scored = _scores(daily)
    if drop_null_scores:
        scored = scored.filter(F.col("score_total").isNotNull())
    # A group holds one row per calendar day of a site, so sorting it in one task is bounded.
    ranked = rank_both_ways(scored, ["city"], "score_total", "date")
    listed = ranked.filter((F.col("rank_mejor") <= n) | (F.col("rank_peor") <= n))
    return listed.withColumn("tipo_dia", day_label(n)).select(
        "city",
        *DAY,
        "score_total",
        "score_solar",
        "score_eolico",
        "uv_promedio",
        "viento_promedio",
        "nubosidad_promedio",
        "temperatura_promedio",
        "tipo_dia",
        "rank_mejor",
        "rank_peor",
    )


def ranking_dias(
    silver: DataFrame, n: int = LABELLED_DAYS, tz: str = "UTC", drop_null_scores: bool = False
) -> DataFrame:
    """The n best and n worst days per site. Equal scores rank by date; days without a score are worst."""
    return ranking_from_days(by_day(silver, tz), n, drop_null_scores)


@dataclass(frozen=True)
class GoldTable:
    partition_by: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    from_days: Callable[[DataFrame], DataFrame] | None = None


GOLD_TABLES = {
    "potencial_solar": GoldTable(("city", "year", "month"), potencial_solar),
    "potencial_eolico": GoldTable(("city", "year", "month"), potencial_eolico, wind_from_days),
    "condiciones_criticas": GoldTable(("city", "year"), condiciones_criticas),
    "analisis_comparativo": GoldTable(
        ("year", "month"), analisis_comparativo, comparison_from_days
    ),
    "ranking_dias": GoldTable(("city", "year"), ranking_dias, ranking_from_days),
}


def gold_frames(silver: DataFrame, daily: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five tables; those that can come from a day rollup do, when one is given."""
    return {
        name: table.from_days(daily) if daily is not None and table.from_days else table.build(silver)
        for name, table in GOLD_TABLES.items()
    }


def _stored_days(silver: DataFrame) -> DataFrame:
    period = F.col(PERIOD)
    return by_day(silver).withColumns({"year": F.year(period), "month": F.month(period)})


def write_day_rollup(silver: DataFrame, root: str) -> None:
    """Store the day rollup of these rows beside the Gold tables."""
    write_table(_stored_days(silver), f"{root}/{DAY_ROLLUP}", ROLLUP_PARTITIONS, dynamic=False)


def refresh_day_rollup(silver: DataFrame, kept: DataFrame, root: str) -> None:
    """Replace months of the stored rollup by the days of these rows and by `kept`, its days of other sites."""
    days, _ = stage(_stored_days(silver).unionByName(kept), "days")
    write_table(days, f"{root}/{DAY_ROLLUP}", ROLLUP_PARTITIONS)


def read_day_rollup(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{DAY_ROLLUP}")


def write_gold(silver: DataFrame, root: str) -> dict[str, int]:
    """Write all Gold tables under `root`; returns rows per table.

    Three passes over Silver for five tables: hours, labels, and one day rollup (a row per site and day)
    that is stored and feeds the wind, comparison and ranking tables, now and in later refreshes.
    """
    write_day_rollup(silver, root)
    frames = gold_frames(silver, read_day_rollup(silver.sparkSession, root))
    return {
        name: write_table(frame, f"{root}/{name}", GOLD_TABLES[name].partition_by, dynamic=False)["rows"]
        for name, frame in frames.items()
    }
