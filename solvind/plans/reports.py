"""Reporting queries over the Gold tables. Each returns a frame; only the chart's few rows leave Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.operators.sampling import hash_sample

# Hourly solar rows are unique on these.
SOLAR_KEY = ("city", "year", "month", "day", "hour")
SCATTER_ROWS = 5_000


def kpis(solar: DataFrame, wind: DataFrame, ranking: DataFrame) -> DataFrame:
    """One row: ranked days, mean solar potential, mean wind speed, number of sites."""
    # Sites first: the distinct count then runs over one row per site.
    sites = solar.groupBy("city").agg(
        F.sum("potencial_solar_promedio").alias("_sum"), F.count("potencial_solar_promedio").alias("_n")
    )
    solar_facts = sites.agg(
        F.struct(
            F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean"), F.count(F.lit(1)).alias("sites")
        )
    ).scalar()
    wind_mean = wind.agg(F.avg("velocidad_viento_promedio")).scalar()
    return ranking.agg(F.count_distinct("date").alias("dias_en_ranking")).select(
        "dias_en_ranking",
        solar_facts["mean"].alias("solar_promedio"),
        wind_mean.alias("viento_promedio"),
        solar_facts["sites"].alias("ubicaciones"),
    )


def selectors(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values for a selection box."""
    return df.select(column).distinct().orderBy(column)


def solar_by_hour(solar: DataFrame, city: str, month: int) -> DataFrame:
    """Mean of the hourly means for one site and month (all years)."""
    chosen = solar.filter((F.col("city") == city) & (F.col("month") == month))
    return chosen.groupBy("hour").agg(F.avg("potencial_solar_promedio").alias("potencial_solar_promedio"))


def wind_by_month(wind: DataFrame) -> DataFrame:
    """Mean wind speed by site and calendar month; years are pooled."""
    return wind.groupBy("city", "month").agg(
        F.avg("velocidad_viento_promedio").alias("velocidad_viento_promedio")
    )


def wind_box(wind: DataFrame, approximate: bool = False) -> DataFrame:
    """Five-number summary of daily wind speed per site. Exact quartiles keep the distinct day means of
    one site, so they are bounded by the calendar; `approximate` needs constant memory."""
    speed = F.col("velocidad_viento_promedio")

    def quantile(share: float):
        return F.percentile_approx(speed, share) if approximate else F.percentile(speed, share)

    return wind.groupBy("city").agg(
        F.min(speed).alias("minimo"),
        quantile(0.25).alias("q1"),
        quantile(0.5).alias("mediana"),
        quantile(0.75).alias("q3"),
        F.max(speed).alias("maximo"),
        F.count(speed).alias("dias"),
    )


def scatter_sample(solar: DataFrame, n: int = SCATTER_ROWS, seed: int = 1) -> DataFrame:
    """Cloud cover against solar potential: a repeatable sample of up to n hours."""
    sample = hash_sample(solar, n, SOLAR_KEY, seed)
    return sample.select(*SOLAR_KEY, "nubosidad_promedio", "potencial_solar_promedio")


def critical_by_month(critical: DataFrame) -> DataFrame:
    """Stacked occurrences by site, month and solar reason."""
    return critical.groupBy("city", "month", "reduccion_solar").agg(F.sum("ocurrencias").alias("ocurrencias"))


def city_comparison(comparison: DataFrame) -> DataFrame:
    """The three monthly series shown side by side."""
    return comparison.select(
        "city",
        "year",
        "month",
        "potencial_solar_promedio",
        "velocidad_viento_promedio",
        "potencial_eolico_promedio",
    ).orderBy("year", "month", "city")


def ranking_city(ranking: DataFrame, city: str) -> DataFrame:
    """Listed days of one site with their label and total score, best first."""
    chosen = ranking.filter(F.col("city") == city).select("date", "tipo_dia", "score_total")
    return chosen.orderBy(F.col("score_total").desc_nulls_last(), "date")


def ranking_detail(ranking: DataFrame, city: str) -> DataFrame:
    """Detail table behind the ranking chart, best day first."""
    chosen = ranking.filter(F.col("city") == city).select(
        "date",
        "tipo_dia",
        "score_total",
        "score_solar",
        "score_eolico",
        "uv_promedio",
        "viento_promedio",
        "nubosidad_promedio",
    )
    return chosen.orderBy(F.col("score_total").desc_nulls_last(), "date")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)
