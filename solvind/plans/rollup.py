"""Sums, counts and maxima of weather measures per site and day or month.

A mean is sum / count, so a day rollup can be merged into months without going back to Silver. The
wind, comparison and ranking tables share one day rollup; a reader of one table only pays for the
measures it selects, because Catalyst prunes unused aggregates. The period is one date column: a short
grouping key, spelled out into year, month and day only after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solvind.functions import energy
from solvind.functions.calendar import month_start, observed_day

PERIOD = "_period"
MAXIMA = ("power", "speed", "uv")


def measures() -> dict[str, Column]:
    speed, uv, clouds = F.col("wind_speed"), F.col("uv_index"), F.col("clouds")
    return {
        "power": energy.wind_power(F.col("pressure"), F.col("temp"), speed),
        "speed": speed,
        "direction": F.col("wind_deg"),
        "uv": uv,
        "clouds": clouds,
        "temp": F.col("temp"),
        "humidity": F.col("humidity"),
        "pressure": F.col("pressure"),
        "solar_estimate": energy.clear_sky_uv(uv, clouds),
        "wind_estimate": energy.wind_index(speed),
    }


def _rollup(silver: DataFrame, period: Column) -> DataFrame:
    values = measures()
    rows = silver.select(
        "city", period.alias(PERIOD), *(value.cast("double").alias(f"_{name}") for name, value in values.items())
    )
    sums = [F.sum(f"_{name}").alias(f"sum_{name}") for name in values]
    counts = [F.count(f"_{name}").alias(f"n_{name}") for name in values]
    maxima = [F.max(f"_{name}").alias(f"max_{name}") for name in MAXIMA]
    return rows.groupBy("city", PERIOD).agg(F.count(F.lit(1)).alias("n_rows"), *sums, *counts, *maxima)


def by_day(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    return _rollup(silver, observed_day(F.col("dt"), tz))


def by_month(silver: DataFrame, tz: str = "UTC") -> DataFrame:
    return _rollup(silver, month_start(observed_day(F.col("dt"), tz)))


def days_to_months(daily: DataFrame) -> DataFrame:
    added = [name for name in daily.columns if name.startswith(("sum_", "n_"))]
    largest = [name for name in daily.columns if name.startswith("max_")]
    return daily.groupBy("city", month_start(F.col(PERIOD)).alias(PERIOD)).agg(
        *(F.sum(name).alias(name) for name in added), *(F.max(name).alias(name) for name in largest)
    )


def mean(name: str) -> Column:
    return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))


def period_columns(*parts: str) -> list[Column]:
    """`city` plus the named parts (date, year, month, day) of the rollup period."""
    period = F.col(PERIOD)
    spelled = {
        "date": F.date_format(period, "yyyy-MM-dd"),
        "year": F.year(period),
        "month": F.month(period),
        "day": F.dayofmonth(period),
    }
    return [F.col("city"), *(spelled[part].alias(part) for part in parts)]
