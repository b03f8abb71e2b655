import math

import pytest
from pyspark.sql import functions as F

from solvind.functions import conditions, energy
from solvind.functions.calendar import add_ingestion_partitions, add_time_parts, hour_of_day, hour_start
from solvind.functions.rounding import round_half_up
from tests.support import epoch, silver_rows, values


def one(spark, schema, rows, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(("hour", "factor"), [(0, 0), (5, 0), (6, 0.5), (9, 0.75), (12, 1), (18, 0.5), (19, 0)])
def test_hour_factor(spark, hour, factor):
    assert one(spark, "h int", [(hour,)], energy.hour_factor(F.col("h"))) == [factor]


def test_hour_factor_of_null_is_zero(spark):
    assert one(spark, "h int", [(None,)], energy.hour_factor(F.col("h"))) == [0.0]


@pytest.mark.parametrize(
    ("uv", "clouds", "hour", "expected"),
    [(10.7, 75, 12, 2.68), (0.25, 50, 12, 0.13), (8.0, 20, 6, 3.2), (8.0, 20, 5, 0.0), (None, 20, 12, None), (8.0, None, 12, None)],
)
def test_solar_is_rounded_half_up(spark, uv, clouds, hour, expected):
    column = energy.solar_kwh(F.col("uv"), F.col("clouds"), F.col("hour"))
    assert one(spark, "uv double, clouds int, hour int", [(uv, clouds, hour)], column) == [expected]


def test_fast_rounding_equals_round(spark):
    """Ties, neighbours of ties, negatives, large and special values, and a random spread."""
    special = [0.0, -0.0, 2.675, 0.125, -0.125, 1.005, -1.005, 0.005, -0.005, 0.0049999999999, 1e-9, 1e11 + 0.005]
    special += [1e300, -1e300, float("inf"), float("-inf"), float("nan"), None, 123456789.985, 4.35, 8.345, 1e15 + 0.3]
    special += [math.nextafter(tie, side) for tie in (0.125, 2.675, 0.375) for side in (-math.inf, math.inf)]
    literal = spark.createDataFrame([(value,) for value in special], "v double")
    spread = spark.range(200_000).select(((F.rand(3) - 0.5) * F.pow(F.lit(10.0), F.col("id") % 12 - 2)).alias("v"))
    halves = spark.range(20_000).select(((F.col("id") - 10_000) / 200 + 0.005).alias("v"))
    for values_ in (literal, spread, halves):
        differing = values_.filter(~round_half_up(F.col("v")).eqNullSafe(F.round("v", 2)))
        assert differing.collect() == []


def test_air_density_and_wind_power(spark):
    schema, row = "p int, t double, v double", (1013, 15.0, 10.0)
    density = 1013 * 100.0 / (287.05 * (15.0 + 273.15))
    p, t, v = F.col("p"), F.col("t"), F.col("v")
    assert one(spark, schema, [row], energy.air_density(p, t))[0] == pytest.approx(density)
    assert one(spark, schema, [row], energy.wind_power(p, t, v)) == [round(0.5 * density * 1000, 2)]


def test_density_at_absolute_zero_is_null(spark):
    column = energy.air_density(F.col("p"), F.col("t"))
    assert one(spark, "p int, t double", [(1013, -273.15), (None, 15.0)], column) == [None, None]


@pytest.mark.parametrize(
    ("clouds", "uv", "label"),
    [
        (80, 5.0, "Normal"),
        (81, 5.0, "Alta nubosidad"),
        (81, 1.0, "Alta nubosidad"),
        (80, 1.9, "UV bajo"),
        (80, 2.0, "Normal"),
        (None, 1.9, "UV bajo"),
        (None, None, "Normal"),
        (20, None, "Normal"),
    ],
)
def test_solar_reason(spark, clouds, uv, label):
    column = conditions.solar_reason(F.col("c"), F.col("u"))
    assert one(spark, "c int, u double", [(clouds, uv)], column) == [label]


@pytest.mark.parametrize(
    ("speed", "label"),
    [
        (2.9, "Viento insuficiente"),
        (3.0, "Normal"),
        (25.0, "Normal"),
        (25.1, "Viento excesivo (peligro)"),
        (None, "Normal"),
    ],
)
def test_wind_reason(spark, speed, label):
    assert one(spark, "v double", [(speed,)], conditions.wind_reason(F.col("v"))) == [label]


@pytest.mark.parametrize(
    ("humidity", "clouds", "temp", "label"),
    [
        (85, 81, 20.0, "Normal"),
        (86, 80, 20.0, "Normal"),
        (86, 81, 41.0, "Lluvia probable"),
        (50, 50, 40.0, "Normal"),
        (50, 50, 40.1, "Calor extremo"),
        (50, 50, 0.0, "Normal"),
        (50, 50, -0.1, "Congelamiento"),
        (None, 90, -5.0, "Congelamiento"),
        (None, None, None, "Normal"),
    ],
)
def test_adverse(spark, humidity, clouds, temp, label):
    column = conditions.adverse(F.col("h"), F.col("c"), F.col("t"))
    assert one(spark, "h int, c int, t double", [(humidity, clouds, temp)], column) == [label]


def test_circular_mean_crosses_north(spark):
    angles = spark.createDataFrame([(359.0,), (1.0,)], "a double")
    means = angles.agg(F.avg(F.sin(F.radians("a"))).alias("s"), F.avg(F.cos(F.radians("a"))).alias("c"))
    (mean,) = [row[0] for row in means.select(energy.circular_mean_degrees(F.col("s"), F.col("c"))).collect()]
    assert 0 <= mean < 360
    assert min(mean, 360 - mean) == pytest.approx(0, abs=1e-9)
    assert math.isclose(angles.agg(F.avg("a")).first()[0], 180)


def test_time_parts_in_utc_and_at_the_site(spark):
    rows = silver_rows(spark, {"dt": epoch(2024, 3, 1, 2)})
    columns = ("year", "month", "day", "hour", "date")
    assert values(add_time_parts(rows), *columns) == [(2024, 3, 1, 2, "2024-03-01")]
    assert values(add_time_parts(rows, tz="America/Bogota"), *columns) == [(2024, 2, 29, 21, "2024-02-29")]


def test_time_parts_keep_stored_layout(spark):
    stored = silver_rows(spark, {}).withColumn("year", F.lit(1999))
    assert values(add_time_parts(stored), "year", "month") == [(1999, 1)]
    assert values(add_time_parts(stored, tz="America/Bogota"), "year", "month") == [(2024, 1)]


def test_hour_start_before_1970(spark):
    column = hour_start(F.col("dt"))
    assert one(spark, "dt bigint", [(-1,), (0,), (3_599,), (7_300,)], column) == [-3_600, 0, 0, 7_200]
    assert one(spark, "dt bigint", [(-1,), (86_399,)], hour_of_day(column)) == [23, 23]


def test_ingestion_partitions(spark):
    rows = spark.createDataFrame([(epoch(2026, 3, 9, 23, 59),)], "s bigint")
    stamped = rows.select(F.timestamp_seconds("s").alias("ingestion_timestamp"))
    parts = add_ingestion_partitions(stamped)
    assert dict(parts.dtypes)["ingestion_date"] == "date"
    assert values(parts, "year", "month", "day") == [(2026, 3, 9)]
