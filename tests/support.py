"""Small literal frames."""

from __future__ import annotations

import datetime as dt

from solvind.schemas import SILVER

DEFAULTS = {
    "dt": 1_704_110_400,  # 2024-01-01 12:00 UTC
    "dt_iso": "2024-01-01 12:00:00",
    "city": "Riohacha",
    "lat": 11.5,
    "lon": -72.9,
    "temp": 28.0,
    "temp_min": 26.0,
    "temp_max": 31.0,
    "feels_like": 29.0,
    "pressure": 1012,
    "humidity": 70,
    "clouds": 20,
    "wind_speed": 6.0,
    "wind_deg": 90,
    "uv_index": 8.0,
}


def epoch(year, month, day, hour=12, minute=0):
    return int(dt.datetime(year, month, day, hour, minute, tzinfo=dt.timezone.utc).timestamp())


def silver_rows(spark, *changes):
    """One Silver row per dict of changed values."""
    rows = [tuple({**DEFAULTS, **change}[name] for name in SILVER.fieldNames()) for change in changes]
    return spark.createDataFrame(rows, SILVER)


def values(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def same_rows(left, right):
    """Both frames hold the same rows, duplicates included, whatever the column order."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
