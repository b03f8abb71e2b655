"""Labels for conditions that cut renewable output. NULL inputs fall through to `NORMAL`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and thresholds of the published tables.
NORMAL = "Normal"
HIGH_CLOUD = "Alta nubosidad"
LOW_UV = "UV bajo"
WIND_TOO_LOW = "Viento insuficiente"
WIND_TOO_HIGH = "Viento excesivo (peligro)"
RAIN_LIKELY = "Lluvia probable"
EXTREME_HEAT = "Calor extremo"
FREEZING = "Congelamiento"

CLOUD_LIMIT = 80
UV_LIMIT = 2
WIND_MIN = 3.0
WIND_MAX = 25.0
HUMIDITY_LIMIT = 85
HEAT_LIMIT = 40
FREEZE_LIMIT = 0

LABEL_COLUMNS = ("reduccion_solar", "reduccion_eolica", "condicion_adversa")


def _first_match(*rules: tuple[Column, str]) -> Column:
    label = F.lit(NORMAL)
    for condition, name in reversed(rules):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def solar_reason(clouds: Column, uv: Column) -> Column:
    return _first_match((clouds > CLOUD_LIMIT, HIGH_CLOUD), (uv < UV_LIMIT, LOW_UV))


def wind_reason(speed: Column) -> Column:
    return _first_match((speed < WIND_MIN, WIND_TOO_LOW), (speed > WIND_MAX, WIND_TOO_HIGH))


def adverse(humidity: Column, clouds: Column, temp: Column) -> Column:
    rain = (humidity > HUMIDITY_LIMIT) & (clouds > CLOUD_LIMIT)
    return _first_match((rain, RAIN_LIKELY), (temp > HEAT_LIMIT, EXTREME_HEAT), (temp < FREEZE_LIMIT, FREEZING))


def any_reduction() -> Column:
    """At least one label differs from normal. Uses grouping keys only, so Catalyst filters before the shuffle."""
    solar, wind, weather = (F.col(name) != NORMAL for name in LABEL_COLUMNS)
    return solar | wind | weather
