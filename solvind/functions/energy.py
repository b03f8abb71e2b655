"""Solar and wind formulas.

Three wind measures share a name in the published tables but not a unit: `wind_power` is physical
(W/m2), `wind_index` is v^3/100 and `wind_score` is v^2/10. All three are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from solvind.functions.rounding import round_half_up

# Fixed values.
SUNRISE_HOUR = 6
SUNSET_HOUR = 18
NOON_HOUR = 12
GAS_CONSTANT_DRY_AIR = 287.05  # J/(kg K)
KELVIN_OFFSET = 273.15
PASCAL_PER_HPA = 100.0


def hour_factor(hour: Column) -> Column:
    """Share of noon irradiance: 1 at noon, 0.5 at both ends of the day window, 0 outside."""
    daylight = hour.between(SUNRISE_HOUR, SUNSET_HOUR)
    return F.when(daylight, F.lit(1.0) - F.abs(hour - NOON_HOUR) / F.lit(12.0)).otherwise(F.lit(0.0))


def clear_sky_uv(uv: Column, clouds: Column) -> Column:
    """UV left after cloud cover in percent."""
    return uv * (F.lit(1.0) - clouds / F.lit(100.0))


def solar_kwh(uv: Column, clouds: Column, hour: Column) -> Column:
    """Rounded per observation; tables average the rounded values."""
    return round_half_up(clear_sky_uv(uv, clouds) * hour_factor(hour))


def air_density(pressure: Column, temp: Column) -> Column:
    """kg/m3 from hPa and degrees Celsius; NULL at absolute zero."""
    return F.try_divide(pressure * F.lit(PASCAL_PER_HPA), F.lit(GAS_CONSTANT_DRY_AIR) * (temp + F.lit(KELVIN_OFFSET)))


def wind_power(pressure: Column, temp: Column, speed: Column) -> Column:
    """W/m2, rounded per observation."""
    return round_half_up(F.lit(0.5) * air_density(pressure, temp) * speed * speed * speed)


def wind_index(speed: Column) -> Column:
    return speed * speed * speed / F.lit(100.0)


def wind_score(mean_speed: Column) -> Column:
    return mean_speed * mean_speed / F.lit(10.0)


def circular_mean_degrees(sin_mean: Column, cos_mean: Column) -> Column:
    """Direction in [0, 360) of the mean of unit vectors."""
    return F.pmod(F.degrees(F.atan2(sin_mean, cos_mean)), F.lit(360.0))
