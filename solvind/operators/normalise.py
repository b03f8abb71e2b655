"""Any known document shape -> Silver columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from solvind.functions.energy import KELVIN_OFFSET
from solvind.schemas import SILVER

# Where each Silver column may sit: flat tables, history documents, topic and envelope payloads.
PATHS = {
    "dt": ("dt",),
    "dt_iso": ("dt_iso",),
    "city": ("city", "city_name", "name"),
    "lat": ("lat", "coord.lat"),
    "lon": ("lon", "coord.lon"),
    "temp": ("temp", "main.temp"),
    "temp_min": ("temp_min", "main.temp_min"),
    "temp_max": ("temp_max", "main.temp_max"),
    "feels_like": ("feels_like", "main.feels_like"),
    "pressure": ("pressure", "main.pressure"),
    "humidity": ("humidity", "main.humidity"),
    "clouds": ("clouds", "clouds.all"),
    "wind_speed": ("wind_speed", "wind.speed"),
    "wind_deg": ("wind_deg", "wind.deg"),
    "uv_index": ("uv_index",),
}
TEMPERATURES = ("temp", "temp_min", "temp_max", "feels_like")
CARRIED = ("ingestion_timestamp",)
TOPIC_PREFIX = "weather_"


def _holds_value(schema: StructType, path: str) -> bool:
    """The path leads to a scalar in this schema."""
    for name in path.split("."):
        if not isinstance(schema, StructType) or name not in schema.fieldNames():
            return False
        schema = schema[name].dataType
    return not isinstance(schema, StructType)


def _pick(schema: StructType, name: str, dtype: str) -> Column:
    found = [F.col(path).try_cast(dtype) for path in PATHS[name] if _holds_value(schema, path)]
    if not found:
        return F.lit(None).cast(dtype)
    return found[0] if len(found) == 1 else F.coalesce(*found)


def city_from_topic(topic: Column) -> Column:
    """`weather_riohacha` -> `Riohacha`."""
    return F.initcap(F.regexp_replace(topic, f"^{TOPIC_PREFIX}", ""))


def tag_city(df: DataFrame, city: str | Column | None = None) -> DataFrame:
    """Literal site name, or the one the topic carries."""
    if city is None:
        city = city_from_topic(F.col("topic"))
    return df.withColumn("city", city if isinstance(city, Column) else F.lit(city))


def normalise(df: DataFrame, city: str | Column | None = None, temp_unit: str = "C") -> DataFrame:
    """Project to Silver. Absent fields become typed NULLs, unreadable values become NULL.

    `ingestion_timestamp` is carried along when the input has one.
    """
    if city is not None:
        df = tag_city(df, city)
    if temp_unit not in ("C", "K"):
        raise ValueError(f"unknown temperature unit: {temp_unit}")
    columns = []
    for field in SILVER.fields:
        value = _pick(df.schema, field.name, field.dataType.simpleString())
        if temp_unit == "K" and field.name in TEMPERATURES:
            value = value - F.lit(KELVIN_OFFSET)
        columns.append(value.alias(field.name))
    columns += [F.col(name) for name in CARRIED if name in df.columns]
    return df.select(*columns)


def safe_cast(df: DataFrame, dtypes: dict[str, str]) -> DataFrame:
    """Cast columns, turning values that do not fit into NULL instead of failing the job."""
    return df.withColumns({name: F.col(name).try_cast(dtype) for name, dtype in dtypes.items()})


def unwrap_envelope(df: DataFrame) -> DataFrame:
    """Envelope records -> payload columns plus the delivery time (epoch milliseconds -> timestamp)."""
    return df.select(
        F.timestamp_millis(F.col("_airbyte_emitted_at")).alias("ingestion_timestamp"), "_airbyte_data.*"
    )


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; columns a source lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), others, first)
