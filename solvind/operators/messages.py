"""Topic messages -> flat rows. The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from solvind.functions.calendar import is_plausible
from solvind.schemas import LANDING_STREAM, WEATHER_MESSAGE

CORRUPT = "_corrupt_record"
MESSAGE_COLUMNS = {
    "dt": "data.dt",
    "lat": "data.coord.lat",
    "lon": "data.coord.lon",
    "temp": "data.main.temp",
    "pressure": "data.main.pressure",
    "humidity": "data.main.humidity",
    "wind_speed": "data.wind.speed",
    "wind_deg": "data.wind.deg",
    "clouds": "data.clouds.all",
    "city_name": "data.name",
}


def parse_messages(df: DataFrame, schema: StructType = WEATHER_MESSAGE) -> DataFrame:
    """`value` (binary) and `topic` -> json_string, data struct, topic; other columns pass through.

    A field that does not fit its type is NULL, the others stand. Unreadable text leaves every field NULL. A message
    with either keeps its text in `data._corrupt_record`. The document comes out of a one-element generator, which
    filters are not pushed through: however it is split afterwards, each message is parsed once.
    """
    tracked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    kept = [F.col(name) for name in df.columns if name != "value"]
    return df.select(*kept, text.alias("json_string"), F.explode(F.array(F.from_json(text, tracked, options))).alias("data"))


def is_malformed() -> Column:
    """No usable document: broken JSON, a tombstone, or no observation time that can be true."""
    return F.col("data").isNull() | ~is_plausible(F.col("data.dt"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): every parsed row is in exactly one of the two."""
    bad = is_malformed()
    return parsed.filter(~bad), parsed.filter(bad).select("topic", "json_string")


def flatten_messages(parsed: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Flat landing columns. `ingested_at` defaults to the micro-batch time."""
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    kinds = {field.name: field.dataType for field in LANDING_STREAM.fields}
    fields = [F.col(path).try_cast(kinds[name]).alias(name) for name, path in MESSAGE_COLUMNS.items()]
    return parsed.select(*fields, "topic", ingested_at.alias("ingestion_timestamp"))
