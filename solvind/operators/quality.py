"""Checks on Silver-shaped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values.
CRITICAL_FIELDS = ("temp", "humidity", "wind_speed")


def weather_rules() -> dict[str, Column]:
    """Rule name -> condition that marks a violating row."""
    missing = {f"{name}_missing": F.col(name).isNull() for name in CRITICAL_FIELDS}
    return {
        **missing,
        "uv_index_missing": F.col("uv_index").isNull(),
        "dt_not_epoch": F.col("dt").isNull() | (F.col("dt") <= 0),
        # dt_iso is UTC text such as `2024-01-01 00:00:00`; absent text is not checked.
        "dt_iso_differs": F.try_to_timestamp(F.substring("dt_iso", 1, 19)).cast("bigint") != F.col("dt"),
        "latitude_out_of_range": F.col("lat").isNull() | ~F.col("lat").between(-90, 90),
        "longitude_out_of_range": F.col("lon").isNull() | ~F.col("lon").between(-180, 180),
    }


def dq_report(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """(rule, violations, checked) for every rule, in one aggregate pass."""
    rules = weather_rules() if rules is None else rules
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"), *(F.count_if(bad).alias(name) for name, bad in rules.items())
    )
    entries = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counts.select(F.explode(F.array(*entries)).alias("r"), "checked").select("r.*", "checked")


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when there is nothing to process. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} holds no rows")
    return df


def require_fields(df: DataFrame, schema: StructType) -> DataFrame:
    """Raise when a contract column is absent or has another type. Reads no data."""
    actual = dict(df.dtypes)
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, found {actual.get(field.name, 'nothing')}"
        for field in schema.fields
        if actual.get(field.name) != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df
