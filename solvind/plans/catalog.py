"""Catalog registration, restricted views and the documented SQL over registered tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def register_table(
    spark: SparkSession, name: str, path: str, schema: StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Create an external table over existing Parquet and discover its partitions."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def governed_view(df: DataFrame, name: str, columns: Sequence[str], rows: Column) -> DataFrame:
    """A view that shows some columns of some rows. It shapes data; it does not control access."""
    df.filter(rows).select(*columns).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def avg_temp_by_city(spark: SparkSession, table: str, year: int, month: int) -> DataFrame:
    query = f"""
        SELECT city, avg(temp) AS temp_promedio FROM {table}
        WHERE year = :year AND month = :month GROUP BY city
    """
    return spark.sql(query, args={"year": year, "month": month})


def count_by_city(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SELECT city, count(*) AS total FROM {table} GROUP BY city")


def partition_rows(spark: SparkSession, table: str, city: str, year: int, month: int) -> DataFrame:
    query = f"SELECT * FROM {table} WHERE city = :city AND year = :year AND month = :month"
    return spark.sql(query, args={"city": city, "year": year, "month": month})


def partition_head(
    spark: SparkSession, table: str, city: str, year: int, month: int, n: int = 10
) -> DataFrame:
    """First n observations of one partition; the order makes the answer repeatable."""
    order = ("dt", "lat", "lon", "temp", "pressure", "humidity", "clouds", "wind_speed", "wind_deg", "uv_index")
    return partition_rows(spark, table, city, year, month).orderBy(*order).limit(n)
