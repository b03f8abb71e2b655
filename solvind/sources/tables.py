"""Tables of the lake, by path or by catalog name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from solvind.workspace import path_exists

# Columns the reporting loader turns into numbers.
NUMERIC_PARTS = ("year", "month", "day", "hour")


def read_table(spark: SparkSession, path_or_name: str, schema: StructType | None = None) -> DataFrame:
    """A path holds Parquet with `k=v` folders; anything without a slash is a catalog name."""
    if "/" not in path_or_name:
        return spark.table(path_or_name)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path_or_name)


def load_or_empty(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A folder that does not exist yet reads as an empty frame; every other error is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def read_gold_normalised(spark: SparkSession, path: str) -> DataFrame:
    """Reporting view of a Gold table: only `*.parquet` files, folder keys as columns, trimmed names,
    time parts as numbers (text that is no number becomes NULL)."""
    raw = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    trimmed = raw.toDF(*(name.strip() for name in raw.columns))
    # int parts are left as they are: rewriting a partition column would stop partition pruning.
    types = dict(trimmed.dtypes)
    casts = {
        name: F.col(name).try_cast("int")
        for name in NUMERIC_PARTS
        if name in types and types[name] != "int"
    }
    return trimmed.withColumns(casts) if casts else trimmed
