"""Bronze documents: history arrays and landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from solvind.schemas import ENVELOPE, HISTORY_DOCUMENT
from solvind.sources.tables import load_or_empty


def read_json_history(
    spark: SparkSession,
    paths: str | list[str],
    multiline: bool = True,
    schema: StructType = HISTORY_DOCUMENT,
    corrupt: str | None = None,
) -> DataFrame:
    """History documents. A multi-line file cannot be split, so parallelism is the number of files:
    deliver history as many files, or as JSON Lines with `multiline=False`.

    A column named `corrupt` gets the text of records, or whole multi-line files, that could not be read in full.
    """
    reader = spark.read.option("multiLine", multiline)
    if corrupt:
        schema = StructType([*schema.fields, StructField(corrupt, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).json(paths)


def read_landing(
    spark: SparkSession, path: str, fmt: str = "json", schema: StructType = ENVELOPE, **options: str
) -> DataFrame:
    """Landing files in `json` (lines), `parquet` or `avro` (needs the spark-avro module on the classpath).

    No data yet, no folder yet: an empty frame.
    """
    return load_or_empty(spark, path, schema, fmt, **options)
