"""Expiry of landing data by arrival day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.workspace import delete_folders, folders

# Fixed value.
LANDING_DAYS = 30
DROPPED_AT_ONCE = 500  # partitions in one statement


def cutoff_day(today: dt.date, days: int = LANDING_DAYS) -> dt.date:
    return today - dt.timedelta(days=days)


def is_expired(cutoff: dt.date) -> Column:
    """Uses partition columns only: folders are dropped from the scan on the driver. Undated rows stay."""
    return F.coalesce(F.make_date("year", "month", "day") < F.lit(cutoff), F.lit(False))


def expired(df: DataFrame, cutoff: dt.date) -> DataFrame:
    return df.filter(is_expired(cutoff))


def keep(df: DataFrame, cutoff: dt.date) -> DataFrame:
    return df.filter(~is_expired(cutoff))


def retention_report(df: DataFrame, cutoff: dt.date) -> DataFrame:
    """Per topic: arrival days and rows on both sides of the cutoff. Days first, so the shuffle carries
    one row per topic and day and task."""
    days = df.groupBy("topic", "year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))
    old = is_expired(cutoff)
    return days.groupBy("topic").agg(
        F.count_if(old).alias("expired_days"),
        F.coalesce(F.sum(F.when(old, F.col("rows"))), F.lit(0)).alias("expired_rows"),
        F.coalesce(F.sum(F.when(~old, F.col("rows"))), F.lit(0)).alias("kept_rows"),
    )


def landing_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file with its modification time, size and folder keys. Lists only, opens no file."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return listing.drop("content")


def expired_files(spark: SparkSession, path: str, before: dt.datetime, pattern: str = "*.parquet") -> DataFrame:
    """Files last written before a point in time (the rule of an object-store lifecycle)."""
    return landing_files(spark, path, pattern).filter(F.col("modificationTime") < F.lit(before))


def file_totals(files: DataFrame) -> DataFrame:
    """Number and size of files: what a clean-up reports."""
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")
    )


def drop_expired(spark: SparkSession, table: str, cutoff: dt.date) -> int:
    """Drop the expired partitions of a catalog table; a managed table loses the files too.

    Works on catalog metadata (one entry per topic and day), no data is read.
    """
    shown = spark.sql(f"SHOW PARTITIONS {table}")
    parts = F.str_to_map("partition", F.lit("/"), F.lit("="))
    keys = shown.select(
        parts["topic"].alias("topic"), *(parts[name].cast("int").alias(name) for name in ("year", "month", "day"))
    )
    old = expired(keys, cutoff).collect()
    for at in range(0, len(old), DROPPED_AT_ONCE):
        specs = ", ".join(
            f"PARTITION (topic={_quoted(row.topic)}, year={row.year}, month={row.month}, day={row.day})"
            for row in old[at : at + DROPPED_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return len(old)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expire_folders(spark: SparkSession, path: str, cutoff: dt.date) -> dict[str, int]:
    """Delete the arrival-day folders (topic, year, month, day) of a landing table by path that are older than the cutoff.

    Folders are listed by the file system, files are not; deleting is one call per folder. The stream sink's commit
    log is left as it is: read the table with `ignoreMissingFiles`, as `landing_as_history` does. Folders that are no
    dates stay.
    """
    old = []
    for folder in folders(spark, f"{path.rstrip('/')}/topic=*/year=*/month=*/day=*"):
        parts = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
        try:
            arrived = dt.date(int(parts["year"]), int(parts["month"]), int(parts["day"]))
        except ValueError:
            continue
        if arrived < cutoff:
            old.append(folder)
    return {"folders": len(old), **delete_folders(spark, old)}
