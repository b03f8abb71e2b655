"""Keyed upsert into a partitioned table: new rows are appended, corrections replace what they correct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from solvind.operators.layout import stage, write_table
from solvind.operators.pruning import any_of, same_keys, semi_join, value_counts
from solvind.schemas import HISTORY_PARTITIONS, OBSERVATION_KEY
from solvind.sources.tables import load_or_empty
from solvind.workspace import delete_folders, folders, path_exists, staging

FRESH, CORRECTED = "fresh", "corrected"


def pending_path(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def classify(batch: DataFrame, stored: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Rows of `batch` that change the table, with `_change`: `fresh` keys, and `corrected` ones, whose delivery is
    later than the stored row and differs from it in any other column. A repeat, or an older delivery, changes nothing.
    """
    others = [name for name in batch.columns if name not in keys and name != order_col]
    new, old = F.col(f"n.{order_col}"), F.col(f"k.{order_col}")
    later = F.coalesce(new > old, new.isNotNull() & old.isNull())
    differs = F.lit(False)
    for name in others:
        differs = differs | ~F.col(f"n.{name}").eqNullSafe(F.col(f"k.{name}"))
    joined = batch.alias("n").join(stored.withColumn("_known", F.lit(True)).alias("k"), same_keys("n", "k", keys), "left")
    change = F.when(F.col("_known").isNull(), FRESH).when(later & differs, CORRECTED)
    return joined.select("n.*", change.alias("_change")).where(F.col("_change").isNotNull())


def finish_pending(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]) -> int:
    """Carry out rewrites that a run had completed beside the table but not swapped in when it died; returns how many."""
    done = 0
    for folder in sorted(folders(spark, f"{pending_path(path)}/*")):
        if path_exists(spark, f"{folder}/_SUCCESS"):
            _swap_in(spark, folder, path, schema, partition_by)
            done += 1
        delete_folders(spark, [folder])
    return done


def _swap_in(spark: SparkSession, folder: str, path: str, schema: StructType, partition_by: Sequence[str]) -> None:
    rows = spark.read.schema(schema).parquet(folder)
    write_table(rows, path, partition_by, mode="overwrite")  # only the folders that `rows` has


def merge_latest(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = OBSERVATION_KEY,
    partition_by: Sequence[str] = HISTORY_PARTITIONS,
    order_col: str = "ingestion_timestamp",
) -> dict[str, int]:
    """Upsert `batch`, unique per key and stored, into the table at `path`: `{"rows": appended, "corrected": replaced}`.

    Only partitions of the batch are looked at, of them only rows with the batch's keys, and only partitions with a
    correction are rewritten; the others are appended to. `partition_by` must be functions of the keys. The rewritten partitions
    are written beside the table first: a run that dies while they replace the old ones is finished by the next.
    """
    spark, columns = batch.sparkSession, batch.columns
    with staging(spark):
        finish_pending(spark, path, batch.schema, partition_by)
        table = load_or_empty(spark, path, batch.schema)
        known = semi_join(table.filter(any_of(value_counts(batch, partition_by), partition_by)).select(*columns), batch, keys)
        changes, _ = stage(classify(batch, known, keys, order_col), "changes")
        corrected = changes.where(F.col("_change") == CORRECTED).drop("_change")
        fresh = changes.where(F.col("_change") == FRESH).drop("_change")
        parts = value_counts(corrected, partition_by)
        report = {"rows": 0, "corrected": sum(row["_rows"] for row in parts)}
        if parts:
            rewritten = any_of(parts, partition_by)
            kept = table.filter(rewritten).select(*columns).alias("n")
            kept = kept.join(corrected.select(*keys).alias("k"), same_keys("n", "k", keys), "left_anti")
            together = kept.unionByName(corrected).unionByName(fresh.filter(rewritten))
            report["rows"] += fresh.filter(rewritten).count()
            # Named by the changes it holds: the swap reads it, and so can the next run.
            folder = f"{pending_path(path)}/{spark.sparkContext.applicationId}-{len(folders(spark, f'{pending_path(path)}/*'))}"
            write_table(together, folder, partition_by, dynamic=False)  # ends with a _SUCCESS file
            _swap_in(spark, folder, path, batch.schema, partition_by)
            delete_folders(spark, [folder])
            fresh = fresh.filter(~F.coalesce(rewritten, F.lit(False)))
        report["rows"] += write_table(fresh, path, partition_by, mode="append")["rows"]
        return report
