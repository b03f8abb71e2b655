"""Writing partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from solvind.workspace import staged_path


def gather_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one output folder together without pinning a hot folder to one task: the REBALANCE
    hint lets AQE split what exceeds the advisory size and merge what stays below it."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = True,
    gather: bool = True,
) -> dict[str, int]:
    """Write Parquet and return `{"rows": n}`, counted by the write itself.

    `overwrite` with `dynamic` replaces only the folders that get rows; `dynamic=False` replaces the
    table. `gather=False` skips the shuffle when each input task already holds few folders.
    """
    seen = Observation()
    rows = gather_partitions(df, partition_by) if gather else df
    # Observed in the write stage: a retried shuffle map stage would count twice.
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return {"rows": seen.get.get("rows", 0)}


def stage(df: DataFrame, label: str, reader: SparkSession | None = None) -> tuple[DataFrame, int]:
    """Store an intermediate result in the shared folder and read it back: (frame, rows).

    Unlike cached blocks, the copy survives lost executors, and each reader loads only the columns it
    needs. It stays until the job that runs ends (`workspace.staging`). The session that reads it back is that of `df`
    unless `reader` is given: a micro-batch has a session of its own, in which queries are not re-planned at run time.
    """
    path = staged_path(df.sparkSession, label)
    rows = write_table(df, path)["rows"]
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path), rows


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict[str, int]:
    """Replace a whole table by rows that may come from that table, by way of a staged copy. For small tables."""
    staged, _ = stage(df, "staged")
    return write_table(staged, path, partition_by, dynamic=False)
