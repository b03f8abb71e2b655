"""Micro-batches that count once: a ledger of finished batches beside the data they went into."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.schemas import LEDGER
from solvind.sources.tables import load_or_empty
from solvind.workspace import delete_folders, path_exists

#: Entries that stay for each stream. A stream replays its last batch only, so older ones are a report.
KEPT_ENTRIES = 1000

BatchWork = Callable[[DataFrame, int], dict[str, int]]


def ledger_path(table: str) -> str:
    return f"{table.rstrip('/')}.ledger"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark keeps in the checkpoint. A new checkpoint counts its batches from 0 again, so batch numbers
    alone do not tell whether a batch is in the table."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """(stream, batch, report) of the finished batches of all streams into `table`; empty before the first."""
    return load_or_empty(spark, ledger_path(table), LEDGER)


def once_per_batch(
    spark: SparkSession, table: str, checkpoint: str, work: BatchWork, on_written: Callable[[int, dict[str, int]], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """The function for `foreachBatch` that does `work`, which writes to `table`, for each batch the ledger lacks.

    The entry is made after the work and before Spark commits the batch. A run that dies between entry and commit
    replays a batch that is skipped; one that dies before the entry repeats the work, which must therefore
    be repeatable. `on_written` is told batch and report before the entry is made.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        entries = f"{ledger_path(table)}/stream={stream_id(spark, checkpoint)}"
        if path_exists(spark, f"{entries}/batch={batch_id}/_SUCCESS"):
            return
        report = work(batch, batch_id)
        if on_written:
            on_written(batch_id, report)
        entry = spark.range(1).select(F.lit(json.dumps(report)).alias("report"))
        entry.write.mode("overwrite").parquet(f"{entries}/batch={batch_id}")
        delete_folders(spark, [f"{entries}/batch={batch_id - KEPT_ENTRIES}"])

    return run
