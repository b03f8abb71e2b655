"""Idempotent append: a second run over the same delivery adds nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row

from solvind.operators.layout import write_table
from solvind.operators.pruning import any_of, same_keys, semi_join, value_counts
from solvind.schemas import HISTORY_PARTITIONS, OBSERVATION_KEY
from solvind.sources.tables import load_or_empty


def not_in_target(
    df: DataFrame, target: DataFrame, keys: Sequence[str], partition_by: Sequence[str], counts: Sequence[Row]
) -> DataFrame:
    """Rows of `df` whose key the target does not hold. `partition_by` must be functions of the keys and
    `counts` the rows of `df` per partition.

    Only those partitions of the target are read, and only the key columns. History is first cut to the keys of the
    batch: a batch below the broadcast threshold goes to the history scan, so that history is not shuffled; a larger
    one is joined by shuffle on the keys, which are unique on both sides and therefore not skewed.
    """
    known = semi_join(target.filter(any_of(counts, partition_by)).select(*keys), df, keys)
    return df.alias("n").join(known.alias("k"), same_keys("n", "k", keys), "left_anti")


def append_new(
    batch: DataFrame,
    path: str,
    keys: Sequence[str] = OBSERVATION_KEY,
    partition_by: Sequence[str] = HISTORY_PARTITIONS,
    target: DataFrame | None = None,
) -> dict[str, int]:
    """Append the rows of `batch` that the table at `path` lacks; returns `{"rows": written}`.

    The batch is unique per key and read several times: pass a stored table. `target` is the table at
    `path`, if the caller has already opened it.
    """
    if target is None:
        target = load_or_empty(batch.sparkSession, path, batch.schema)
    counts = value_counts(batch, partition_by)
    fresh = not_in_target(batch, target, keys, partition_by, counts)
    return write_table(fresh, path, partition_by, mode="append")
