"""One row per observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solvind.schemas import OBSERVATION_KEY


def dedup(
    df: DataFrame, keys: Sequence[str] = OBSERVATION_KEY, order_col: str = "ingestion_timestamp"
) -> DataFrame:
    """Keep the latest delivery per key; the remaining columns break ties, so reruns agree.

    Catalyst turns `row_number() = 1` into a group limit that runs before the shuffle: a key with
    millions of copies leaves each map task as one row. NULL keys count as equal.
    """
    others = [name for name in df.columns if name not in keys and name != order_col]
    latest_first = [F.col(order_col).desc_nulls_last(), *(F.col(name).asc_nulls_last() for name in others)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*latest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
